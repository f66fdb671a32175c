"""Merkle manifest of a dataset, with an inclusion proof for every row.

Rows are the leaves of one 16-ary tree per source, in the order of their ids; the
sources' roots are the leaves of one more tree.  Both directions are time-forward
processing: nodes are labelled (last leaf below, level), which is an order in which
children come before parents.  A sweep in this order takes the digests of a node's
children from a priority queue and puts its own there for its parent; the sweep in
the reversed order takes a node's proof from the queue and puts those of its children
there.  Spark's sort is the external part of the queue: it brings the leaves in the
order of the labels, cut into chunks of 256 that are complete subtrees, so a source
of any size is spread over all tasks and what is held at once is one chunk.  What a
chunk sends on is one digest upwards and one proof downwards.

Cases: a null field is `-`; rows with a null source are a source of their own (first),
null ids come first; rows that repeat an id are ordered by their leaves, equal rows are
one leaf each; very long texts only pass through the leaf's digest; an empty table gives
no rows; columns other than the named ones are not looked at and may have any name."""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scale import lookup_join
from ..session import materialize

FAN = 16
LEVELS = 2  # of a chunk: 256 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = T.ArrayType(
    T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())])
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(*fields: Column) -> Column:
    """Digest of a row: every field as `-` or its length in bytes, `:` and its text."""
    told = [
        F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
        for v in (f.cast("string") for f in fields)
    ]
    return F.sha2(F.concat(*told), 256)


def proof_text(proof: Column) -> Column:
    """All siblings of a proof, from the leaf up, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(
        proof, leaf, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256)
    )


# --- sweeps over one chunk


def depth(leaves: int, most: int = LEVELS) -> int:
    """Levels above so many leaves, `most` at most."""
    levels, reach = 0, 1
    while reach < leaves and levels < most:
        levels, reach = levels + 1, reach * FAN
    return levels


def _label(level: int, index: int, leaves: int) -> tuple[int, int]:
    return min((index + 1) * FAN**level, leaves) - 1, level


def sweep_up(digests: list[str], levels: int) -> tuple[str, list]:
    """The top digest of a chunk, and its runs (label, index, children's digests) in
    the order of their labels."""
    if not levels:
        return digests[0], []
    queue, runs, n, top = [], [], len(digests), ""
    for place, digest in enumerate(digests):
        up = place // FAN
        heappush(queue, (_label(1, up, n), place, up, digest))
        while queue and queue[0][0][0] == place:
            label, _, index, _ = queue[0]
            children = []
            while queue and queue[0][0] == label:
                children.append(heappop(queue)[3])
            runs.append((label, index, children))
            digest = hashlib.sha256("".join(children).encode()).hexdigest()
            if label[1] == levels:
                top = digest
            else:
                up = index // FAN
                heappush(queue, (_label(label[1] + 1, up, n), index, up, digest))
    return top, runs


def sweep_down(runs: list, leaves: int, above: list) -> list[list]:
    """The proof of every leaf of a chunk: (before, after) per level, from the leaf up.
    `above` is the proof of the chunk's top."""
    if not runs:
        return [above] * leaves
    proofs: list = [None] * leaves
    end, level = runs[-1][0]
    queue = [((-end, -level), above)]  # the last label comes first
    for (end, level), index, children in reversed(runs):
        _, suffix = heappop(queue)
        for slot, _ in enumerate(children):
            own = ("".join(children[:slot]), "".join(children[slot + 1 :]))
            child = index * FAN + slot
            if level == 1:
                proofs[child] = [own, *suffix]
            else:
                last, below = _label(level - 1, child, leaves)
                heappush(queue, ((-last, -below), [own, *suffix]))
    return proofs


def _chunks(batches):
    """Arrow tables of one (tree, chunk) each, from sorted batches."""
    import numpy as np
    import pyarrow as pa

    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        if rows.num_rows == 0:
            continue
        key = rows.column("_chunk_key").to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()]
        for start, stop in zip(cuts, cuts[1:]):
            yield rows.slice(start, stop - start)
        held = rows.slice(cuts[-1]).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def _tops(batches):
    import pyarrow as pa

    for rows in _chunks(batches):
        n = rows.column("n")[0].as_py()
        levels = depth(n)
        top, _ = sweep_up(rows.column("digest").to_pylist(), levels)
        for _ in range(levels):
            n = -(-n // FAN)
        yield pa.RecordBatch.from_pydict(
            {
                "tree": rows.column("tree").slice(0, 1).combine_chunks(),
                "pos": pa.array([rows.column("_chunk")[0].as_py()], pa.int64()),
                "digest": pa.array([top], pa.string()),
                "n": pa.array([n], pa.int64()),
            }
        )


def _deliver(names: list[str]):
    """Reversed sweep: the first row of a chunk is the message from above."""

    def run(batches):
        import pyarrow as pa

        for rows in _chunks(batches):
            message, rows = rows.slice(0, 1), rows.slice(1)
            above = [(s["before"], s["after"]) for s in message.column("proof")[0].as_py()]
            digests = rows.column("digest").to_pylist()
            _, runs = sweep_up(digests, depth(rows.column("n")[0].as_py()))
            proofs = sweep_down(runs, len(digests), above)
            flat = [s for p in proofs for s in p]
            steps = pa.StructArray.from_arrays(
                [pa.array([s[i] for s in flat], pa.string()) for i in (0, 1)], ["before", "after"]
            )
            found = pa.ListArray.from_arrays(
                pa.array(range(0, len(flat) + 1, len(proofs[0]) or 1), pa.int32())
                if flat
                else pa.array([0] * (len(proofs) + 1), pa.int32()),
                steps,
            )
            same = {c: pa.array([message.column(c)[0].as_py()] * len(digests), pa.string()) for c in ("subroot", "root")}
            done = {c: rows.column(c).combine_chunks() for c in names} | {"proof": found} | same
            yield pa.RecordBatch.from_pydict(done)

    return run


# --- trees over tables


def _in_chunks(nodes: DataFrame) -> DataFrame:
    """Nodes in the order of their labels, chunks together; `_chunk_key` tells chunks
    that follow each other in a task apart."""
    key = F.xxhash64("tree", F.col("tree").isNull(), "_chunk")
    return (
        nodes.withColumn("_chunk_key", key)
        .repartition("_chunk_key", "tree", "_chunk")
        .sortWithinPartitions("_chunk_key", "tree", "_chunk", "pos")
    )


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add `pos`, the place of a row in its tree, and `n`, the rows of the tree.

    Rows are dealt by ranges of (tree, order) and sorted; a row's place is that in its
    range after the rows of the tree in the ranges before."""
    spread = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    placed = materialize(spread.withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    counts = materialize(
        placed.groupBy(tree, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    )
    every = Window.partitionBy(tree)
    before = every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        tree,
        "_range",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_from"),
        F.sum("_n").over(every).alias("n"),
        "_n",
    )
    joined = lookup_join(placed, starts, [tree, "_range"], "_n")
    return joined.withColumn("pos", F.col("_at") + F.col("_from")).drop("_at", "_range", "_from", "_n")


def build(leaves: DataFrame) -> list[DataFrame]:
    """Nodes by round, from the leaves (`tree`, `pos`, `digest`, `n`) up to one row per tree."""
    rounds = [leaves]
    kept = "tree string, pos long, digest string, n long"
    chunk = F.floor(F.col("pos") / FAN**LEVELS).cast("long")
    while (rounds[-1].agg(F.max("n")).first()[0] or 1) > 1:
        nodes = rounds[-1].select("tree", "pos", "digest", "n").withColumn("_chunk", chunk)
        rounds.append(materialize(_in_chunks(nodes).mapInArrow(_tops, kept)))
    return rounds


def deliver(rounds: list[DataFrame], messages: DataFrame) -> DataFrame:
    """Add `proof`, `subroot` and `root` to the leaves.  `messages` has a row per tree with
    the three for its top."""
    chunk = F.floor(F.col("pos") / FAN**LEVELS).cast("long")
    step = [F.col(c) for c in ("proof", "subroot", "root")]
    down = messages.select("tree", F.lit(0).cast("long").alias("pos"), *step)
    if len(rounds) == 1:  # every tree is one leaf
        rounds = [rounds[0], rounds[0].select("tree", "pos", "digest", "n")]
    for nodes in reversed(rounds[:-1]):
        told = down.select("tree", F.col("pos").alias("_chunk"), F.lit(-1).cast("long").alias("pos"), *step)
        both = nodes.withColumn("_chunk", chunk).unionByName(told, allowMissingColumns=True)
        names = nodes.columns
        schema = T.StructType(
            [nodes.schema[c] for c in names]
            + [T.StructField("proof", PROOF), T.StructField("subroot", T.StringType()), T.StructField("root", T.StringType())]
        )
        down = _in_chunks(both).mapInArrow(_deliver(names), schema)
        if nodes is not rounds[0]:
            down = materialize(down)
    return down


def manifest(
    rows: DataFrame, source: str = "source", order: str = "doc_id", fields=FIELDS, keep=()
) -> DataFrame:
    """`doc_id` (the order column), `leaf`, `proof`, `subroot` and `root` of every row, and
    the named columns of `keep` (name, expression)."""
    told = materialize(rows.select(  # texts are read once, sampling for the ranges reads this
        F.col(source).cast("string").alias("tree"),
        F.col(order).alias("doc_id"),
        leaf(*[F.col(f) for f in fields]).alias("digest"),
        *[expression.alias(name) for name, expression in keep],
    ))
    rounds = build(numbered(told, "tree", ["doc_id", "digest"]))
    tops = rounds[-1].select(F.col("tree").alias("name"), F.col("digest"))
    over = numbered(tops.withColumn("tree", F.lit("")), "tree", ["name"])
    above = build(over)
    root = above[-1].select(F.col("digest").alias("root"))
    start = root.select(
        F.lit("").alias("tree"), F.array().cast(PROOF).alias("proof"), F.lit(None).cast("string").alias("subroot"), "root"
    )
    messages = deliver(above, start).select(
        F.col("name").alias("tree"), "proof", F.col("digest").alias("subroot"), "root"
    )
    found = deliver(rounds, materialize(messages))
    return found.select(
        "doc_id", F.col("digest").alias("leaf"), "proof", "subroot", "root", *[n for n, _ in keep]
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Manifest of documents; rows whose id's crc32 is divisible by 5 are checked with a
    text whose A-Z are lower-cased."""
    from .common import read

    docs = read(spark, sf_dir, "documents")
    lowered = F.translate("text", UPPER, LOWER)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = leaf(*[lowered if f == "text" else F.col(f) for f in FIELDS])
    # null where the row is checked as it is
    found = manifest(docs, keep=[("changed", F.when(hit, changed))])
    folded = fold(F.coalesce("changed", "leaf"), F.col("proof"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql(leaf_levels: int = 6, source_levels: int = 5) -> str:
    """The manifest level by level; enough levels for 16 million rows a source and a
    million sources."""
    field = "coalesce(strlen({0}) || ':' || {0}, '-')"
    number = "coalesce(length(CAST({0} AS VARCHAR)) || ':' || {0}, '-')"
    texts = lambda text: " || ".join(
        [number.format("doc_id"), field.format("source"), field.format("lang"), number.format("n_chars"), field.format(text)]
    )
    crc = (
        "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(d) + 1), lambda i: ord(substr(d, i, 1))::BIGINT)),"
        " lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y:"
        " CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"
    )
    parts = [
        f"""docs AS (SELECT *, CAST(doc_id AS VARCHAR) AS d,
  translate(text, '{UPPER}', '{LOWER}') AS low FROM documents)""",
        f"""marked AS (SELECT doc_id, source, sha256({texts("text")}) AS leaf, sha256({texts("low")}) AS lowered,
  coalesce({crc} % 5 = 0, false) AS hit FROM docs)""",
        """l0 AS (SELECT coalesce('+' || source, '') AS tree, doc_id, leaf, lowered, hit, leaf AS digest,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY source) AS n FROM marked)""",
    ]

    def levels(first: str, count: int, name: str) -> None:
        last = first
        for k in range(1, count + 1):
            parts.append(
                f"""{name}{k} AS (SELECT tree, pos // 16 AS pos, CASE WHEN any_value(n) > 1
  THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE any_value(digest) END AS digest,
  (any_value(n) + 15) // 16 AS n FROM {last} GROUP BY tree, pos // 16)"""
            )
            last = f"{name}{k}"

    levels("l0", leaf_levels, "l")
    parts.append(
        f"""s0 AS (SELECT '' AS tree, tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS pos,
  count(*) OVER () AS n FROM l{leaf_levels})"""
    )
    levels("s0", source_levels, "s")

    def climb(first: str, count: int, name: str) -> str:
        """Siblings and the folded digest, a level at a time."""
        last = first
        for k in range(count):
            parts.append(
                f"""{name}r{k} AS (SELECT tree, pos // 16 AS run, list(digest ORDER BY pos) AS kin, any_value(n) AS runs
  FROM {name}{k} GROUP BY tree, pos // 16)"""
            )
            parts.append(
                f"""{name}c{k} AS (SELECT c.* EXCLUDE (proof, place, folded), place // 16 AS place,
  CASE WHEN runs > 1 THEN proof || array_to_string(kin[:place % 16], '') || array_to_string(kin[place % 16 + 2:], '') ELSE proof END AS proof,
  CASE WHEN runs > 1 THEN sha256(array_to_string(kin[:place % 16], '') || folded || array_to_string(kin[place % 16 + 2:], '')) ELSE folded END AS folded
  FROM {last} c JOIN {name}r{k} r ON r.tree = c.tree AND r.run = c.place // 16)"""
            )
            last = f"{name}c{k}"
        return last

    parts.append(
        "start AS (SELECT tree, doc_id, leaf, pos AS place, '' AS proof, CASE WHEN hit THEN lowered ELSE leaf END AS folded FROM l0)"
    )
    done = climb("start", leaf_levels, "l")
    parts.append(
        f"""upper AS (SELECT '' AS tree, c.doc_id, c.leaf, s.digest AS subroot, s.pos AS place, c.proof, c.folded
  FROM {done} c JOIN s0 s ON s.name = c.tree)"""
    )
    done = climb("upper", source_levels, "s")
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = t.digest AS verified
FROM {done} c JOIN s{source_levels} t ON true"""
    )


SQL = _sql()
