"""N-gram Jaccard join by token-combination prefixes.

A document's tokens are its distinct word shingles.  Tokens are ordered by frequency
class, then hash.  If two sets are similar enough, few tokens of either are missing in
the other, so a long enough prefix of both must share tokens.  Rare tokens are indexed
singly.  Frequent ones are indexed in combinations of k, which are far rarer; a prefix
with n tokens of such a class survives only n - k + 1 missing ones, so prefixes are
extended until all their classes together survive one more token than may be missing.
Combinations are formed within hash parts of a class, whose number follows the size of
the set (sets near a border use both numbers), so their number is linear in the size.
Long sets, whose prefixes are long and easily share a token, use one token more.

Equal sets are one class of documents.  In each bucket every class is first compared
with the one in the middle, whose tokens are the most frequent; then classes of different components are compared with
each other, after exact bounds (set sizes, parity bits of the tokens, for long sets
counts of tokens).  Every pair left is verified on the whole texts.

Frequencies are counted over all documents, in a table of fixed size by token hash.
They decide the index only; results do not depend on them.

Cases: a null, empty or blank text has an empty set and is linked with nothing; a text
with fewer words than a shingle is one shingle; repeated rows and equal sets are linked;
an empty table gives an empty result.  Sets and nodes are known by 64-bit hashes (52
bits within a set)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..operators.scale import lookup_join
from ..session import materialize, settled
from .common import byte_slices
from .wordhash import U, arrow_texts, mix, run_hashes, spans, word_hashes

SHINGLE = 4
PERCENT = 85
SLICE_BYTES = 2_000_000
SLICE_ROWS = 4_000  # a row's place in its slice has 12 bits
COUNTERS = 1 << 18
COUNTER_ROWS = 64
NOISE = 6  # standard deviations by which counters differ by chance
FREQUENT = 30  # counts above chance: tokens indexed in pairs
VERY_FREQUENT = 3_000  # counts above chance: tokens indexed in triples
PART_TOKENS = 8
LONG_LEVEL = 7  # from here on (about 1000 tokens) combinations have one more token
BITS = 1024
BIT_COLUMNS = [f"b{i}" for i in range(BITS // 64)]
# Beyond this size parity bits say little; such sets also have counts of tokens.
LONG_SET = 1_500
COUNTS = 1024
BROADCAST_ROWS = 500_000
LOOKUP_ROWS = 100_000


def token_sets(column, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct tokens of every text (52 bits), in one array with the row's
    place above them, and the offsets of the rows."""
    rows = len(column)
    data, bounds = arrow_texts(column)
    starts, ends, doc = spans(data, bounds)
    hashes = word_hashes(data, starts, ends, lower=True)
    runs = run_hashes(hashes, shingle)
    inside = doc[: len(runs)] == doc[shingle - 1 :] if len(runs) else np.zeros(0, bool)
    where, runs = doc[: len(runs)][inside], runs[inside]
    counts = np.bincount(doc, minlength=rows)
    few = np.flatnonzero((counts > 0) & (counts < shingle))
    if len(few):
        firsts = np.searchsorted(doc, few)
        whole = counts[few].astype(U)
        for k in range(shingle - 1):
            more = counts[few] > k
            at = np.minimum(firsts + k, len(hashes) - 1)
            whole = np.where(more, mix(whole * U(3) + hashes[at]), whole)
        where, runs = np.concatenate((where, few)), np.concatenate((runs, whole))
    tagged = (where.astype(U) << U(52)) | (runs >> U(12))
    tagged.sort()
    if len(tagged):
        tagged = tagged[np.concatenate(([True], tagged[1:] != tagged[:-1]))]
    return tagged, np.searchsorted(tagged, np.arange(rows + 1).astype(U) << U(52))


def _slices(batch, column: str):
    for part in byte_slices(batch, column, SLICE_BYTES):
        for at in range(0, part.num_rows, SLICE_ROWS):
            yield part.slice(at, SLICE_ROWS)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    through = np.concatenate((np.zeros(1, U), np.cumsum(values, dtype=U)))
    return through[offsets[1:]] - through[offsets[:-1]]


def node_of(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One hash per set, the same for equal sets."""
    one = _sums(mix(tokens + U(1)), offsets)
    size = np.diff(offsets).astype(U)
    return mix(one + size * U(0x9E3779B97F4A7C15)).view(np.int64)


TOKEN = U((1 << 52) - 1)


SURVEY = ["doc_id", "text_hash", "n_shingles", "node", "block", "counts"]


def _survey(shingle: int):
    """Per row: set size and node.  Per task: counts of tokens by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        id_type = None
        for batch in batches:
            for part in _slices(batch, "text"):
                tagged, offsets = token_sets(part.column("text"), shingle)
                tokens = tagged & TOKEN
                counts += np.bincount((tokens % U(COUNTERS)).astype(np.int64), minlength=COUNTERS)
                ids = part.column("doc_id")
                id_type = ids.type
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        part.column("text_hash"),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array(node_of(tokens, offsets)),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.list_(pa.int64())),
                    ],
                    names=SURVEY,
                )
        if id_type is not None:
            blocks = list(counts.reshape(COUNTER_ROWS, -1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(COUNTER_ROWS, id_type),
                    pa.nulls(COUNTER_ROWS, pa.int64()),
                    pa.nulls(COUNTER_ROWS, pa.int64()),
                    pa.nulls(COUNTER_ROWS, pa.int64()),
                    pa.array(np.arange(COUNTER_ROWS, dtype=np.int32)),
                    pa.array(blocks, pa.list_(pa.int64())),
                ],
                names=SURVEY,
            )

    return run


def token_counters(survey: DataFrame) -> np.ndarray:
    """Counts of tokens by hash over all documents; a table of fixed size."""
    blocks = survey.filter("block is not null").select("block", F.posexplode("counts"))
    summed = blocks.groupBy("block", "pos").agg(F.sum("col").alias("n"))
    packed = summed.groupBy("block").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "n"))), lambda x: x["n"]).alias("n")
    )
    counts = np.zeros((COUNTER_ROWS, COUNTERS // COUNTER_ROWS), np.int64)
    for block, n in packed.collect():  # COUNTERS numbers in all
        counts[block] = n
    return counts.ravel()


def frequency_classes(counts: np.ndarray) -> np.ndarray:
    """Class (1, 2 or 3) of every counter."""
    chance = counts.mean() + NOISE * np.sqrt(counts.mean())
    frequent, very = counts > chance + FREQUENT, counts > chance + VERY_FREQUENT
    return (1 + frequent + very).astype(np.uint8)


def may_miss(size, percent: int):
    """How many tokens of a set of this size a similar set can lack."""
    return size + (-percent * size) // 100  # size - ceil(percent% of size)


def levels(size: int, percent: int) -> range:
    """Levels at which a set of this size is indexed: those of all sizes that a
    similar set can have as the smaller of the two."""
    level = lambda s: max(1, s // PART_TOKENS).bit_length() - 1
    return range(level(-(-percent * size // 100)), level(size) + 1)


def may_link(size, percent: int):
    """Whether a set of this size can be similar to any but an equal one: the nearest
    is itself and one more token."""
    return 100 * size >= percent * (size + 1)


@cache
def needs_single(size: int, percent: int) -> bool:
    """Whether a similar set can be too small for combinations: a hash part with
    tokens of all classes survives three missing tokens less than it has (five from
    LONG_LEVEL on), which may leave none of those that must be shared."""
    must = lambda s: -(-percent * s // 100)
    lost = lambda level: (5 if level >= LONG_LEVEL else 3) << level
    return any(
        must(s) <= lost(level)
        for s in range(max(1, must(size)), size + 1)
        for level in levels(s, percent)
    )


def mixed_keys(tokens: np.ndarray, classes: np.ndarray, percent: int) -> list[np.ndarray]:
    """Index keys of one set that is long or has too few rare tokens."""
    order = np.lexsort((tokens, classes))
    tokens, classes = tokens[order], classes[order]
    out = []
    if needs_single(len(tokens), percent):
        out.append(mix(tokens[: may_miss(len(tokens), percent) + 1] + U(11)))
    for level in levels(len(tokens), percent):
        # tokens in a combination
        joint = np.minimum(classes + (level >= LONG_LEVEL), 3)
        parts = (mix(tokens + U(7)) % U(1 << level)).astype(np.int64)
        part = np.where(joint > 1, parts, 0) * 4 + classes
        by = np.argsort(part, kind="stable")
        sorted_part = part[by]
        first = np.concatenate(([True], sorted_part[1:] != sorted_part[:-1]))
        rank = np.arange(len(by)) - np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))
        earlier = np.empty(len(by), np.int64)
        earlier[by] = rank
        survives = np.cumsum(earlier >= joint - 1)
        prefix = int(np.searchsorted(survives, may_miss(len(tokens), percent) + 1)) + 1
        head, kinds, parts = tokens[:prefix], joint[:prefix], part[:prefix]
        out.append(mix(head[kinds == 1] + U(11)))
        for k in (2, 3):
            of_kind = head[kinds == k]
            groups: dict[int, list[int]] = {}
            for p, t in zip(parts[kinds == k].tolist(), of_kind.tolist()):
                groups.setdefault(p, []).append(t)
            combos = [c for g in groups.values() if len(g) >= k for c in combinations(g, k)]
            if combos:
                table = np.array(combos, U)
                key = np.full(len(table), U(level * 4 + k))
                for column in range(k):  # tokens of a group are in hash order
                    key = mix(key * U(5) + table[:, column])
                out.append(key)
    return [np.unique(np.concatenate(out))] if out else [np.zeros(0, U)]


def prefix_keys(tokens, offsets, classes, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of every set, end to end, and their offsets."""
    size = np.diff(offsets)
    kinds = classes[(tokens % U(COUNTERS)).astype(np.int64)]
    # of a set with enough rare tokens the prefix is the first few of those by hash
    # sets that are similar to equal ones only need no keys
    length = np.where(may_link(size, percent), may_miss(size, percent) + 1, 0)
    rare = kinds == 1
    from_ = np.concatenate(([0], np.cumsum(rare)))[offsets]
    plain = (np.diff(from_) >= length) & (size < PART_TOKENS << LONG_LEVEL)
    short = np.where(plain, length, 0)
    ends = np.cumsum(short)
    total = int(ends[-1]) if len(ends) else 0
    place = np.repeat(from_[:-1] - (ends - short), short) + np.arange(total)
    keys = mix(tokens[rare][place] + U(11))
    mixed = np.flatnonzero(~plain & (length > 0))
    if len(mixed) == 0:
        return keys, np.concatenate(([0], ends))
    pieces, counts, at = [], short.copy(), 0
    for row in mixed:
        own = mixed_keys(
            tokens[offsets[row] : offsets[row + 1]], kinds[offsets[row] : offsets[row + 1]], percent
        )[0]
        before = int(ends[row] - short[row])
        pieces += [keys[at:before], own]
        at, counts[row] = before, len(own)
    pieces.append(keys[at:])
    return np.concatenate(pieces), np.concatenate(([0], np.cumsum(counts)))


def parity_bits(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """BITS bits per set, each the parity of the number of tokens that fall on it:
    two sets differ in at least as many tokens as their bits do."""
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(offsets))
    spot = row * BITS + (tokens % U(BITS)).astype(np.int64)
    odd = (np.bincount(spot, minlength=rows * BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(rows, BITS), axis=1).view(np.int64)


def token_counts(tokens: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """For long sets the number of tokens by hash: two sets differ in at least as
    many tokens as their counts do."""
    out: list[bytes | None] = [None] * (len(offsets) - 1)
    for row in np.flatnonzero(np.diff(offsets) > LONG_SET):
        own = tokens[offsets[row] : offsets[row + 1]]
        spots = ((own >> U(10)) % U(COUNTS)).astype(np.int64)
        out[row] = np.bincount(spots, minlength=COUNTS).astype("<u4").tobytes()
    return out


def _counts_close(percent: int):
    """Keep the pairs of long sets that their counts do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                one, two = (
                    np.frombuffer(b"".join(part.column(c).to_pylist()), "<u4")
                    .astype(np.int64)
                    .reshape(-1, COUNTS)
                    for c in ("counts_a", "counts_b")
                )
                differ = np.abs(one - two).sum(1)
                total = one.sum(1) + two.sum(1)
                good = differ * (100 + percent) <= total * (100 - percent)
                yield part.select(["a", "b"]).filter(pa.array(good))

    return run


def _index(shingle: int, percent: int, counters):
    """Per row: set size, node, index keys, sketches, and the mean frequency of its
    tokens, which is largest for the set in the middle of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, classes = counters.value
        for batch in batches:
            for part in _slices(batch, "text"):
                tagged, offsets = token_sets(part.column("text"), shingle)
                tokens = tagged & TOKEN
                keys, ends = prefix_keys(tokens, offsets, classes, percent)
                common = counts[(tokens % U(COUNTERS)).astype(np.int64)].astype(U)
                weight = _sums(common, offsets) / np.maximum(np.diff(offsets), 1)
                bits = parity_bits(tokens, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array(node_of(tokens, offsets)),
                        pa.ListArray.from_arrays(
                            pa.array(ends.astype(np.int32)), pa.array(keys.view(np.int64))
                        ),
                        pa.array(weight.astype(np.float64)),
                        pa.array(token_counts(tokens, offsets), pa.binary()),
                        *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(bits.shape[1])],
                    ],
                    names=["doc_id", "n", "node", "keys", "weight", "counts", *BIT_COLUMNS],
                )

    return run


def _similar(shingle: int, percent: int):
    """Keep the pairs whose sets are similar, on their whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "text_a"):
                one, at_one = token_sets(part.column("text_a"), shingle)
                two, at_two = token_sets(part.column("text_b"), shingle)
                both = np.concatenate((one, two))
                both.sort()
                twice = both[1:][both[1:] == both[:-1]]
                shared = np.bincount((twice >> U(52)).astype(np.int64), minlength=part.num_rows)
                total = np.diff(at_one) + np.diff(at_two) - shared
                good = (100 * shared >= percent * total) & (total > 0)
                yield part.select(["a", "b"]).filter(pa.array(good))

    return run


def _close_enough(a: str, b: str, percent: int):
    """Exact bounds on two sets of sizes a.n, b.n: sizes, then parity bits."""
    size = F.least(f"{a}.n", f"{b}.n") * 100 >= F.greatest(f"{a}.n", f"{b}.n") * percent
    differ = reduce(
        lambda x, y: x + y,
        [F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in BIT_COLUMNS],
    )
    # shared >= p (a + b) / (100 + p), so (a + b) - 2 shared <= (100 - p)(a + b) / (100 + p)
    return size & (
        differ * (100 + percent) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - percent)
    )


def _verified(
    pairs: DataFrame, sets: DataFrame, nodes: DataFrame, source: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """Of pairs of nodes (a, b, and their sizes n_a, n_b), those whose texts are
    similar.  Only texts of pairs that all bounds leave are read."""
    pairs = materialize(pairs.distinct())
    both_long = (F.col("n_a") > LONG_SET) & (F.col("n_b") > LONG_SET)
    counts = sets.filter("counts is not null").select("node", "counts")
    long = (
        pairs.filter(both_long)
        .join(counts.select(F.col("node").alias("a"), F.col("counts").alias("counts_a")), "a")
        .join(counts.select(F.col("node").alias("b"), F.col("counts").alias("counts_b")), "b")
        .select("a", "b", "counts_a", "counts_b")
        .mapInArrow(_counts_close(percent), "a long, b long")
    )
    pairs = materialize(pairs.filter(~both_long).select("a", "b").unionByName(long).distinct())
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = nodes.join(wanted, "node").select("node", "first_id")
    texts = materialize(_texts_of(wanted, source, shingle))
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_similar(shingle, percent), "a long, b long")
        .distinct()
    )


def join(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    *,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (the class of equal sets), label (the group
    of linked classes) and component_id (its smallest doc_id) for every row."""
    spark = docs.sparkSession
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash")
    )
    id_type = source.schema["doc_id"].dataType.simpleString()
    survey = materialize(
        source.mapInArrow(
            _survey(shingle),
            f"doc_id {id_type}, text_hash long, n_shingles long, node long,"
            " block int, counts array<long>",
        )
    )
    counts = token_counters(survey)
    counters = spark.sparkContext.broadcast((counts, frequency_classes(counts)))  # fixed size
    rows = survey.filter("block is null").select(
        "doc_id", "text_hash", "n_shingles", "node"
    )
    nodes = materialize(
        rows.filter("n_shingles > 0")
        .groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows"))
    )
    bits = ", ".join(f"{c} long" for c in BIT_COLUMNS)
    indexed = source.select("doc_id", "text").mapInArrow(
        _index(shingle, percent, counters),
        f"doc_id {id_type}, n long, node long, keys array<long>, weight double,"
        f" counts binary, {bits}",
    ).filter(F.size("keys") > 0)
    # one row per class, that of its smallest id (more only if rows repeat an id)
    sets = materialize(
        indexed.join(
            nodes.select(F.col("node").alias("of"), "first_id"),
            (F.col("node") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
        )
        .drop("of", "doc_id", "first_id")
    )
    slim = ["node", "n", *BIT_COLUMNS]
    by_key = Window.partitionBy("key")
    middle = F.max(F.struct("weight", "node")).over(by_key)["node"]
    members = materialize(
        sets.select(F.explode("keys").alias("key"), "node", "weight")
        .withColumns(
            {
                "low": F.min("node").over(by_key),
                "high": F.max("node").over(by_key),
                "middle": middle,
                # buckets of the same members are one bucket
                "one": F.bit_xor(F.xxhash64("node")).over(by_key),
                "two": F.bit_xor(F.xxhash64(F.lit(1), "node")).over(by_key),
            }
        )
        .filter("low < high")
        .select(F.xxhash64("one", "two").alias("key"), "node", "middle")
        .distinct()
    )
    stars = members.filter("node <> middle").select(
        F.least("node", "middle").alias("a"), F.greatest("node", "middle").alias("b")
    )
    shapes = sets.select(*slim)
    near = (
        stars.distinct()
        .join(shapes.alias("x"), F.col("a") == F.col("x.node"))
        .join(shapes.alias("y"), F.col("b") == F.col("y.node"))
        .filter(_close_enough("x", "y", percent))
        .select("a", "b", F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b"))
    )
    edges = materialize(_verified(near, sets, nodes, source, shingle, percent))
    touched = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = connected_components(touched, edges)
    # what is left: classes that share a key but are not known to be connected
    shown = (
        members.select("key", "node")
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
        .withColumns(
            {
                "low": F.min("label").over(by_key),
                "high": F.max("label").over(by_key),
                "first": F.min("node").over(by_key),
            }
        )
        .filter("low < high")
        # buckets with the same first member are joined to one: alike sets share very
        # many keys, and would meet in each of them
        .select(F.col("first").alias("key"), "node", "label")
        .distinct()
        .join(shapes, "node")
    )
    shown = materialize(shown)
    x, y = shown.alias("x"), shown.alias("y")
    rest = (
        x.join(
            y,
            (F.col("x.key") == F.col("y.key"))
            & (F.col("x.label") < F.col("y.label"))
            & _close_enough("x", "y", percent),
        )
        .select(
            F.col("x.node").alias("a"),
            F.col("y.node").alias("b"),
            F.col("x.n").alias("n_a"),
            F.col("y.n").alias("n_b"),
        )
    )
    later = materialize(_verified(rest, sets, nodes, source, shingle, percent))
    if not later.isEmpty():
        edges = edges.union(later)
        touched = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
        labels = connected_components(touched, edges)
    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    lookup = named.join(least, "label").select("node", "rows", "label", "component_id")
    joined = lookup_join(rows, lookup, ["node"], "rows", LOOKUP_ROWS).drop("rows")
    return joined.withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    )


def _nodes_of(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "text"):
                tagged, offsets = token_sets(part.column("text"), shingle)
                own = pa.array(node_of(tagged & TOKEN, offsets))
                part = part.append_column("own", own)
                yield part.filter(pa.compute.equal(own, part.column("node"))).select(["node", "text"])

    return run


def _texts_of(first_ids: DataFrame, source: DataFrame, shingle: int) -> DataFrame:
    """The text of each class to be verified, that of its smallest id."""
    wanted = materialize(first_ids)
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    return (
        source.join(wanted, F.col("doc_id").eqNullSafe(F.col("first_id")))
        .select("node", "text")
        # an id may be repeated with other texts
        .mapInArrow(_nodes_of(shingle), "node long, text string")
    )


def representatives(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options
) -> DataFrame:
    """The columns of `docs`: of every group of linked documents the row with the
    smallest id; of repeated rows one; rows without words all."""
    found = settled(lambda: join(docs, text, doc_id, **options))
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    linked = found.filter("n_shingles > 0")
    gone = linked.filter(~first).select("doc_id", "text_hash")
    # a group's smallest id may itself be repeated
    repeated = materialize(
        linked.filter(first)
        .groupBy("label")
        .agg(F.count("*").alias("n"), F.min("text_hash").alias("kept"))
        .filter("n > 1")
    )
    again = None
    if not repeated.isEmpty():
        of_repeated = linked.filter(first).join(repeated, "label")
        gone = gone.union(
            of_repeated.filter("text_hash <> kept").select("doc_id", "text_hash")
        )
        again = of_repeated.filter("text_hash = kept").select("doc_id", "text_hash").distinct()
    row_hash = F.xxhash64(F.col(f"d.{text}"))

    def same(side: str):
        return F.col(f"d.{doc_id}").eqNullSafe(F.col(f"{side}.doc_id")) & (
            row_hash == F.col(f"{side}.text_hash")
        )

    def checked(small: DataFrame) -> DataFrame:
        small = materialize(small)
        return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small

    rest = docs.alias("d").join(checked(gone.distinct()).alias("g"), same("g"), "left_anti")
    if again is None:
        return rest
    twice = checked(again)
    single = rest.alias("d").join(twice.alias("r"), same("r"), "left_anti")
    one = rest.alias("d").join(twice.alias("r"), same("r"), "left_semi")
    return single.unionByName(one.dropDuplicates([doc_id, text]))


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    found = join(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")
