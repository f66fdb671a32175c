"""Hard negatives: rows of another label that score almost as high as an anchor's
positives, by exact integer inner products.

Components are whole numbers (a multiple of the given ones, rounded down).  Scores come
from tables as in the method of Four Russians: for every group of eight dimensions an
anchor has the sums of all 256 subsets of its components.  A row is kept as bit planes
(two's complement), one byte per plane and group, so a byte of a plane looks up what
these eight dimensions add in that binary place; planes are joined by doubling.  Every
anchor is scored with every row, in blocks of at most 1,024 anchors and 4,096 rows:
scores stay inside a task, which sends on its best few per anchor (ties at the border
included before they are ordered by id, so nothing is lost).  Tables are looked up twice,
for the positives and then for the negatives near each of them.

Cases: ids and labels are whole numbers; rows with a null id, label or vector, or with a null, NaN or infinite component,
take no part; of rows that repeat an id that with the smallest label, then vector, stays;
vectors of different lengths are compared over the components that both have, an empty
one scores 0; scaled components are held within +-2**27 (2**23 beyond 256 dimensions), as
larger ones would give scores beyond a long; equal scores go by id; equal vectors under
many ids are rows like others; an empty table, or one without anchors, gives no rows;
other columns are not looked at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

GROUP = 8  # dimensions in a table
ANCHORS, ROWS = 1_024, 4_096  # in a block
STRIP = 512  # rows scored at once
BOUND, WIDE, WIDE_BOUND = 1 << 27, 256, 1 << 23  # WIDE: dimensions
MOST_TASKS = 8_192


def whole(vector: Column, scale: float) -> Column:
    """Components as whole numbers; null if one of them is null or not finite."""
    x = lambda v: v.cast("double")
    odd = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(x(v)) == float("inf")))
    bound = F.when(F.size(vector) <= WIDE, float(BOUND)).otherwise(float(WIDE_BOUND))
    held = lambda v: F.floor(F.greatest(F.least(x(v) * scale, bound), -bound))
    return F.when(~odd, F.transform(vector, lambda v: held(v).cast("int")))


def matrix(column, dims: int):
    """Lists of numbers as rows of `dims`, zeros beyond a list's end."""
    import numpy as np

    lists = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    offsets = lists.offsets.to_numpy()
    lens = np.diff(offsets)
    out = np.zeros((len(lens), dims), "int64")
    row = np.repeat(np.arange(len(lens)), lens)
    out[row, np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], lens)] = lists.flatten().to_numpy()
    return out


def planes(numbers, bits: int):
    """(rows, bits, groups) bytes: bit j of byte g of plane k is bit k of component 8g+j."""
    import numpy as np

    each = [np.packbits((numbers >> k & 1).astype(bool), axis=1, bitorder="little") for k in range(bits)]
    return np.stack(each, axis=1)


def tables(anchors, dtype):
    """For every group of dimensions the sums of all subsets: (groups, 256, anchors)."""
    import numpy as np

    n, dims = anchors.shape
    groups = -(-dims // GROUP)
    out = np.zeros((groups, 1 << GROUP, n), dtype)
    for d in range(dims):
        group, bit = divmod(d, GROUP)
        out[group, 1 << bit : 2 << bit] = out[group, : 1 << bit] + anchors[:, d].astype(dtype)
    return out


def scores(found, codes):
    """Inner products of rows (their planes) with anchors (their tables)."""
    import numpy as np

    n, bits, groups = codes.shape
    total = np.zeros((n, found.shape[2]), found.dtype)
    part = np.empty_like(total)
    for k in range(bits - 1, -1, -1):
        total <<= 1
        for g in range(groups):
            np.take(found[g], codes[:, k, g], axis=0, out=part)
            # the highest plane is the sign
            (np.subtract if k == bits - 1 else np.add)(total, part, out=total)
    return total


def _pack(bits: int, dims: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            codes = planes(matrix(batch.column("numbers"), dims), bits)
            packed = pa.array([row.tobytes() for row in codes], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), packed], ["id", "label", "planes"]
            )

    return run


class Best:
    """The first `keep` of each of many lists, larger scores first, then smaller ids."""

    def __init__(self, lists: int, keep: int, floor):
        import numpy as np

        self.keep, self.floor = keep, np.array(floor, "int64")
        self.rows = [np.zeros(0, "int64") for _ in range(3)]  # list, score, id

    def add(self, lists, scores, ids) -> None:
        import numpy as np

        if not len(lists):
            return
        rows = [np.concatenate(x) for x in zip(self.rows, (lists, scores.astype("int64"), ids))]
        order = np.lexsort((rows[2], -rows[1], rows[0]))
        rows = [x[order] for x in rows]
        start = np.searchsorted(rows[0], rows[0], "left")
        place = np.arange(len(order)) - start
        self.rows = [x[place < self.keep] for x in rows]
        last = rows[0][place == self.keep - 1]
        self.floor[last] = np.maximum(self.floor[last], rows[1][place == self.keep - 1])


def _positives(keep: int, bits: int, dims: int, dtype: str):
    def best(anchors, labels, ids, found, rows):
        import numpy as np

        least = np.iinfo("int64").min
        top = Best(len(ids), keep, [least] * len(ids))
        for row_ids, row_labels, codes in rows:
            s = scores(found, codes)
            fits = (row_labels[:, None] == labels) & (row_ids[:, None] != ids) & (s >= top.floor)
            r, a = np.nonzero(fits)
            top.add(a, s[r, a], row_ids[r])
        a, score, row = top.rows
        return {"anchor_id": ids[a], "row_id": row, "score": score}

    return _blocks(best, bits, dims, dtype)


def _negatives(keep: int, bits: int, dims: int, dtype: str, low: int, high: int):
    def best(anchors, labels, ids, found, rows):
        import numpy as np

        pairs = [(k, p["row_id"], p["score"]) for k, ps in enumerate(anchors["positives"]) for p in ps]
        of, named, score = (np.array(x, "int64") for x in zip(*pairs)) if pairs else [np.zeros(0, "int64")] * 3
        # low * p <= 100 * n <= high * p, in whole numbers
        lowest, highest = -(-low * score // 100), high * score // 100
        top = Best(len(of), keep, lowest)
        for row_ids, row_labels, codes in rows:
            s = scores(found, codes)
            s[row_labels[:, None] == labels] = np.iinfo(s.dtype).min
            wide = s[:, of]
            r, p = np.nonzero((wide >= top.floor) & (wide <= highest))
            top.add(p, wide[r, p], row_ids[r])
        p, found_score, row = top.rows
        return {
            "anchor_id": ids[of[p]], "positive_id": named[p], "positive_score": score[p],
            "row_id": row, "score": found_score,
        }

    return _blocks(best, bits, dims, dtype)


def _blocks(best, bits: int, dims: int, dtype: str):
    def run(key, left, right):
        import numpy as np
        import pyarrow as pa

        found = tables(matrix(left.column("numbers"), dims), dtype)
        anchors = {c: left.column(c).to_pylist() for c in left.column_names if c == "positives"}
        ids = right.column("id").to_numpy()
        labels = right.column("label").to_numpy()
        data = b"".join(right.column("planes").to_pylist())
        codes = np.frombuffer(data, "uint8").reshape(len(ids), bits, -(-dims // GROUP))
        strips = ((ids[i : i + STRIP], labels[i : i + STRIP], codes[i : i + STRIP]) for i in range(0, len(ids), STRIP))
        done = best(anchors, left.column("label").to_numpy(), left.column("id").to_numpy(), found, strips)
        return pa.table({k: pa.array(np.asarray(v, "int64")) for k, v in done.items()})

    return run


def _in_blocks(anchors: DataFrame, rows: DataFrame, counts: tuple[int, int], run, schema: str) -> DataFrame:
    """Every block of anchors with every block of rows."""
    many = [max(1, -(-n // size)) for n, size in zip(counts, (ANCHORS, ROWS))]
    block = lambda k: F.pmod(F.xxhash64("id"), F.lit(many[k]))
    other = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many[k] - 1).cast("long")))
    tasks = min(4 * many[0] * many[1], MOST_TASKS)
    left = anchors.withColumn("a", block(0)).withColumn("r", other(1))
    right = rows.withColumn("r", block(1)).withColumn("a", other(0))
    left, right = (x.repartition(tasks, "a", "r").groupBy("a", "r") for x in (left, right))
    return left.cogroup(right).applyInArrow(run, schema)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    doc_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for every
    anchor and each of its best `positives` rows of its label, the best `negatives` rows
    of other labels with `low` to `high` percent of the positive's score.  `is_anchor` may
    use the columns of `rows`."""
    usable = rows.select(
        F.col(doc_id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        whole(F.col(vector), scale).alias("numbers"),
        is_anchor.alias("is_anchor"),
    ).dropna(subset=["id", "label", "numbers"])
    first = usable.groupBy("id").agg(F.min(F.struct("label", "numbers", "is_anchor")).alias("x"))
    table = materialize(first.select("id", "x.*"))
    size = F.array_max(F.transform("numbers", lambda v: F.abs(v)))
    most, dims, n = table.agg(F.max(size), F.max(F.size("numbers")), F.count("*")).first()
    most, dims = most or 0, max(dims or 0, 1)
    bits = most.bit_length() + 1
    dtype = "int32" if dims * (most + 1) ** 2 < 2**31 else "int64"
    anchors = table.filter("is_anchor").drop("is_anchor")
    counts = (anchors.count(), n)
    packed = materialize(
        table.select("id", "label", "numbers").mapInArrow(_pack(bits, dims), "id long, label long, planes binary")
    )
    near = _in_blocks(
        anchors, packed, counts, _positives(positives, bits, dims, dtype), "anchor_id long, row_id long, score long"
    )
    chosen = materialize(_first(near, ["anchor_id"], positives).drop("rank"))
    told = chosen.groupBy(F.col("anchor_id").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("row_id", "score"))).alias("positives")
    )
    hard = _in_blocks(
        anchors.join(told, "id"), packed, counts, _negatives(negatives, bits, dims, dtype, low, high),
        "anchor_id long, positive_id long, positive_score long, row_id long, score long",
    )
    return _first(hard, ["anchor_id", "positive_id", "positive_score"], negatives).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("row_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _first(found: DataFrame, of: list[str], keep: int) -> DataFrame:
    order = Window.partitionBy(*of).orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


SQL = """
WITH used AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM used a JOIN used b ON a.id % 100 = 0 AND a.id <> b.id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
