"""Approximate nearest neighbours by a hash-prefix forest.

Every vector has a string of 32 bits per tree, the sides of random hyperplanes on which
it lies.  A tree is the sorted order of these strings, so the vectors that share a
prefix with a query are one stretch of it.  Search starts at the depth at which
stretches are about as large as a block and ascends in all trees together, bit by
bit pairs, for the queries that need more candidates.  All candidates of a stretch are
scored by their exact cosine, block by block, in double precision.

A query is done when a neighbour at least as near as its last one is missed in all
trees with a probability under `miss`: at depth d a vector at angle a shares a prefix in
one of t trees but for (1 - (1 - a/pi)^d)^t.  At depth 0 every vector is a candidate,
so recall does not depend on how the vectors lie; easy data end early.

Stretches larger than a block are split, and their queries go to every part.  Equal
vectors are one entry of the index with their smallest ids, however many they are.

Cases: vectors that are null, empty, zero, or hold null or non-finite components take no
part, nor do rows without id; vectors are compared with those of the same length only;
fewer candidates than asked for are all returned; ties go to the smaller id; rows that
repeat id and vector count once; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .wordhash import U, mix

TREES = 24
BITS = 32
STEP = 2
BLOCK = 2_048
PART = 8_192
MISS = 0.05
SALTS = 64
BROADCAST_ROWS = 200_000
GROUP = ["dim", "tree", "prefix"]


def planes(dim: int, trees: int, bits: int) -> np.ndarray:
    return np.random.default_rng([7, dim]).standard_normal((dim, trees * bits))


def _matrix(column, rows: np.ndarray, dim: int) -> np.ndarray:
    """The vectors of the given rows, all of length `dim`, as doubles."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    return flat[offsets[rows][:, None] + np.arange(dim)]


def _hashed(trees: int, bits: int):
    """Valid vectors with their length, a 128-bit key of their components, and their
    strings, one number per tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            size = np.diff(column.offsets.to_numpy())
            size = np.where(np.asarray(column.is_valid()), size, 0)
            for dim in np.unique(size[size > 0]):
                rows = np.flatnonzero(size == dim)
                vectors = _matrix(column, rows, int(dim))
                good = np.isfinite(vectors).all(1) & (vectors != 0).any(1)
                rows, vectors = rows[good], vectors[good] + 0.0  # no negative zeros
                if len(rows) == 0:
                    continue
                raw = mix(vectors.view(U) + U(1))
                odd = np.random.default_rng(3).integers(0, 2**63, (2, int(dim)), U) * U(2) + U(1)
                keys = [mix((raw * odd[i]).sum(1, dtype=U)).view(np.int64) for i in (0, 1)]
                side = (vectors @ planes(int(dim), trees, bits) > 0).reshape(-1, trees, bits)
                strings = side @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))
                ends = np.arange(len(rows) + 1, dtype=np.int32) * trees
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(rows)),
                        pa.array(np.full(len(rows), dim, np.int32)),
                        pa.array(keys[0]),
                        pa.array(keys[1]),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(dim)),
                            pa.array(vectors.ravel()),
                        ),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(strings.ravel())),
                    ],
                    names=["vec_id", "dim", "k1", "k2", "vector", "strings"],
                )

    return run


def _members(hashed: DataFrame, k: int) -> DataFrame:
    """The smallest k + 1 ids of every distinct vector.  A vector may have very many
    rows, so they are first reduced within salted parts."""
    ids = hashed.select("dim", "k1", "k2", "vec_id").distinct()
    salted = ids.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    key = ["dim", "k1", "k2"]
    place = F.row_number().over(Window.partitionBy(*key, "salt").orderBy("vec_id"))
    few = salted.withColumn("place", place).filter(F.col("place") <= k + 1)
    return few.groupBy(*key).agg(
        F.slice(F.sort_array(F.collect_list("vec_id")), 1, k + 1).alias("ids")
    )


def _scored(keep: int):
    """The best candidates of every query in one part of a stretch."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        is_query = table.column("is_query").to_numpy()
        ids = table.column("vec_id").to_numpy()
        column = table.column("vector")
        column = column.chunk(0) if column.num_chunks else column
        dim = table.column("dim")[0].as_py()
        queries, rows = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        rows = rows[np.argsort(ids[rows])]
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(queries) and len(rows):
            vectors = _matrix(column, rows, dim)
            norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            parts = []
            for lo in range(0, len(queries), 256):
                own = queries[lo : lo + 256]
                asked = _matrix(column, own, dim)
                about = asked @ (vectors / norms[:, None]).T
                n = min(keep + 2, len(rows))  # two to spare for the order of near ties
                best = np.argpartition(-about, n - 1, axis=1)[:, :n]
                one, other = np.repeat(asked, n, 0), vectors[best.ravel()]
                length = np.sqrt(np.einsum("ij,ij->i", one, one)) * norms[best.ravel()]
                exact = np.einsum("ij,ij->i", one, other) / length
                parts.append((np.repeat(ids[own], n), ids[rows][best.ravel()], exact))
            out = [np.concatenate(x) for x in zip(*parts)]
        return pa.table(
            {
                "query_id": pa.array(out[0], pa.int64()),
                "vec_id": pa.array(out[1], pa.int64()),
                "score": pa.array(out[2], pa.float64()),
            }
        )

    return run


def _best(found: DataFrame, keep: int) -> DataFrame:
    place = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    )
    distinct = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return distinct.withColumn("place", place).filter(F.col("place") <= keep)


def _search(entries: DataFrame, queries: DataFrame, depth: int, bits: int, keep: int) -> DataFrame:
    """Candidates that share `depth` bits with a query in some tree, scored."""

    def spread(df: DataFrame) -> DataFrame:
        return df.select(
            "dim", "vec_id", "vector", F.posexplode("strings").alias("tree", "string")
        ).select(
            "dim", "vec_id", "vector", "tree", F.shiftright("string", bits - depth).alias("prefix")
        )

    slim = [c for c in ("dim", "vec_id", "strings")]
    of_queries = spread(queries.select(*slim, F.lit(None).alias("vector"))).select(*GROUP).distinct()
    sizes = spread(entries.select(*slim, F.lit(None).alias("vector"))).groupBy(*GROUP).count()
    stretches = materialize(
        sizes.join(of_queries, GROUP)
        .withColumn("parts", F.ceil(F.col("count") / PART).cast("int"))
        .drop("count")
    )
    if stretches.count() <= BROADCAST_ROWS:
        stretches = F.broadcast(stretches)
    rows = (
        spread(entries)
        .join(stretches, GROUP)
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        .withColumn("is_query", F.lit(False))
    )
    asked = (
        spread(queries)
        .join(stretches, GROUP)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("is_query", F.lit(True))
    )
    columns = [*GROUP, "part", "is_query", "vec_id", "vector"]
    return (
        rows.select(*columns)
        .unionByName(asked.select(*columns))
        .groupBy(*GROUP, "part")
        .applyInArrow(_scored(keep), "query_id long, vec_id long, score double")
    )


def search(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    trees: int = TREES,
    miss: float = MISS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for which the
    condition `is_query` (on the id, named vec_id) holds."""
    source = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")
    ).filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    hashed = materialize(
        source.mapInArrow(
            _hashed(trees, BITS),
            "vec_id long, dim int, k1 long, k2 long, vector array<double>, strings array<long>",
        )
    )
    key = ["dim", "k1", "k2"]
    members = materialize(_members(hashed, k))
    firsts = members.select(*key, F.col("ids")[0].alias("vec_id"))
    entries = materialize(
        hashed.join(firsts, [*key, "vec_id"]).dropDuplicates([*key, "vec_id"])
    )
    asked = hashed.filter(is_query).select(*key, "vec_id").distinct()
    owners = materialize(
        asked.withColumnRenamed("vec_id", "asked_id").join(
            firsts.withColumnRenamed("vec_id", "entry_id"), key
        )
    )
    queries = materialize(
        entries.join(
            owners.select(*key, F.col("entry_id").alias("vec_id")).distinct(), [*key, "vec_id"]
        )
    )
    keep = k + 1  # a query's own vector is among them
    count = entries.count()
    depth = min(BITS, max(0, int(np.log2(max(1, count / BLOCK)))))
    best = None
    while True:
        found = _search(entries, queries, depth, BITS, keep)
        if best is not None:
            found = found.unionByName(best.select("query_id", "vec_id", "score"))
        best = materialize(_best(found, keep))
        if depth == 0:
            break
        last = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s"))
        near = 1 - F.acos(F.least(F.greatest("s", F.lit(-1.0)), F.lit(1.0))) / np.pi
        missed = F.pow(1 - F.pow(near, F.lit(depth)), F.lit(trees))
        done = last.filter((F.col("n") >= keep) & (missed <= miss)).select(
            F.col("query_id").alias("vec_id")
        )
        queries = materialize(queries.join(done, "vec_id", "left_anti"))
        if queries.isEmpty():
            break
        depth = max(0, depth - STEP)
    listed = (
        best.join(members.select(F.col("ids")[0].alias("vec_id"), "ids"), "vec_id")
        .select(F.col("query_id").alias("entry_id"), F.explode("ids").alias("vec_id"), "score")
        .distinct()
    )
    place = F.row_number().over(
        Window.partitionBy("query_id", *key).orderBy(F.col("score").desc(), "vec_id")
    )
    return (
        owners.withColumnRenamed("asked_id", "query_id")
        .join(listed, "entry_id")
        .filter(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", place)
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    table = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(table, F.col("vec_id") % 50 == 0)
