"""Sharding by Karmarkar-Karp differencing.

Texts that are equal form a group that must not be divided.  Differencing starts
with one partial partition per group (its bytes in one part, the others empty) and
repeatedly combines the two with the largest spread, the heavier parts of one with
the lighter parts of the other.  Here it runs in levels: groups are dealt to chunks
of bounded size, every chunk is differenced by one task into one partial partition,
and these are differenced again, a bounded number at a time, until one is left.
Rows then learn the part of their group and a gapless slot in it.

Cases: a null text has no bytes and forms a group; empty texts form another;
repeated rows are rows of their own; an empty table gives an empty result; a group
larger than a part fills that part alone."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scale import lookup_join
from ..session import materialize

SHARDS = 24
OVERHEAD = 8
CHUNK_GROUPS = 20_000
FAN_IN = 256
ROWS_PER_SLOT_BLOCK = 20_000


def difference(vectors: list[list[int]]) -> list[list[int]]:
    """Karmarkar-Karp over partial partitions with the same number of parts.

    Returns for every input the part of the result that each of its parts went
    to.  Ties are broken by position, so the result is reproducible."""
    parts = len(vectors[0])
    sums, steps = [], []  # nodes: inputs first, then combined ones
    for vector in vectors:
        order = sorted(range(parts), key=lambda i: (-vector[i], i))
        sums.append([vector[i] for i in order])
        steps.append(order)
    heap = [(s[-1] - s[0], k) for k, s in enumerate(sums)]
    heapq.heapify(heap)
    children = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        joint = [x + y for x, y in zip(sums[a], reversed(sums[b]))]
        order = sorted(range(parts), key=lambda i: (-joint[i], i))
        sums.append([joint[i] for i in order])
        sums[a] = sums[b] = None
        steps.append(order)
        children.append((a, b))
        heapq.heappush(heap, (sums[-1][-1] - sums[-1][0], len(sums) - 1))
    goes = [None] * len(steps)
    goes[-1] = list(range(parts))
    for node in range(len(steps) - 1, len(vectors) - 1, -1):
        a, b = children[node - len(vectors)]
        into = [0] * parts
        for place, i in enumerate(steps[node]):
            into[i] = goes[node][place]
        goes[a], goes[b] = into, into[::-1]
        goes[node] = None
    out = []
    for k in range(len(vectors)):
        into = [0] * parts
        for place, i in enumerate(steps[k]):
            into[i] = goes[k][place]
        out.append(into)
    return out


def _difference_groups(shards: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bytes", "key"], ascending=[False, True])
        vectors = [[b] + [0] * (shards - 1) for b in rows["bytes"].tolist()]
        return pd.DataFrame(
            {
                "key": rows["key"],
                "bytes": rows["bytes"],
                "rows": rows["rows"],
                "node": rows["node"],
                "part": np.array([m[0] for m in difference(vectors)], "int32"),
            }
        )

    return run


def _difference_nodes(shards: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        nodes = sorted(set(rows["node"]))
        at = {node: k for k, node in enumerate(nodes)}
        vectors = [[0] * shards for _ in nodes]
        for node, part, total in zip(rows["node"], rows["part"], rows["bytes"]):
            vectors[at[node]][part] = int(total)
        moved = difference(vectors)
        return pd.DataFrame(
            {
                "node": np.repeat(np.array(nodes, "int64"), shards),
                "part": np.tile(np.arange(shards, dtype="int32"), len(nodes)),
                "up": rows["up"].iloc[0],
                "goes": np.array(moved, "int32").ravel(),
            }
        )

    return run


def assign(groups: DataFrame, shards: int = SHARDS, chunk: int = CHUNK_GROUPS) -> DataFrame:
    """`key`, `rows`, `shard` for groups of (`key`, `bytes`, `rows`)."""
    groups = materialize(groups)
    chunks = max(1, -(-groups.count() // chunk))
    parted = materialize(
        groups.withColumn("node", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(chunks)))
        .groupBy("node")
        .applyInPandas(
            _difference_groups(shards), "key long, bytes long, rows long, node long, part int"
        )
    )
    maps = []
    level = parted.groupBy("node", "part").agg(F.sum("bytes").alias("bytes"))
    nodes = chunks
    while nodes > 1:
        up = F.floor(F.col("node") / FAN_IN).cast("long")
        step = materialize(
            level.withColumn("up", up)
            .groupBy("up")
            .applyInPandas(_difference_nodes(shards), "node long, part int, up long, goes int")
        )
        maps.append(step)
        level = (
            level.join(step, ["node", "part"])
            .groupBy(F.col("up").alias("node"), F.col("goes").alias("part"))
            .agg(F.sum("bytes").alias("bytes"))
        )
        nodes = -(-nodes // FAN_IN)
    if not maps:
        return parted.select("key", "rows", F.col("part").alias("shard"))
    final = maps[-1].select("node", "part", F.col("goes").alias("shard"))
    for step in reversed(maps[:-1]):  # the maps are (nodes x shards) small rows
        final = step.join(
            final.select(F.col("node").alias("up"), F.col("part").alias("goes"), "shard"),
            ["up", "goes"],
        ).select("node", "part", "shard")
    return parted.join(final, ["node", "part"]).select("key", "rows", "shard")


def with_slots(rows: DataFrame, shard: str, total: int, order: list[str]) -> DataFrame:
    """Number the rows of each shard from 0 without a gap: blocks of a hash are
    numbered by themselves and start where the blocks before them end."""
    blocks = max(1, -(-total // (SHARDS * ROWS_PER_SLOT_BLOCK)))
    blocked = rows.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocked.groupBy(shard, "_block")
        .agg(F.count("*").alias("_n"))
        .select(shard, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    )
    inside = Window.partitionBy(shard, "_block").orderBy(*order)
    return (
        blocked.withColumn("_k", F.row_number().over(inside))
        .join(starts, [shard, "_block"])
        .withColumn("slot", (F.col("_from") + F.col("_k") - 1).cast("long"))
        .drop("_block", "_k", "_from")
    )


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    text: str = "text",
    doc_id: str = "doc_id",
    chunk: int = CHUNK_GROUPS,
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row."""
    value = F.col(text)
    rows = materialize(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.coalesce(F.octet_length(value), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
            F.crc32(value).alias("text_crc32"),
            F.xxhash64(value).alias("key"),
        )
    )
    groups = rows.groupBy("key").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows")
    )
    placed = lookup_join(rows, assign(groups, shards, chunk), ["key"], "rows").drop("rows")
    placed = materialize(placed)
    return with_slots(placed, "shard", rows.count(), ["doc_id", "key", "size"]).drop("key")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return shard(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
