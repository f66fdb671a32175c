import random

import pytest
from incidentlens.operators.components import connected_components
from incidentlens.operators.scale import (
    block_join,
    dense_numbers,
    exact_median,
    lookup_join,
    running_total,
    with_neighbours,
)
from pyspark.sql import functions as F


@pytest.fixture
def skewed(spark):
    # a third of all rows under one key, one null key, the rest spread out
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") == 1, None).otherwise(F.col("id").cast("string"))
    return spark.range(3000).select("id", key.alias("key")).repartition(8)


@pytest.mark.parametrize("max_rows", [10_000, 0])
def test_lookup_join_paths_agree(skewed, max_rows):
    lookup = skewed.groupBy("key").agg(F.count("*").alias("n"), F.sum("id").alias("s")).filter("key is null or key != '2'")
    out = lookup_join(skewed, lookup, ["key"], "n", max_rows=max_rows, hot_share=100)
    assert out.columns == ["id", "key", "n", "s"]
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 3000
    assert rows[0].n == 1000 and rows[1].s == 1 and rows[2].n is None and rows[4].s == 4


def test_large_lookup_broadcasts_hot_keys_only(skewed):
    lookup = skewed.groupBy("key").agg(F.count("*").alias("n"))
    plan = lookup_join(skewed, lookup, ["key"], "n", max_rows=0, hot_share=100)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") >= 1


def test_block_join_with_a_hot_key(spark):
    rows = spark.range(2000).select(F.lit("k").alias("key"), F.col("id").alias("v"), F.lit(2000).cast("bigint").alias("size"))
    probes = spark.createDataFrame([("k", 5, 2000), ("k", 7, 2000)], "key string, p long, size long")
    out = block_join(probes, rows, ["key"], "size", per_block=100)
    assert out.count() == 4000 and out.select("p", "v").distinct().count() == 4000
    assert "_block" not in out.columns


def test_running_total_and_numbers(spark):
    values = [v * 1.5 for v in range(500)]
    df = spark.createDataFrame([(v, i % 4 + 1) for i, v in enumerate(values)], "v double, w long").repartition(5)
    got = {r.v: r.through for r in running_total(df, "v", F.col("w")).collect()}
    total = 0
    for i, v in enumerate(values):
        total += i % 4 + 1
        assert got[v] == total
    ties = spark.createDataFrame([(v // 3, f"n{v:03d}") for v in range(100)], "g long, name string")
    numbered = dense_numbers(ties, "g", "name", "k").collect()
    assert [r.g for r in sorted(numbered, key=lambda r: r.k)] == sorted(v // 3 for v in range(100))
    assert sorted(r.k for r in numbered) == list(range(100))
    tied = dense_numbers(ties.withColumn("g", F.lit(7)), "g", "name", "k").collect()
    assert sorted(r.k for r in tied) == list(range(100))


def test_neighbouring_values(spark):
    values = sorted(random.Random(1).sample(range(10_000), 300))
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {r.v: (r.p, r.n) for r in with_neighbours(df, "v", "p", "n").collect()}
    for i, v in enumerate(values):
        before = float(values[i - 1]) if i else None
        after = float(values[i + 1]) if i + 1 < len(values) else None
        assert got[v] == (before, after)


@pytest.mark.parametrize("values,median", [([1, 2, 3], 2.0), ([1, 2, 3, 10], 2.5), ([5, 5, 5, 1], 5.0), ([None, 7], 7.0), ([None], None)])
def test_exact_median(spark, values, median):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v double")
    assert exact_median(df, "v") == median
    if median is not None:
        assert exact_median(df, "v", max_values=0) == median


def test_components_of_path_star_and_loners(spark):
    edges = [(f"p{i}", f"p{i + 1}") for i in range(60)] + [("hub", f"s{i}") for i in range(50)] + [("x", "x")]
    random.Random(2).shuffle(edges)
    names = sorted({n for e in edges for n in e} | {"alone"})
    nodes = spark.createDataFrame([(n,) for n in names], "node string")
    out = connected_components(nodes, spark.createDataFrame(edges, "a string, b string"))
    groups = {}
    for r in out.collect():
        groups.setdefault(r.label, set()).add(r.node)
    sizes = sorted(map(len, groups.values()))
    assert sizes == [1, 1, 51, 61]
    assert all(label in members for label, members in groups.items())


def test_scratch_is_cleared():
    """In a session of its own folder name, since others still read theirs."""
    from unittest.mock import MagicMock

    from incidentlens import session

    spark = MagicMock()
    spark.conf.get.return_value = "/shared/"
    spark.sparkContext.applicationId = "app-1"
    session.clear_scratch(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    path.assert_called_once_with("/shared/incidentlens/app-1")
    path.return_value.getFileSystem.return_value.delete.assert_called_once()


def test_cluster_session_needs_a_shared_folder():
    from unittest.mock import MagicMock

    from incidentlens import session

    spark = MagicMock()
    spark.conf.get.return_value = None
    spark.sparkContext.getCheckpointDir.return_value = None
    spark.sparkContext.master = "yarn"
    with pytest.raises(ValueError):
        session.scratch_dir(spark)


def test_slices_follow_the_rows():
    from incidentlens.operators import scale

    assert scale.slices_for(0) == scale.MIN_SLICES
    assert scale.slices_for(100 * scale.SLICE_ROWS) == 100
    assert scale.slices_for(10**12) == scale.MAX_SLICES


def test_order_is_the_same_for_any_number_of_slices(spark, monkeypatch):
    from pyspark.sql import functions as F

    from incidentlens.operators import scale

    df = spark.range(500).select((F.col("id") * 7 % 1009).alias("v"))
    found = []
    for n in (1, 3, 64):
        monkeypatch.setattr(scale, "slices_for", lambda rows, n=n: n)
        found.append(
            (
                sorted(map(tuple, scale.running_total(df, "v", F.col("v")).collect())),
                sorted(map(tuple, scale.with_neighbours(df, "v", "p", "n").collect()), key=repr),
            )
        )
    assert found[0] == found[1] == found[2]
