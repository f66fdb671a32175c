"""Connected components by repeated contraction of the edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Label every node (column `node`, a string) with one node of its component.

    `edges` has columns `a`, `b`.  In each round every node hooks on to its
    smallest neighbour if that is smaller than itself, chains of hooks are
    shortened, and edges are rewritten between the surviving roots; with node
    names in random order about half of the connected roots vanish per round, so
    the edge list shrinks geometrically.  Each round is cut off by a table."""
    labels = nodes.select("node", F.col("node").alias("label"))
    live = _simple(edges)
    live = materialize(live)
    while not live.isEmpty():
        parent = _hooks(live)
        labels = materialize(_follow(labels, parent, "label"))
        live = materialize(_simple(_follow(_follow(live, parent, "a"), parent, "b")))
    return labels


def _simple(edges: DataFrame) -> DataFrame:
    """Both directions of every edge between different nodes, once."""
    there = edges.select("a", "b")
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return there.unionByName(back).filter(F.col("a") != F.col("b")).distinct()


def _hooks(live: DataFrame) -> DataFrame:
    """node -> ancestor for every node that hooks; ancestors are followed until
    they are roots of this round (hooks only go down, so this ends)."""
    parent = materialize(
        live.groupBy("a").agg(F.min("b").alias("p")).filter(F.col("p") < F.col("a"))
    )
    while True:
        up = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        jumped = parent.join(up, "p", "left").select(
            "a",
            F.coalesce("pp", "p").alias("p"),
            F.col("pp").isNotNull().alias("moved"),
        )
        jumped = materialize(jumped)
        parent = jumped.select("a", "p")
        if jumped.filter("moved").isEmpty():
            return parent


def _follow(df: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Replace `column` by its ancestor.  One name may stand in very many rows;
    each is looked up in a table with unique keys, so the skewed side is only
    ever the streamed one and adaptive execution can split it."""
    up = parent.select(F.col("a").alias(column), F.col("p").alias("_p"))
    return df.join(up, column, "left").select(
        *[
            F.coalesce("_p", column).alias(c) if c == column else F.col(c)
            for c in df.columns
        ]
    )
