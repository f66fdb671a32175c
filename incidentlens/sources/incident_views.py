"""Raw incident records derived from the generated `events` and `orders` tables.

The tables have no coordinates or offence names, so these are computed from
their own columns.  Records leave here in the landed form, a JSON payload
inside the five-column envelope, and go through staging like any other source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import widen

TYPE_BY_EVENT = {
    "click": "THEFT",
    "view": "BATTERY",
    "purchase": "NARCOTICS",
    "signup": "BURGLARY",
    "error": "ASSAULT",
}
PLACES = ("STREET", "RESIDENCE", "APARTMENT", "RETAIL STORE", "AIRPORT")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = widen(table(spark, sf_dir, "events"))
    k = F.get_json_object("props", "$.k").cast("long")
    eid, uid = F.col("event_id"), F.col("user_id")
    kind = F.when(k % 10 == 9, "OTHER OFFENSE")
    for event_type, name in TYPE_BY_EVENT.items():
        kind = kind.when(F.col("event_type") == event_type, name)
    place = F.get(F.array(*map(F.lit, PLACES)), (eid % 6).cast("int"))
    lat = F.lit(41.65) + (uid % 7) * F.lit(0.06) + ((eid * 37) % 100) / F.lit(10000.0)
    lat = F.when(eid % 101 == 0, None).when(eid % 97 == 0, lat + 1.0).otherwise(lat)
    lon = F.lit(-87.85) + (uid % 5) * F.lit(0.07) + ((eid * 53) % 100) / F.lit(10000.0)
    payload = F.struct(
        F.concat(F.lit("IC"), F.lpad(eid.cast("string"), 9, "0")).alias("case_number"),
        kind.alias("primary_type"),
        F.col("event_type").alias("description"),
        place.alias("location_description"),
        (k % 4 == 0).alias("arrest"),
        (k % 5 == 0).alias("domestic"),
        uid.cast("string").alias("beat"),
        F.lpad((uid % 25).cast("string"), 3, "0").alias("district"),
        (uid % 50).cast("string").alias("ward"),
        (uid % 77).cast("string").alias("community_area"),
        F.year("ts").cast("string").alias("year"),
        lat.alias("latitude"),
        lon.alias("longitude"),
    )
    return ev.select(
        eid.cast("string").alias("id"),
        F.col("ts").alias("date"),
        F.coalesce(F.to_json(payload), F.lit("{}")).alias("record_data"),
        F.col("ts").alias("loaded_at"),
        F.lit("events").alias("source"),
    )


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = widen(table(spark, sf_dir, "orders"))
    cust = F.col("o_custkey")
    payload = F.struct(
        F.col("o_orderpriority").alias("primary_type"),
        (F.col("o_orderstatus") == "F").alias("arrest"),
        (F.col("o_orderstatus") == "P").alias("domestic"),
        (cust % 25).cast("string").alias("district"),
        (cust % 50).cast("string").alias("ward"),
        F.year("o_orderdate").cast("string").alias("year"),
    )
    return od.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").alias("date"),
        F.coalesce(F.to_json(payload), F.lit("{}")).alias("record_data"),
        F.col("o_orderdate").alias("loaded_at"),
        F.lit("orders").alias("source"),
    )


def lineitem_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place per line item (order, line, part, supplier), mostly distinct ones: a third lie in one crowded block,
    the others in 34 blocks around it.  Blocks are squares of 0.01 degrees."""
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    part = F.col("l_partkey")
    block = F.when(part % 3 == 0, 0).otherwise(1 + part % 34)
    within = lambda a, b, m: ((key * a + part * b) % m) % 100003 / F.lit(1e7)
    named = (key * 100_000 + part) * 10_000 + F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        named.cast("long").alias("id"),
        (F.lit(41.65) + (block % 7) * F.lit(0.06) + within(48271, 16807, 2147483647)).alias("latitude"),
        (F.lit(-87.85) + F.floor(block / 7) * F.lit(0.07) + within(69621, 40692, 2147483399)).alias("longitude"),
    ).distinct()


def damaged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events of which some are cut off, empty, no JSON object, or without id or date."""
    raw = events_raw(spark, sf_dir)
    kind = F.col("id").cast("long") % 23
    text = F.col("record_data")
    damaged = (
        F.when(kind == 0, F.substring(text, 1, 40))
        .when(kind == 1, None)
        .when(kind == 2, F.lit("[1, 2]"))
        .when(kind == 3, F.lit("plain text"))
        .when(kind == 4, F.lit(""))
        .otherwise(text)
    )
    return raw.select(
        F.when(kind != 5, F.col("id")).alias("id"),
        F.when(kind != 6, F.col("date")).alias("date"),
        damaged.alias("record_data"),
        "loaded_at",
        "source",
    )
