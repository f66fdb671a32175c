"""From the raw envelope to staged text columns and typed incidents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schema import CORRUPT, PAYLOAD, PAYLOAD_FIELDS


PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _parse(raw: DataFrame, keep=None) -> DataFrame:
    """Add `payload`, optionally keeping only records that satisfy `keep`.

    Unnesting a one-element array stops later filters on payload fields from
    being moved below the parse, which would then run once per filter term and
    again for the projection.  So a record is parsed exactly once."""
    parsed = F.array(F.from_json("record_data", PAYLOAD, PARSE_OPTIONS))
    if keep is not None:
        parsed = F.filter(parsed, keep)
    return raw.withColumn("payload", F.explode(parsed))


def _is_record(payload):
    return payload.isNotNull() & payload[CORRUPT].isNull()


def stage(raw: DataFrame) -> DataFrame:
    """Staged incidents: calendar date plus the payload fields as text."""
    gated = raw.filter(
        F.col("id").isNotNull() & F.col("date").isNotNull() & F.col("record_data").isNotNull()
    )
    return _parse(gated).select(
        "id",
        F.to_date("date").alias("incident_date"),
        *[F.col(f"payload.{name}").alias(name) for name in PAYLOAD_FIELDS],
        "loaded_at",
        "source",
    )


def typed(raw: DataFrame) -> DataFrame:
    """Typed incidents; a payload that is not a JSON object is left out."""
    text = lambda name: F.col(f"payload.{name}")
    return _parse(raw, keep=_is_record).select(
        "id",
        "date",
        *[text(n).alias(n) for n in PAYLOAD_FIELDS[:4]],
        S.is_true_text(text("arrest")).alias("arrest"),
        S.is_true_text(text("domestic")).alias("domestic"),
        *[text(n).alias(n) for n in ("beat", "district", "ward", "community_area")],
        S.safe_double(text("latitude")).alias("latitude"),
        S.safe_double(text("longitude")).alias("longitude"),
        S.safe_int(text("year")).alias("year"),
        "loaded_at",
        "source",
    )


REASONS = ("no id", "no date", "no payload", "not an object", "malformed")


def reject_reason(payload) -> Column:
    """Why a record can't be used; null for a good one."""
    text = F.col("record_data")
    no_id, no_date, no_payload, not_an_object, malformed = map(F.lit, REASONS)
    return (
        F.when(F.col("id").isNull(), no_id)
        .when(F.col("date").isNull(), no_date)
        .when(text.isNull(), no_payload)
        .when(~F.ltrim(text).startswith("{"), not_an_object)
        .when(~_is_record(payload), malformed)
    )


def split_records(raw: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Good and rejected records as tables, and how many of each, from one scan.

    The raw rows are parsed once and written once, in two partitions; rejected ones keep
    their text and carry the reason, so that they can be mended and loaded again.  The
    counts are observed while the rows pass by."""
    seen = Observation()
    judged = _parse(raw).withColumn("reason", reject_reason(F.col("payload")))
    judged = judged.withColumn("rejected", F.col("reason").isNotNull()).drop("payload")
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    watched = judged.observe(seen, F.count_if(~F.col("rejected")).alias("good"), *counts)
    watched.write.mode("overwrite").partitionBy("rejected").parquet(path)
    both = raw.sparkSession.read.schema(judged.schema).parquet(path)
    good = both.filter(~F.col("rejected")).select(*raw.columns)
    bad = both.filter("rejected").select(*raw.columns, "reason")
    return good, bad, {k: v for k, v in seen.get.items() if v or k == "good"}


def parse_counts(raw: DataFrame) -> DataFrame:
    """How many records parse and how many are dropped."""
    ok = _is_record(F.col("payload"))
    return _parse(raw).agg(
        F.count_if(ok).alias("parsed"), F.count_if(~ok).alias("dropped")
    )


def create_staging_view(raw: DataFrame, name: str = "stg_incidents") -> int:
    staged = stage(raw)
    staged.createOrReplaceTempView(name)
    return staged.count()
