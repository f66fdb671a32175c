"""Temporal, spatial, crime and lag features of typed incidents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schema import FEATURE_TYPES
from ..session import materialize
from .scale import lookup_join


def temporal_features(df: DataFrame, wrap_night: bool = False) -> DataFrame:
    weekday = F.weekday("date")
    hour = F.hour("date")
    return df.withColumns(
        {
            "hour": hour,
            "day_of_week": weekday,
            "day_of_month": F.dayofmonth("date"),
            "month": F.month("date"),
            "quarter": F.quarter("date"),
            "week_of_year": F.weekofyear("date"),
            "is_weekend": weekday >= 5,
            "is_night": S.is_night_hour(hour, wrap_night),
            "is_rush_hour": S.is_rush_hour(hour),
            "season": S.season_of(F.month("date")),
            "time_period": S.time_period_of(hour),
        }
    )


def spatial_features(df: DataFrame, center=S.CITY_CENTER) -> DataFrame:
    lat, lon = F.col("latitude"), F.col("longitude")
    codes = {
        f"{name}_num": S.safe_double(F.col(name))
        for name in ("district", "beat", "ward", "community_area")
    }
    return df.withColumns(
        {
            "has_coordinates": lat.isNotNull() & lon.isNotNull(),
            **codes,
            "location_type": S.location_type_of(F.col("location_description")),
            "distance_from_center": S.haversine_miles(lat, lon, center),
        }
    )


def crime_categories(df: DataFrame) -> DataFrame:
    """Category and flags; needs no shuffle."""
    kind = F.col("primary_type")
    return df.withColumns(
        {
            "crime_category": S.crime_category_of(kind),
            "is_violent_crime": S.is_in(kind, S.VIOLENT),
            "is_property_crime": S.is_in(kind, S.PROPERTY),
            "is_drug_crime": S.is_in(kind, S.DRUG),
        }
    )


def arrest_rates(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("primary_type").isNotNull())
        .groupBy("primary_type")
        .agg(
            F.count("*").alias("_n"),
            F.avg(F.col("arrest").cast("double")).alias("crime_type_arrest_rate"),
        )
    )


def crime_features(df: DataFrame) -> DataFrame:
    """Categories plus the arrest rate of the record's own type."""
    return lookup_join(crime_categories(df), arrest_rates(df), ["primary_type"], "_n").drop("_n")


def _trailing(daily: DataFrame) -> DataFrame:
    """Trailing means over the days present.

    The window runs over one row per day, bounded by the calendar."""
    in_order = Window.orderBy("day")
    return daily.withColumns(
        {
            f"crimes_{n}day_avg": F.avg("daily_crime_count").over(in_order.rowsBetween(1 - n, 0))
            for n in (7, 30)
        }
    )


def daily_counts(df: DataFrame) -> DataFrame:
    """Incidents per calendar day with trailing means."""
    return _trailing(
        df.groupBy(F.to_date("date").alias("day")).agg(F.count("*").alias("daily_crime_count"))
    )


def lag_features(df: DataFrame) -> DataFrame:
    with_day = df.withColumn("day", F.to_date("date"))
    return lookup_join(with_day, daily_counts(df), ["day"], "daily_crime_count").drop("day")


def all_features(typed: DataFrame, wrap_night: bool = False) -> DataFrame:
    """The full 43-column feature set.

    Both lookups (rates by type, counts by day) come from one small aggregate by type and
    day, which is written once; so the JSON is parsed for that and for the rows
    themselves, which are never shuffled."""
    arrest = F.col("arrest").cast("double")
    by_both = materialize(
        typed.groupBy("primary_type", F.to_date("date").alias("day")).agg(
            F.count("*").alias("n"), F.sum(arrest).alias("arrests"), F.count(arrest).alias("known")
        )
    )
    rates = (
        by_both.filter(F.col("primary_type").isNotNull())
        .groupBy("primary_type")
        .agg(
            F.sum("n").alias("_n"),
            F.try_divide(F.sum("arrests"), F.sum("known")).alias("crime_type_arrest_rate"),
        )
    )
    daily = _trailing(by_both.groupBy("day").agg(F.sum("n").alias("daily_crime_count")))
    df = spatial_features(temporal_features(typed, wrap_night))
    df = lookup_join(crime_categories(df), rates, ["primary_type"], "_n")
    df = lookup_join(df.withColumn("day", F.to_date("date")), daily, ["day"], "daily_crime_count")
    order = [c for c in FEATURE_TYPES if c != "created_at"]
    return df.select(*order)


def row_features(typed: DataFrame, wrap_night: bool = False) -> DataFrame:
    """The features that depend on the record alone; no shuffle, no lookup."""
    return crime_categories(spatial_features(temporal_features(typed, wrap_night)))


def quantize(df: DataFrame, types: dict[str, str] = FEATURE_TYPES) -> DataFrame:
    """Round every known column to its storage type, half away from zero."""

    def stored(name: str):
        target = types[name]
        col = F.col(name)
        if target == "int":
            col = F.round(col)
        return col.cast(target).alias(name)

    return df.select(*[stored(c) if c in types else F.col(c) for c in df.columns])


def features_for_storage(features: DataFrame) -> DataFrame:
    stamped = features.withColumn("created_at", F.current_timestamp().cast("timestamp_ntz"))
    return quantize(stamped.select(*FEATURE_TYPES))
