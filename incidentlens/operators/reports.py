"""Aggregates for status, validation and dashboard reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def _flag_count(name: str):
    return F.count_if(F.col(name))


def overall_stats(features: DataFrame) -> DataFrame:
    """Totals over the whole feature table, from one (type, day) pre-aggregate,
    so distinct types and days need no expansion of the detail rows."""
    per = features.groupBy("primary_type", F.to_date("date").alias("day")).agg(
        F.count("*").alias("n"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        _flag_count("is_violent_crime").alias("violent"),
        _flag_count("is_property_crime").alias("property"),
        _flag_count("has_coordinates").alias("located"),
        F.sum(F.col("distance_from_center").cast("double")).alias("miles"),
        F.count("distance_from_center").alias("measured"),
    )
    return per.agg(
        F.sum("n").alias("total_records"),
        F.count_distinct("primary_type").alias("crime_types"),
        F.count_distinct("day").alias("days_covered"),
        F.min("first").alias("start_date"),
        F.max("last").alias("end_date"),
        F.sum("violent").alias("violent_crimes"),
        F.sum("property").alias("property_crimes"),
        F.sum("located").alias("with_coordinates"),
        F.try_divide(F.sum("miles"), F.sum("measured")).alias("avg_distance_from_center"),
    )


def type_share(features: DataFrame, places: int = 2) -> DataFrame:
    """Count and share of the total per type.  The total is a scalar over the
    per-type counts, not a window that would gather all types in one task."""
    counts = features.groupBy("primary_type").agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn(
        "percentage", F.round(F.lit(100.0) * F.col("count") / total, places)
    )


def top_types(features: DataFrame, n: int = 10, places: int = 1) -> DataFrame:
    return type_share(features, places).orderBy(F.desc("count"), "primary_type").limit(n)


def _violent_rate(places: int = 1):
    return S.rate_percent(F.count_if(F.col("is_violent_crime")), F.count("*"), places)


def hourly_distribution(features: DataFrame) -> DataFrame:
    return (
        features.groupBy("hour")
        .agg(F.count("*").alias("crimes"), _violent_rate().alias("violent_rate"))
        .orderBy("hour")
    )


def peak_hours(features: DataFrame, n: int = 5) -> DataFrame:
    return hourly_distribution(features).orderBy(F.desc("crimes"), "hour").limit(n)


def distance_bands(features: DataFrame) -> DataFrame:
    return (
        features.filter(F.col("distance_from_center").isNotNull())
        .groupBy(S.distance_band_of(F.col("distance_from_center")).alias("area"))
        .agg(F.count("*").alias("crimes"), _violent_rate().alias("violent_rate"))
        .orderBy(F.desc("crimes"), "area")
    )


def forecast_summary(forecasts: DataFrame) -> DataFrame:
    return (
        forecasts.groupBy("crime_type", "model_type")
        .agg(
            F.count("*").alias("forecast_days"),
            F.min("date").alias("start_date"),
            F.max("date").alias("end_date"),
            F.round(F.avg(F.col("forecast").cast("double")), 1).alias("avg_forecast"),
        )
        .orderBy("crime_type", "model_type")
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def freshness(components: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest value of a time column per component."""
    return _union(
        [
            df.agg(F.max(column).alias("last_update")).select(
                F.lit(name).alias("component"), "last_update"
            )
            for name, (df, column) in components.items()
        ]
    )


def pipeline_status(components: dict[str, DataFrame | None]) -> DataFrame:
    """Row count and state per component; one without a table is an ERROR."""
    present = {name: df for name, df in components.items() if df is not None}
    state = F.when(F.col("records") > 0, "COMPLETE").otherwise("EMPTY")
    out = _union(
        [
            df.agg(F.count("*").alias("records")).select(
                F.lit(name).alias("component"), "records", state.alias("status")
            )
            for name, df in present.items()
        ]
    )
    missing = [(name, None, "ERROR") for name in components if name not in present]
    if missing:
        ddl = "component string, records bigint, status string"
        out = out.unionByName(out.sparkSession.createDataFrame(missing, ddl))
    return out


def overall_status(status: DataFrame) -> DataFrame:
    ready = F.coalesce(F.min(F.coalesce(F.col("records"), F.lit(0))) > 0, F.lit(False))
    return status.agg(
        F.when(ready, "FULLY OPERATIONAL").otherwise("PARTIALLY COMPLETE").alias("status")
    )


def ml_report(features: DataFrame, forecasts: DataFrame, clusters: DataFrame, hotspots: DataFrame) -> DataFrame:
    """One row with the sizes of the result tables."""
    n = lambda df, what: df.agg(what).scalar()
    return (
        features.agg(F.count("*").alias("feature_count"))
        .withColumn("forecast_count", n(forecasts, F.count("*")))
        .withColumn("cluster_count", n(clusters, F.count_distinct("cluster_id")))
        .withColumn("hotspot_count", n(hotspots, F.count("*")))
    )


def feature_profile(features: DataFrame) -> DataFrame:
    """Ranges and rates of the feature table, one row, one pass."""
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    rate = lambda flag: F.avg(F.col(flag).cast("double"))
    ranges = {
        "date": "date",
        "hour": "hour",
        "day_of_week": "day_of_week",
        "latitude": "latitude",
        "longitude": "longitude",
        "distance": "distance_from_center",
        "daily_count": "daily_crime_count",
        "avg_7day": "crimes_7day_avg",
    }
    present = {k: c for k, c in ranges.items() if c in features.columns}
    return features.agg(
        F.count("*").alias("records"),
        *[F.min(c).alias(f"min_{k}") for k, c in present.items()],
        *[F.max(c).alias(f"max_{k}") for k, c in present.items()],
        _flag_count("is_weekend").alias("weekend_crimes"),
        rate("is_weekend").alias("weekend_rate"),
        F.count_if(located).alias("with_coordinates"),
        F.avg(located.cast("double")).alias("coordinate_rate"),
        _flag_count("is_violent_crime").alias("violent_crimes"),
        rate("is_violent_crime").alias("violent_rate"),
        _flag_count("is_property_crime").alias("property_crimes"),
        rate("is_property_crime").alias("property_rate"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("crimes"))


def group_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts by one dimension, nulls left out; optionally the largest `top`."""
    counts = value_counts(df.filter(F.col(column).isNotNull()), column)
    return counts.orderBy(F.desc("crimes"), column).limit(top) if top else counts


def peak_and_share(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value (smallest on a tie) and violent share in percent."""
    counts = df.groupBy(column).agg(
        F.count("*").alias("n"), _flag_count("is_violent_crime").alias("violent")
    )
    return counts.agg(
        F.min_by(
            column,
            F.when(F.col(column).isNotNull(), F.struct(-F.col("n"), F.col(column))),
        ).alias("peak"),
        F.max(F.when(F.col(column).isNotNull(), F.col("n"))).alias("peak_count"),
        F.round(F.lit(100.0) * F.sum("violent") / F.sum("n"), 1).alias("violent_percent"),
    )


def first_last_week(daily: DataFrame, days: int = 7) -> DataFrame:
    """Mean of the first and the last `days` days and the change between them.

    `daily` has one row per day (day, n): the windows are bounded by the calendar."""
    early = F.row_number().over(Window.orderBy("day"))
    late = F.row_number().over(Window.orderBy(F.desc("day")))
    first = F.avg(F.when(F.col("_a") <= days, F.col("n")))
    last = F.avg(F.when(F.col("_z") <= days, F.col("n")))
    return daily.withColumns({"_a": early, "_z": late}).agg(
        F.count("*").alias("days"),
        F.min("day").alias("start_date"),
        F.max("day").alias("end_date"),
        F.min("n").alias("min_daily"),
        F.max("n").alias("max_daily"),
        F.avg("n").alias("avg_daily"),
        first.alias("first_week_avg"),
        last.alias("last_week_avg"),
        ((last - first) / first * 100).alias("trend_percent"),
    )


SERIES_TYPES = ("THEFT", "BATTERY", "CRIMINAL DAMAGE", "NARCOTICS", "ASSAULT")


def series_stats(features: DataFrame, types=SERIES_TYPES) -> DataFrame:
    """Days with incidents and incidents per such day, for named types."""
    return (
        features.filter(F.col("primary_type").isin(*types))
        .groupBy("primary_type", F.to_date("date").alias("day"))
        .agg(F.count("*").alias("n"))
        .groupBy("primary_type")
        .agg(F.count("*").alias("days"), F.avg("n").alias("avg_per_day"))
    )


def grid_profile(located: DataFrame, bins: int = 10) -> DataFrame:
    """Occupied cells of a bins x bins grid, the fullest one, and the mean."""
    span = located.agg(
        F.struct(
            F.min("latitude").alias("lat0"),
            F.max("latitude").alias("lat1"),
            F.min("longitude").alias("lon0"),
            F.max("longitude").alias("lon1"),
        )
    ).scalar()
    s = located.select("latitude", "longitude").withColumn("_s", span)
    return (
        s.groupBy(
            S.equal_width_bin(F.col("latitude"), F.col("_s.lat0"), F.col("_s.lat1"), bins).alias("r"),
            S.equal_width_bin(F.col("longitude"), F.col("_s.lon0"), F.col("_s.lon1"), bins).alias("c"),
        )
        .agg(F.count("*").alias("n"))
        .agg(
            F.count("*").alias("non_empty_cells"),
            F.max("n").alias("max_per_cell"),
            F.avg("n").alias("avg_per_cell"),
        )
    )


def spatial_profile(located: DataFrame) -> DataFrame:
    miles = F.col("distance_from_center").cast("double")
    return located.agg(
        F.count("*").alias("records"),
        *[
            f(c).alias(f"{name}_{c}")
            for c in ("latitude", "longitude")
            for name, f in (("min", F.min), ("max", F.max))
        ],
        F.min(miles).alias("min_distance"),
        F.max(miles).alias("max_distance"),
        F.avg(miles).alias("avg_distance"),
        _flag_count("is_violent_crime").alias("violent_crimes"),
        F.avg(F.col("is_violent_crime").cast("double")).alias("violent_rate"),
    )


def spatial_bounds(located: DataFrame) -> DataFrame:
    return located.agg(
        F.count("*").alias("total_records"),
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.min("latitude").alias("lat_min"),
        F.max("latitude").alias("lat_max"),
        F.min("longitude").alias("lon_min"),
        F.max("longitude").alias("lon_max"),
    )


def random_sample(df: DataFrame, n: int = 5000, seed: int | None = 42, key: str = "id") -> DataFrame:
    """n located rows in random order.  With a seed the order is a digest of the
    seed and the row's key, the same on every run; without one it is random.
    Each partition keeps its own first n, so nothing is sorted as a whole."""
    located = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    order = F.rand() if seed is None else F.md5(F.concat_ws(":", F.lit(seed), F.col(key)))
    return located.orderBy(order, key).limit(n)


def first_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows in an explicit order; rows have none of their own."""
    return df.orderBy(*order).limit(n)


def first_types(df: DataFrame, n: int = 5) -> DataFrame:
    """The n types that appear first."""
    return (
        df.groupBy("primary_type")
        .agg(F.min(F.struct("date", "id")).alias("_seen"))
        .orderBy("_seen")
        .limit(n)
        .select("primary_type")
    )


def risk_table(hotspots: DataFrame) -> DataFrame:
    """The dashboard's zone table, riskiest first."""
    return hotspots.select(
        S.risk_level_of(F.col("risk_score")).alias("Risk Level"),
        F.round("risk_score", 1).alias("Risk Score"),
        F.col("cluster_size").alias("Crime Count"),
        F.col("top_crime_type").alias("Primary Crime Type"),
        F.col("model_type").alias("Detection Model"),
    ).orderBy(F.desc("Risk Score"), "Detection Model", "Crime Count")


def forecast_table(forecasts: DataFrame) -> DataFrame:
    return forecasts.select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        *[F.round(c, 1).alias(c) for c in ("forecast", "lower_ci", "upper_ci")],
    )


def metric_comparison(metrics: DataFrame, models=("ARIMA", "Prophet")) -> DataFrame:
    """Computed model metrics side by side: a row per series and metric."""
    names = [c for c in metrics.columns if c not in ("series_id", "model_type")]
    long = metrics.unpivot(
        ["series_id", "model_type"], [F.col(c).cast("double").alias(c) for c in names], "metric", "value"
    )
    per_model = [
        F.max(F.when(F.col("model_type") == m, F.col("value"))).alias(m) for m in models
    ]
    return long.groupBy("series_id", "metric").agg(*per_model)
