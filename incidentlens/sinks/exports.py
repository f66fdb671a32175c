"""CSV and JSON exports with a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import reports
from ..session import materialize

FEATURE_EXPORT = (
    "id",
    "date",
    "primary_type",
    "latitude",
    "longitude",
    "district_num",
    "is_violent_crime",
    "is_property_crime",
    "crime_category",
    "distance_from_center",
    "hour",
    "day_of_week",
    "is_weekend",
    "season",
    "daily_crime_count",
    "crimes_7day_avg",
)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def feature_sample(features: DataFrame, n: int = 5000, seed: int | None = 42) -> DataFrame:
    return reports.random_sample(features, n, seed).select(*FEATURE_EXPORT)


def hotspot_export(hotspots: DataFrame) -> DataFrame:
    return hotspots.select(
        "cluster_id",
        "model_type",
        "risk_score",
        "cluster_size",
        "top_crime_type",
        F.col("center_latitude").alias("lat"),
        F.col("center_longitude").alias("lon"),
        "violent_crime_ratio",
        "property_crime_ratio",
        "peak_hour",
        "weekend_ratio",
    ).orderBy(F.desc("risk_score"), "model_type", "cluster_id")


def forecast_export(forecasts: DataFrame) -> DataFrame:
    return forecasts.select(
        "date", "forecast", "lower_ci", "upper_ci", "model_type", "crime_type"
    ).orderBy("crime_type", "date", "model_type")


def summary_document(features: DataFrame, model_performance: DataFrame | None = None) -> DataFrame:
    """One nested row: overall figures, distribution by type and by hour, and
    the computed model metrics.  The lists hold one entry per type and hour."""
    overall = reports.overall_stats(features).drop("days_covered")
    kinds = reports.type_share(features).agg(
        F.array_sort(
            F.collect_list(F.struct("primary_type", "count", "percentage")),
            lambda a, b: F.when(a["count"] != b["count"], (b["count"] - a["count"]).cast("int"))
            .when(a["primary_type"] < b["primary_type"], -1)
            .otherwise(1),
        )
    )
    hours = reports.hourly_distribution(features).agg(
        F.sort_array(F.collect_list(F.struct("hour", "crimes", "violent_rate")))
    )
    out = overall.select(F.struct("*").alias("overall_stats")).withColumns(
        {"crime_distribution": kinds.scalar(), "hourly_distribution": hours.scalar()}
    )
    if model_performance is not None:
        metrics = model_performance.agg(
            F.sort_array(F.collect_list(F.struct(*model_performance.columns)))
        )
        out = out.withColumn("model_performance", metrics.scalar())
    return out


def manifest(features: DataFrame, sample: DataFrame, hotspots: DataFrame, forecasts: DataFrame) -> DataFrame:
    n = lambda df: df.agg(F.count("*")).scalar()
    described = lambda df, unit: F.concat_ws(" ", n(df).cast("string"), F.lit(unit))
    summary = reports.overall_stats(features)
    return summary.select(
        F.current_timestamp().alias("export_date"),
        F.struct(
            described(sample, "records (sample)").alias("crime_features"),
            described(hotspots, "hotspots").alias("crime_hotspots"),
            described(forecasts, "forecasts").alias("crime_forecasts"),
            F.lit("overall figures and model performance").alias("summary_stats"),
        ).alias("files"),
        F.struct(
            F.col("total_records").alias("total_original_records"),
            F.concat_ws(" to ", F.col("start_date").cast("string"), F.col("end_date").cast("string")).alias("date_range"),
            "crime_types",
            n(hotspots).alias("hotspots_identified"),
            n(forecasts).alias("forecasts_generated"),
        ).alias("data_summary"),
    )


def export_all(
    features: DataFrame,
    hotspots: DataFrame,
    forecasts: DataFrame,
    folder: str,
    model_performance: DataFrame | None = None,
    sample_size: int = 5000,
) -> None:
    sample = materialize(feature_sample(features, sample_size))
    write_csv(sample, f"{folder}/crime_features")
    write_csv(hotspot_export(hotspots), f"{folder}/crime_hotspots")
    write_csv(forecast_export(forecasts), f"{folder}/crime_forecasts")
    documents = {
        "summary_stats": summary_document(features, model_performance),
        "manifest": manifest(features, sample, hotspots, forecasts),
    }
    for name, document in documents.items():
        document.write.mode("overwrite").json(f"{folder}/{name}")
