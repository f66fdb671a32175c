"""Jobs composed of the operators: what a scheduler would call."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import VIOLENT
from ..operators import clustering, forecasting, hotspots, series
from ..operators.dbscan import dbscan, quality
from ..operators.features import all_features, features_for_storage
from ..operators.filters import enough_rows, spatial_scan
from ..operators.kdistance import tune_dbscan
from ..operators.marts import MART_COLUMNS, MARTS, daily_partials
from ..operators.staging import stage, typed
from ..schema import RAW_PARTITION
from ..session import materialize
from ..sinks import tables
from ..sources import landing

MIN_CLUSTER_ROWS = 100


PARTIALS = "daily_partials"


def build_marts(raw: DataFrame, schema: str) -> DataFrame:
    """Stage, rebuild every mart from the whole history, and return the row counts."""
    return _refresh(raw, stage(raw), schema, whole=True)


def refresh_marts(raw_table: str, schema: str, days: Column) -> DataFrame:
    """Bring the marts up to date after records of some days have come.

    Only these days (a condition on the raw table's partition column) are read; they
    replace their part of the daily partials, from which the marts are rebuilt."""
    raw = SparkSession.active().table(raw_table)
    return _refresh(raw, stage(raw.filter(days)), schema, whole=False)


def _refresh(raw: DataFrame, staged: DataFrame, schema: str, whole: bool) -> DataFrame:
    spark = raw.sparkSession
    tables.create_schema(spark, schema)
    name = f"{schema}.{PARTIALS}"
    fresh = daily_partials(staged.select(*MART_COLUMNS))
    if whole or not spark.catalog.tableExists(name):
        fresh.hint("rebalance", "incident_date").write.mode("overwrite").partitionBy("incident_date").saveAsTable(name)
    else:
        tables.overwrite_days(fresh, name, "incident_date")
    partials = spark.table(name)
    for mart, build in MARTS.items():
        tables.replace_table(build(partials), f"{schema}.{mart}")
    rows = F.count("*")
    counted = {
        "Raw Data": (raw, rows),
        "Staging Data": (partials, F.coalesce(F.sum("n"), F.lit(0))),
        "Crime Types": (spark.table(f"{schema}.crime_type_analysis"), rows),
        "Daily Patterns": (spark.table(f"{schema}.daily_crime_patterns"), rows),
        "Location Analysis": (spark.table(f"{schema}.location_analysis"), rows),
    }
    parts = [
        df.agg(count.alias("record_count")).select(F.lit(label).alias("table_name"), "record_count")
        for label, (df, count) in counted.items()
    ]
    # five rows; later loads replace the tables that they were counted in
    return materialize(reduce(DataFrame.unionByName, parts))


def daily_load(landed: DataFrame, day: date, raw_table: str, schema: str, today: date | None = None, dedupe: bool = False) -> DataFrame:
    """One day's increment: extract, load into the raw table, refresh marts from the
    days that were loaded.

    `landed` holds flat records with a `date` column."""
    rows = materialize(landing.daily_extract(landed, day, today))
    tables.load_daily(rows, raw_table, dedupe)
    loaded = tables.days_of(rows.select(F.to_date("date").alias(RAW_PARTITION)))
    return refresh_marts(raw_table, schema, loaded)


def build_features(raw: DataFrame, table: str) -> DataFrame:
    tables.replace_table(features_for_storage(all_features(typed(raw))), table)
    return raw.sparkSession.table(table)


def spatial_analysis(
    features: DataFrame,
    crime_type: str | None = None,
    time_period: str | None = None,
    as_of: date | None = None,
    violent_only: bool = False,
    k: int | None = None,
    eps: float | None = None,
    min_samples: int | None = None,
    **kmeans_options,
) -> dict[str, object]:
    """Both clusterings with profiles, or {"error": ...} below 100 rows.

    The clustering input is written once; everything reads that table.  Of `eps` and
    `min_samples` a given one is kept (0 included), the other one is tuned."""
    located = materialize(
        spatial_scan(features, crime_type, time_period, as_of, violent_only=violent_only)
    )
    if not enough_rows(located, MIN_CLUSTER_ROWS):
        return {"error": "Insufficient data"}
    gridded = materialize(clustering.grid_features(located))
    scaled = materialize(clustering.standardize(gridded))
    columns = clustering.scaled_names()
    by_kmeans, metrics = clustering.kmeans_labels(scaled, columns, k, **kmeans_options)
    if eps is None or min_samples is None:
        tuned_eps, tuned_min = tune_dbscan(scaled, columns)
        eps = tuned_eps if eps is None else eps
        min_samples = tuned_min if min_samples is None else min_samples
    by_density = dbscan(
        scaled, columns, eps, min_samples, order_by=-F.unix_micros(F.col("date").cast("timestamp"))
    )
    labelled = {"K-means": materialize(by_kmeans), "DBSCAN": materialize(by_density)}
    return {
        "labels": labelled,
        "profiles": {m: materialize(hotspots.cluster_profiles(df)) for m, df in labelled.items()},
        "kmeans_metrics": metrics,
        "dbscan_metrics": {"eps": eps, "min_samples": min_samples, **quality(labelled["DBSCAN"]).first().asDict()},
    }


def save_spatial(result: dict, cluster_table: str, hotspot_table: str, crime_type: str = "ALL", **how) -> None:
    for model, labelled in result["labels"].items():
        tables.save_clusters(labelled, cluster_table, model, crime_type, **how)
        tables.save_hotspots(result["profiles"][model], hotspot_table, model, crime_type, **how)


def violent_spatial_analysis(features: DataFrame, **options) -> dict[str, object]:
    """Clustering of violent incidents only; save it under its own filter name."""
    return spatial_analysis(features, violent_only=True, **options)


def forecasting_pipeline(
    incidents: DataFrame,
    crime_types: list[str] | None = None,
    total: bool = True,
    days_ahead: int = 30,
    period: int = 365,
) -> dict[str, DataFrame]:
    """Summary, stationarity, decomposition, comparison and the forecasts of
    each series' better model, for all series at once."""
    daily = materialize(
        series.daily_series(incidents, crime_types, total=total, per_type=crime_types is not None or not total)
    )
    arima = forecasting.run_model(daily, forecasting.ARIMA, days_ahead)
    additive = forecasting.run_model(daily, forecasting.ADDITIVE, days_ahead)
    fitted = materialize(arima.unionByName(additive))
    metrics = series.forecast_metrics(forecasting.test_rows(fitted))
    best = series.choose_model(metrics)
    chosen = forecasting.future_rows(fitted).join(
        best.filter("models = 2").select("series_id", F.col("best_model").alias("model_type")),
        ["series_id", "model_type"],
    )
    return {
        "data_summary": series.series_summary(daily),
        "stationarity": forecasting.stationarity(daily),
        "decomposition": series.seasonal_decompose(daily, period),
        "fitted": fitted,
        "metrics": metrics,
        "best_model": best,
        "future_forecasts": chosen,
        "errors": fitted.filter("kind = 'error'").select("series_id", "model_type", "error"),
    }


def violent_forecasting(incidents: DataFrame, days_ahead: int = 30) -> dict[str, DataFrame]:
    """The same for each violent type; a type that fails appears in `errors`."""
    return forecasting_pipeline(incidents, list(VIOLENT), total=False, days_ahead=days_ahead)


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None
