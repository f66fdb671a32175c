"""Profiles and risk scores of clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .marts import _mode


def cluster_profiles(labelled: DataFrame, wrap_night: bool = False) -> DataFrame:
    """One row per cluster (noise left out) with its make-up and risk score.

    All statistics are map-side partial aggregates, so a cluster holding most of
    the rows is no special case; modes come from (cluster, value) counts."""
    rows = labelled.filter(F.col("cluster_id") != -1)
    share = lambda flag: F.avg(F.col(flag).cast("double"))
    num = lambda name: F.col(name).cast("double")
    base = rows.groupBy("cluster_id").agg(
        F.count("*").alias("size"),
        F.avg(num("latitude")).alias("center_lat"),
        F.avg(num("longitude")).alias("center_lon"),
        F.stddev_samp(num("latitude")).alias("lat_std"),
        F.stddev_samp(num("longitude")).alias("lon_std"),
        share("is_violent_crime").alias("violent_crime_ratio"),
        share("is_property_crime").alias("property_crime_ratio"),
        F.avg(num("distance_from_center")).alias("avg_distance_from_center"),
        share("is_weekend").alias("weekend_ratio"),
        (F.avg("grid_crime_count") / F.max("grid_crime_count")).alias("density"),
        F.avg(S.is_night_hour(F.col("hour"), wrap_night).cast("double")).alias("night_ratio"),
        F.array_sort(F.collect_set("district_num")).alias("districts"),
    )
    by_type = rows.groupBy("cluster_id", "primary_type").agg(F.count("*").alias("n"))
    kinds = by_type.groupBy("cluster_id").agg(
        _mode("primary_type", "n").alias("top_crime_type"),
        F.map_from_entries(
            F.collect_list(
                F.when(F.col("primary_type").isNotNull(), F.struct("primary_type", "n"))
            )
        ).alias("crime_types"),
    )
    peaks = (
        rows.groupBy("cluster_id", "hour")
        .agg(F.count("*").alias("n"))
        .groupBy("cluster_id")
        .agg(_mode("hour", "n").alias("peak_hour"))
    )
    return (
        base.join(kinds, "cluster_id")
        .join(peaks, "cluster_id")
        .withColumn("risk_score", risk_score())
        .orderBy(F.desc("risk_score"), "cluster_id")
    )


def risk_score():
    """Weighted size, violence, density and night terms, not capped at 100."""
    return F.round(
        100
        * (
            0.3 * F.least(F.col("size") / 100, F.lit(1.0))
            + 0.4 * 2 * F.col("violent_crime_ratio")
            + 0.2 * F.col("density")
            + 0.1 * F.col("night_ratio")
        ),
        2,
    )


def hotspot_summary(profiles: DataFrame, k: int = 5) -> DataFrame:
    """One row: how many hotspots fall in each risk class, and the top k."""
    score = F.col("risk_score")
    top = top_hotspots(profiles, k).select(
        F.struct(
            F.col("risk_score"),
            F.col("cluster_id"),
            F.col("location"),
            F.col("size"),
            F.col("top_crime_type").alias("top_crime"),
            F.col("violent_ratio"),
        ).alias("h")
    )
    top = top.agg(F.sort_array(F.collect_list("h"), asc=False).alias("top_hotspots")).scalar()
    return profiles.agg(
        F.count("*").alias("total_hotspots"),
        F.count_if(score > 70).alias("high_risk_hotspots"),
        F.count_if(score.between(40, 70)).alias("medium_risk_hotspots"),
        F.count_if(score < 40).alias("low_risk_hotspots"),
    ).withColumn("top_hotspots", top)


def top_hotspots(profiles: DataFrame, k: int = 5, above: float | None = None) -> DataFrame:
    """The k riskiest hotspots, with position and violent share as text."""
    rows = profiles.filter(F.col("risk_score") > above) if above is not None else profiles
    return (
        rows.orderBy(F.desc("risk_score"), "cluster_id")
        .limit(k)
        .select(
            "cluster_id",
            S.location_text(F.col("center_lat"), F.col("center_lon")).alias("location"),
            "size",
            "risk_score",
            "top_crime_type",
            S.percent_text(F.col("violent_crime_ratio")).alias("violent_ratio"),
        )
    )


def with_risk_level(hotspots: DataFrame) -> DataFrame:
    return hotspots.withColumn("risk_level", S.risk_level_of(F.col("risk_score")))


def hotspot_kpis(hotspots: DataFrame) -> DataFrame:
    """Critical and high counts, mean and maximum risk with its model."""
    score = F.col("risk_score")
    return hotspots.agg(
        F.count("*").alias("hotspots"),
        F.count_if(score >= 80).alias("critical_zones"),
        F.count_if(score >= 60).alias("high_zones"),
        F.round(F.avg(score), 1).alias("average_risk"),
        F.max(score).alias("highest_risk"),
        F.max_by("model_type", F.struct(score, "model_type")).alias("highest_risk_model"),
    )


def risk_histogram(hotspots: DataFrame, bins: int = 10) -> DataFrame:
    """Hotspots per model and equal-width risk bin (the maximum in the last)."""
    span = hotspots.agg(
        F.struct(F.min("risk_score").alias("lo"), F.max("risk_score").alias("hi"))
    ).scalar()
    lo, hi = F.col("_s.lo").cast("double"), F.col("_s.hi").cast("double")
    width = F.when(hi > lo, (hi - lo) / bins).otherwise(F.lit(1.0))
    return (
        hotspots.withColumn("_s", span)
        .withColumn(
            "bin",
            F.least(F.floor((F.col("risk_score").cast("double") - lo) / width), F.lit(bins - 1)).cast("int"),
        )
        .groupBy("model_type", "bin")
        .agg(F.count("*").alias("hotspots"))
    )


def clusters_per_model(clusters: DataFrame) -> DataFrame:
    """Distinct clusters (noise counts as one) and rows of each model."""
    return (
        clusters.groupBy("model_type", "cluster_id")
        .agg(F.count("*").alias("n"))
        .groupBy("model_type")
        .agg(F.count("*").alias("clusters"), F.sum("n").alias("total_records"))
    )
