"""Reporting tables over staged incidents.

Each mart first collapses the detail rows to small (group, type) counts with
map-side partial aggregation; modes, distinct counts and rates are then taken
from those counts.  No group of detail rows is ever brought into one task, so a
type, day or place that holds a large share of the rows costs no more than any
other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import materialize


def _rows(df: DataFrame) -> Column:
    """Number of incidents: of detail rows, or of daily partials (which carry `n`)."""
    return F.sum("n") if "n" in df.columns else F.count("*")


def _count_true(df: DataFrame, flag: str) -> Column:
    return F.sum(f"{flag}_n") if "n" in df.columns else F.count_if(F.col(flag) == "true")


def daily_partials(staged: DataFrame) -> DataFrame:
    """Mergeable aggregates of a day: counts by type, place, district and ward.

    All marts can be built from these rows as from the detail rows, and the rows of one
    day depend on that day's records alone."""
    return staged.groupBy(*PARTIAL_KEYS).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("arrest") == "true").alias("arrest_n"),
        F.count_if(F.col("domestic") == "true").alias("domestic_n"),
    )


def _mode(value: str, count: str) -> Column:
    """Most frequent non-null value; the smallest one on a tie."""
    return F.min_by(
        value,
        F.when(F.col(value).isNotNull(), F.struct(-F.col(count), F.col(value))),
    )


def crime_type_analysis(staged: DataFrame) -> DataFrame:
    n = F.col("total_incidents")
    return (
        staged.filter(F.col("primary_type").isNotNull())
        .groupBy("primary_type")
        .agg(
            _rows(staged).alias("total_incidents"),
            _count_true(staged, "arrest").alias("arrests_made"),
            _count_true(staged, "domestic").alias("domestic_incidents"),
            F.min("incident_date").alias("earliest_incident"),
            F.max("incident_date").alias("latest_incident"),
        )
        .select(
            "primary_type",
            "total_incidents",
            "arrests_made",
            "domestic_incidents",
            S.rate_percent(F.col("arrests_made"), n).alias("arrest_rate_percent"),
            S.rate_percent(F.col("domestic_incidents"), n).alias("domestic_rate_percent"),
            "earliest_incident",
            "latest_incident",
        )
    )


def daily_patterns(staged: DataFrame) -> DataFrame:
    """Per day: totals, distinct types, mode type, distinct districts and wards.

    Detail rows are compacted to (day, type, district, ward) counts; each of
    these then counts once for its type, its district and its ward, which turns
    three distinct counts and a mode into plain aggregates of one pipeline."""
    measures = ("n", "arrests", "domestics")
    cube = staged.groupBy("incident_date", "primary_type", "district", "ward").agg(
        _rows(staged).alias("n"),
        _count_true(staged, "arrest").alias("arrests"),
        _count_true(staged, "domestic").alias("domestics"),
    )
    views = [
        F.struct(F.lit(name).alias("of"), F.col(name).alias("value"))
        for name in ("primary_type", "district", "ward")
    ]
    per_value = (
        cube.select("incident_date", *measures, F.explode(F.array(*views)).alias("v"))
        .groupBy("incident_date", F.col("v.of").alias("of"), F.col("v.value").alias("value"))
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    is_type = F.col("of") == "primary_type"
    known = F.col("value").isNotNull()
    total = lambda m: F.sum(F.when(is_type, F.col(m)))
    return (
        per_value.groupBy("incident_date")
        .agg(
            total("n").alias("total_incidents"),
            F.count_if(is_type & known).alias("unique_crime_types"),
            total("arrests").alias("arrests_made"),
            total("domestics").alias("domestic_incidents"),
            F.min_by("value", F.when(is_type & known, F.struct(-F.col("n"), "value"))).alias(
                "most_common_crime"
            ),
            F.count_if((F.col("of") == "district") & known).alias("districts_affected"),
            F.count_if((F.col("of") == "ward") & known).alias("wards_affected"),
        )
        .orderBy(F.desc("incident_date"))
    )


def location_analysis(staged: DataFrame, min_incidents: int = 2) -> DataFrame:
    place = ["location_description", "district", "ward"]
    return (
        staged.filter(F.col("location_description").isNotNull())
        .groupBy(*place, "primary_type")
        .agg(_rows(staged).alias("n"), _count_true(staged, "arrest").alias("arrests"))
        .groupBy(*place)
        .agg(
            F.sum("n").alias("total_incidents"),
            F.sum("arrests").alias("arrests_made"),
            _mode("primary_type", "n").alias("most_common_crime"),
        )
        .filter(F.col("total_incidents") >= min_incidents)
        .withColumn(
            "arrest_rate_percent",
            S.rate_percent(F.col("arrests_made"), F.col("total_incidents")),
        )
        .orderBy(F.desc("total_incidents"), *place)
    )


def monthly_trends(staged: DataFrame) -> DataFrame:
    """Per month totals, three-row moving average and the row twelve back.

    The windows run over one row per month, so their single partition is
    bounded by the calendar, not by the data."""
    in_order = Window.orderBy("month")
    n, before = F.col("total_incidents"), F.col("same_month_prev_year")
    return (
        staged.groupBy(F.trunc("incident_date", "month").alias("month"), "primary_type")
        .agg(_rows(staged).alias("n"), _count_true(staged, "arrest").alias("arrests"))
        .groupBy("month")
        .agg(
            F.sum("n").alias("total_incidents"),
            F.sum("arrests").alias("arrests_made"),
            F.count("primary_type").alias("unique_crime_types"),
        )
        .select(
            "month",
            F.year("month").cast("long").alias("year"),
            F.month("month").cast("long").alias("month_num"),
            "total_incidents",
            "arrests_made",
            "unique_crime_types",
            S.rate_percent(F.col("arrests_made"), n).alias("arrest_rate_percent"),
            F.avg(n).over(in_order.rowsBetween(-2, 0)).alias("three_month_avg"),
            F.lag(n, 12).over(in_order).alias("same_month_prev_year"),
        )
        .withColumn("yoy_change_percent", S.change_percent(n, before))
        .orderBy(F.desc("month"))
    )


def yoy_by_type(staged: DataFrame) -> DataFrame:
    by_year = Window.partitionBy("primary_type").orderBy("year")
    c = F.col
    return (
        staged.filter(c("primary_type").isNotNull())
        .groupBy(F.year("incident_date").cast("long").alias("year"), "primary_type")
        .agg(_rows(staged).alias("incidents"), _count_true(staged, "arrest").alias("arrests"))
        .withColumn("arrest_rate", S.rate_percent(c("arrests"), c("incidents")))
        .withColumns(
            {
                f"prev_year_{m}": F.lag(m).over(by_year)
                for m in ("incidents", "arrests", "arrest_rate")
            }
        )
        .filter(c("prev_year_incidents").isNotNull())
        .withColumns(
            {
                "yoy_incident_change_percent": S.change_percent(
                    c("incidents"), c("prev_year_incidents")
                ),
                "yoy_arrest_change_percent": S.change_percent(
                    c("arrests"), c("prev_year_arrests")
                ),
                "incident_change_absolute": c("incidents") - c("prev_year_incidents"),
                "arrest_change_absolute": c("arrests") - c("prev_year_arrests"),
                # both rates carry two places; rounding removes binary residue
                "arrest_rate_change_points": F.round(
                    c("arrest_rate") - c("prev_year_arrest_rate"), 2
                ),
            }
        )
        .orderBy(F.desc("year"), F.desc("incidents"), "primary_type")
    )


def seasonal_yoy(staged: DataFrame) -> DataFrame:
    by_year = Window.partitionBy("season").orderBy("year")
    c = F.col
    return (
        staged.groupBy(
            F.year("incident_date").cast("long").alias("year"),
            S.season_of(F.month("incident_date")).alias("season"),
            "primary_type",
        )
        .agg(_rows(staged).alias("n"), _count_true(staged, "arrest").alias("arrests"))
        .groupBy("year", "season")
        .agg(
            F.sum("n").alias("total_incidents"),
            F.sum("arrests").alias("arrests_made"),
            F.count("primary_type").alias("unique_crime_types"),
            _mode("primary_type", "n").alias("most_common_crime"),
        )
        .withColumn(
            "arrest_rate_percent", S.rate_percent(c("arrests_made"), c("total_incidents"))
        )
        .withColumn("prev_year_incidents", F.lag("total_incidents").over(by_year))
        .withColumn(
            "yoy_seasonal_change_percent",
            S.change_percent(c("total_incidents"), c("prev_year_incidents")),
        )
        .orderBy(F.desc("year"), S.season_rank(c("season")))
    )


def trend_classification(staged: DataFrame) -> DataFrame:
    """Counts of the latest year and the two calendar years before it, per type.

    Everything comes from one (type, year) count, written once because the
    years, their maximum and the counts are all taken from it; the latest three
    years present are a three-row semi-join side."""
    c = F.col
    per_year = materialize(
        staged.groupBy(
            "primary_type", F.year("incident_date").cast("long").alias("year")
        ).agg(_rows(staged).alias("n"))
    )
    recent = per_year.select("year").distinct().orderBy(F.desc("year")).limit(3)
    latest = recent.agg(F.max("year")).scalar()
    of_year = lambda back: F.coalesce(F.sum(F.when(c("year") == c("latest") - back, c("n"))), F.lit(0))
    return (
        per_year.filter(c("primary_type").isNotNull())
        .join(F.broadcast(recent), "year", "left_semi")
        .withColumn("latest", latest)
        .groupBy("primary_type")
        .agg(
            of_year(0).alias("current_year_incidents"),
            of_year(1).alias("prev_year_incidents"),
            of_year(2).alias("two_years_ago_incidents"),
        )
        .filter(c("prev_year_incidents") > 0)
        .withColumns(
            {
                "yoy_change_percent": S.change_percent(
                    c("current_year_incidents"), c("prev_year_incidents")
                ),
                "two_year_change_percent": S.change_percent(
                    c("current_year_incidents"), c("two_years_ago_incidents")
                ),
                "trend_category": S.trend_of(
                    c("current_year_incidents"), c("prev_year_incidents")
                ),
            }
        )
        .orderBy(F.desc_nulls_last("yoy_change_percent"), "primary_type")
    )


def top_movers(staged: DataFrame, k: int = 5) -> DataFrame:
    """The k fastest growing and the k fastest declining types."""
    trend = materialize(trend_classification(staged)).filter(F.col("yoy_change_percent").isNotNull())
    columns = ["primary_type", "yoy_change_percent", "current_year_incidents", "prev_year_incidents"]

    def ranked(label: str, order: Column) -> DataFrame:
        return (
            trend.orderBy(order, "primary_type")
            .limit(k)
            .select(F.lit(label).alias("analysis_type"), *columns)
        )

    return ranked("Top Growing Crime Types", F.desc("yoy_change_percent")).unionByName(
        ranked("Top Declining Crime Types", F.asc("yoy_change_percent"))
    )


PARTIAL_KEYS = ("incident_date", "primary_type", "location_description", "district", "ward")

MART_COLUMNS = (
    "incident_date",
    "primary_type",
    "location_description",
    "district",
    "ward",
    "arrest",
    "domestic",
)

MARTS = {
    "crime_type_analysis": crime_type_analysis,
    "daily_crime_patterns": daily_patterns,
    "location_analysis": location_analysis,
    "monthly_trends": monthly_trends,
    "yoy_crime_type_analysis": yoy_by_type,
    "seasonal_yoy_analysis": seasonal_yoy,
    "crime_trend_analysis": trend_classification,
}


def analytics_summary(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Row counts of the raw and staged data and of three marts."""
    parts = {
        "Raw Data": raw,
        "Staging Data": staged,
        "Crime Types": crime_type_analysis(staged),
        "Daily Patterns": daily_patterns(staged),
        "Location Analysis": location_analysis(staged),
    }
    counts = [
        df.agg(F.count("*").alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count"
        )
        for name, df in parts.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out
