"""Daily count series: loading, decomposition, accuracy, comparison.

All series are processed together, keyed by `series_id`.  A series has one row
per calendar day, so per-series windows and groups are bounded by the calendar;
detail rows are reduced to daily counts by partial aggregation first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOTAL = "ALL"


def daily_by_type(incidents: DataFrame, crime_types=None) -> DataFrame:
    """Counts per (type, calendar day)."""
    rows = incidents
    if crime_types is not None:
        rows = rows.filter(F.col("primary_type").isin(*crime_types))
    return rows.groupBy("primary_type", F.to_date("date").alias("date")).agg(
        F.count("*").alias("n")
    )


def daily_series(
    incidents: DataFrame, crime_types: list[str] | None = None, total: bool = True, per_type: bool = True
) -> DataFrame:
    """(series_id, date, y) without gaps: days between a series' first and last
    day that have no incident get 0.  `total` adds the sum of all types: the
    small per-type counts are counted once more for it, not the detail rows."""
    named = [F.col("primary_type")] if per_type else []
    belongs_to = F.array_compact(F.array(*named, *([F.lit(TOTAL)] if total else [])))
    present = (
        daily_by_type(incidents, crime_types)
        .select(F.explode(belongs_to).alias("series_id"), "date", "n")
        .groupBy("series_id", "date")
        .agg(F.sum("n").alias("n"))
    )
    return fill_gaps(present)


def fill_gaps(present: DataFrame) -> DataFrame:
    """Each present day also emits the empty days up to the next one, so the
    calendar needs no join."""
    after = F.lead("date").over(Window.partitionBy("series_id").orderBy("date"))
    until = F.coalesce(F.date_sub("_next", 1), F.col("date"))
    return (
        present.withColumn("_next", after)
        .withColumn("_day", F.explode(F.sequence("date", until)))
        .select(
            "series_id",
            F.col("_day").alias("date"),
            F.when(F.col("_day") == F.col("date"), F.col("n")).otherwise(0).cast("double").alias("y"),
        )
    )


def series_summary(series: DataFrame) -> DataFrame:
    return series.groupBy("series_id").agg(
        F.count("*").alias("total_observations"),
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.avg("y").alias("mean_daily"),
        F.stddev_samp("y").alias("std_daily"),
    )


def seasonal_decompose(series: DataFrame, period: int = 365) -> DataFrame:
    """Additive decomposition with a centred moving average.

    An even period takes half weight on the two outer days.  A series shorter
    than two periods keeps its rows with null parts and a reason in `error`."""
    by_date = Window.partitionBy("series_id").orderBy("date")
    whole = Window.partitionBy("series_id")
    half = period // 2
    inner = F.sum("y").over(by_date.rowsBetween(-half, half))
    if period % 2 == 0:
        ends = (F.lag("y", half).over(by_date) + F.lead("y", half).over(by_date)) / 2
        inner = inner - ends
    numbered = series.withColumns(
        {
            "_i": F.row_number().over(by_date) - 1,
            "_n": F.count("*").over(whole),
            "_sum": inner,
        }
    )
    usable = (F.col("_n") >= 2 * period) & F.col("_i").between(half, F.col("_n") - 1 - half)
    phase = Window.partitionBy("series_id", "_phase")
    parts = numbered.withColumns(
        {"trend": F.when(usable, F.col("_sum") / period), "_phase": F.col("_i") % period}
    ).withColumn("_raw", F.avg(F.col("y") - F.col("trend")).over(phase))
    # mean over phases, each counted once: its first row stands for it
    one_each = F.when(F.col("_i") < period, F.col("_raw"))
    return (
        parts.withColumn("seasonal", F.col("_raw") - F.avg(one_each).over(whole))
        .withColumn("residual", F.col("y") - F.col("trend") - F.col("seasonal"))
        .select(
            "series_id",
            "date",
            "y",
            "trend",
            "seasonal",
            "residual",
            F.when(
                F.col("_n") < 2 * period,
                F.format_string(f"needs {2 * period} days, has %d", "_n"),
            ).alias("error"),
        )
    )


def chronological_split(series: DataFrame, share: float = 0.8) -> DataFrame:
    """Mark the first floor(share * n) days of each series as training days."""
    whole = Window.partitionBy("series_id")
    by_date = whole.orderBy("date")
    return series.withColumn(
        "is_train",
        F.row_number().over(by_date) <= F.floor(F.count("*").over(whole) * share),
    )


def forecast_metrics(scored: DataFrame, infinite_mape: bool = False) -> DataFrame:
    """MAE, RMSE and MAPE of (series_id, model_type, y, yhat).

    Days with an actual of zero have no percentage error: they are left out of
    the MAPE and counted, or make it infinite if `infinite_mape`."""
    off = F.col("y") - F.col("yhat")
    relative = F.when(F.col("y") != 0, F.abs(off / F.when(F.col("y") != 0, F.col("y"))))
    zero_days = F.count_if(F.col("y") == 0)
    mape = F.avg(relative) * 100
    if infinite_mape:
        mape = F.when(zero_days > 0, F.lit(float("inf"))).otherwise(mape)
    return scored.groupBy("series_id", "model_type").agg(
        F.avg(F.abs(off)).alias("mae"),
        F.sqrt(F.avg(off * off)).alias("rmse"),
        mape.alias("mape"),
        zero_days.alias("zero_days"),
        F.count("*").alias("test_days"),
    )


def choose_model(metrics: DataFrame) -> DataFrame:
    """Model with the lowest mean of MAE and RMSE; on a tie the later name, so
    that ARIMA has to be strictly better."""
    score = (F.col("mae") + F.col("rmse")) / 2
    scored = metrics.withColumn("score", score)
    best = F.struct(-F.col("score"), F.col("model_type"))
    return scored.groupBy("series_id").agg(
        F.max_by("model_type", best).alias("best_model"),
        F.min("score").alias("best_score"),
        F.count("*").alias("models"),
    )
