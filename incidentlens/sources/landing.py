"""Landed records and exported files.

Extracts are half-open time ranges on the envelope's `date`, so they are pushed
to the Parquet scan; there is one range filter, never a loop over days, and no
implicit row limit."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schema import CORRUPT, RAW, RAW_PARTITION


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Raw envelope rows; an absent or empty location gives no rows."""
    try:
        return spark.read.format(fmt).schema(RAW).load(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RAW)


def between(raw: DataFrame, start: date, stop: date, limit: int | None = None) -> DataFrame:
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    rows = raw.filter((F.col("date") >= at(start)) & (F.col("date") < at(stop)))
    if RAW_PARTITION in raw.columns:  # skip whole partitions as well
        rows = rows.filter((F.col(RAW_PARTITION) >= start) & (F.col(RAW_PARTITION) < stop))
    return rows.limit(limit) if limit else rows


def effective_day(day: date, today: date, back: int = 90) -> date:
    """A day that has not ended yet is replaced by the one `back` days ago."""
    return today - timedelta(days=back) if day >= today else day


def daily_extract(raw: DataFrame, day: date, today: date | None = None, limit: int | None = None) -> DataFrame:
    day = effective_day(day, today) if today else day
    return between(raw, day, day + timedelta(days=1), limit)


def range_extract(raw: DataFrame, start: date, end: date) -> DataFrame:
    """All days from `start` to `end`, both included."""
    return between(raw, start, end + timedelta(days=1))


def monthly_extract(raw: DataFrame, year: int = 2024, month: int = 1, limit: int | None = None) -> DataFrame:
    start = date(year, month, 1)
    stop = date(year + month // 12, month % 12 + 1, 1)
    return between(raw, start, stop, limit)


def yearly_extract(raw: DataFrame, year: int, limit: int | None = None) -> DataFrame:
    return between(raw, date(year, 1, 1), date(year + 1, 1, 1), limit)


HOTSPOT_CSV = (
    "cluster_id int, model_type string, risk_score double, cluster_size int, "
    "top_crime_type string, lat double, lon double, violent_crime_ratio double, "
    "property_crime_ratio double, peak_hour int, weekend_ratio double"
)
FORECAST_CSV = (
    "date date, forecast double, lower_ci double, upper_ci double, "
    "model_type string, crime_type string"
)
FEATURE_CSV = (
    "id string, date string, primary_type string, latitude double, longitude double, "
    "district_num int, is_violent_crime boolean, is_property_crime boolean, "
    "crime_category string, distance_from_center double, hour int, day_of_week int, "
    "is_weekend boolean, season string, daily_crime_count int, crimes_7day_avg double"
)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def read_feature_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, FEATURE_CSV).withColumn(
        "date", F.to_timestamp_ntz("date")
    )


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def split_file(
    spark: SparkSession, path: str, schema: str, form: str, target: str, **options
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Good rows and rejected lines of CSV files or of files with a JSON object per line
    (`form`), as tables under `target`, with their counts, from one scan.

    A line that does not fit the schema (a value of another type, too few or too many
    fields, no JSON object) is rejected as a whole and kept as text."""
    whole = f"{schema}, {CORRUPT} string"
    permissive = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    if form == "json":
        # line by line: the reader itself makes no row, or many, of a line with an array
        line = F.col("value")
        parsed = F.explode(F.array(F.from_json(line, whole, permissive)))
        rows = spark.read.text(path).select(line, parsed.alias("p"))
        fits = F.ltrim(line).startswith("{") & F.col(f"p.{CORRUPT}").isNull() & F.col("p").isNotNull()
        rows = rows.select("p.*", F.when(~fits, line).alias("_line")).drop(CORRUPT).withColumnRenamed("_line", CORRUPT)
    else:
        rows = spark.read.options(**permissive).schema(whole).csv(path)
    judged = rows.withColumn("rejected", F.col(CORRUPT).isNotNull())
    seen = Observation()
    watched = judged.observe(seen, F.count_if(~F.col("rejected")).alias("good"), F.count_if("rejected").alias("rejected"))
    watched.write.mode("overwrite").partitionBy("rejected").parquet(target)
    both = spark.read.schema(judged.schema).parquet(target)
    good = both.filter(~F.col("rejected")).drop("rejected", CORRUPT)
    return good, both.filter("rejected").select(F.col(CORRUPT).alias("line")), dict(seen.get)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower, upper, partitions: int, **properties) -> DataFrame:
    """A database table read in parallel ranges of `column`."""
    return spark.read.jdbc(
        url, table, column, lower, upper, partitions, properties=properties
    )
