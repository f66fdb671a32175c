"""Raw envelope loads and keyed result tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import quantize
from ..schema import CLUSTER_KEY, CLUSTER_TYPES, FORECAST_KEY, FORECAST_TYPES, HOTSPOT_KEY, HOTSPOT_TYPES, RAW, RAW_PARTITION
from ..session import materialize

DAY = RAW_PARTITION


class DuplicateKeyError(ValueError):
    """Rows to be appended repeat a key, among themselves or in the table."""


def envelope(records: DataFrame, source: str) -> DataFrame:
    """Wrap records of any schema: id, date, the whole record as JSON."""
    fields = {f.name: f.dataType for f in records.schema}
    ident = F.coalesce(F.col("id").cast("string"), F.lit("")) if "id" in fields else F.lit("")
    when = F.col("date").try_cast("timestamp_ntz") if "date" in fields else F.lit(None).cast("timestamp_ntz")
    return records.select(
        ident.alias("id"),
        when.alias("date"),
        F.to_json(F.struct("*")).alias("record_data"),
        F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"),
        F.lit(source).alias("source"),
    )


def create_raw_table(spark: SparkSession, name: str) -> None:
    """The raw table, partitioned by calendar day so that extracts of a day, a
    month or a year list and read only those days."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {DAY} date) USING parquet PARTITIONED BY ({DAY})"
    )


def load_daily(records: DataFrame, table: str, dedupe: bool = False) -> None:
    """Append one day's records.  Loading a day twice doubles it unless `dedupe` merges
    the records into the days they belong to (an id names a record of its day)."""
    _load_raw(envelope(records, "crime_api"), table, dedupe)


def load_batch(records: DataFrame, batch_id: str, table: str, dedupe: bool = False) -> None:
    _load_raw(envelope(records, f"batch_api_{batch_id}"), table, dedupe)


def by_day(rows: DataFrame) -> DataFrame:
    """Rows grouped by day for writing: days with little data share a task, and
    adaptive execution splits a day that is too large for one."""
    return rows.withColumn(DAY, F.to_date("date")).hint("rebalance", DAY)


def days_of(rows: DataFrame, day: str = DAY) -> Column:
    """A filter for the days that occur in `rows`; they are bounded by the calendar."""
    found = [r[0] for r in rows.select(day).distinct().collect()]
    known = [d for d in found if d is not None]
    wanted = F.col(day).isin(known) if known else F.lit(False)
    return wanted | F.col(day).isNull() if None in found else wanted


def overwrite_days(rows: DataFrame, table: str, day: str = DAY) -> None:
    """Replace the partitions of the days that occur in `rows`, and no others."""
    spark, mode = rows.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    names = [c for c in spark.table(table).columns if c != day]
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # inserts into tables take no option for it
    try:
        rows.select(*names, day).hint("rebalance", day).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def _load_raw(rows: DataFrame, table: str, dedupe: bool) -> None:
    spark = rows.sparkSession
    create_raw_table(spark, table)
    if not dedupe:
        by_day(rows).write.mode("append").partitionBy(DAY).saveAsTable(table)
        return
    # written once: the merge reads it, and loaded_at must not change between runs of it
    batch = materialize(rows.withColumn(DAY, F.to_date("date")))
    stored = spark.table(table).filter(days_of(batch)).select(*batch.columns)
    overwrite_days(materialize(merged(stored, batch)), table)


def merged(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored rows and a batch as if each record had been loaded once.

    Per day and id the row loaded last stays, of those loaded together the one with the
    larger payload.  Records without an id are told apart by their payload: as many equal
    ones stay as the table or the batch has."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    columns = [c for c in batch.columns if c not in ("id", DAY)]
    last = F.max(F.struct("loaded_at", "record_data", *[c for c in columns if c not in ("loaded_at", "record_data")]))
    named = (
        both.filter(F.col("id") != "").groupBy(DAY, "id").agg(last.alias("x")).select("id", DAY, "x.*")
    )
    others = both.filter(F.coalesce("id", F.lit("")) == "")
    times = F.greatest(*[F.count_if(F.col("_new") == k) for k in (0, 1)])
    equal = others.groupBy(DAY, "id", "date", "record_data").agg(
        times.alias("_times"), F.max_by("source", "loaded_at").alias("source"), F.max("loaded_at").alias("loaded_at")
    )
    equal = equal.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), "_times")))
    return named.select(*batch.columns).unionByName(equal.select(*batch.columns))


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def replace_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


# bits of a key filter, per key and at most (8 MB); a larger batch is joined without one
BITS_PER_KEY, MOST_BITS, HASHES = 12, 1 << 26, 3


def _positions(key, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(bits)) for seed in range(HASHES)]


def key_filter(keys: DataFrame, key) -> Column | None:
    """A Bloom filter of the keys: a condition that holds for all of them and for few
    others.  Its bits are or-ed by an aggregate into 64-bit words, at most 8 MB."""
    bits = 1 << max(6, (keys.count() * BITS_PER_KEY - 1).bit_length())
    if bits > MOST_BITS:
        return None
    words = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("set"))
    # a position's bit, as shifts take an int
    bit = F.expr("shiftleft(1L, cast(at % 64 as int))")
    set_bits = keys.select(F.explode(F.array(*_positions(key, bits))).alias("at")).select(
        F.floor(F.col("at") / 64).cast("long").alias("word"), bit.alias("set")
    )
    told = set_bits.unionByName(words).groupBy("word").agg(F.bit_or("set").alias("set"))
    held = told.agg(F.sort_array(F.collect_list(F.struct("word", "set"))).alias("w")).select(F.col("w.set")).scalar()
    tests = [
        F.getbit(F.get(held, F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1
        for at in _positions(key, bits)
    ]
    return reduce(lambda a, b: a & b, tests)


def append_keyed(df: DataFrame, table: str, types: dict[str, str], key, on_duplicate: str = "error") -> None:
    """Append rows under a composite key, rounded to their storage types.

    `on_duplicate`: "error" refuses the whole append, "skip" leaves out rows
    whose key exists.  The batch is written once.  Of the existing rows only the key
    columns of the batch's model types are read, and of these only what passes a Bloom
    filter of the batch's keys reaches the join."""
    if on_duplicate not in ("error", "skip"):
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    spark = df.sparkSession
    key = list(key)
    rows = materialize(quantize(df.select(*types), types))
    keys = rows.select(*key)
    if spark.catalog.tableExists(table):
        models = [r[0] for r in rows.select("model_type").distinct().collect()]
        present = spark.table(table).filter(F.col("model_type").isin(models)).select(*key)
        likely = key_filter(keys, key)
        present = present if likely is None else present.filter(likely)
    else:
        present = keys.limit(0)
    if on_duplicate == "error":
        # repeated keys in the batch, or keys of the batch already stored
        counts = keys.groupBy(*key).agg(F.count("*").alias("n"))
        repeated = counts.filter("n > 1").select(*key)
        stored = present.join(counts.select(*key), key, "left_semi")
        clash = repeated.unionByName(stored).limit(1).collect()
        if clash:
            raise DuplicateKeyError(f"{table}: key {clash[0].asDict()} occurs more than once")
    else:
        # of rows that repeat a key in the batch the smallest stays, whatever the partitioning
        rest = [c for c in types if c not in key]
        first = rows.groupBy(*key).agg(F.min(F.struct(*rest)).alias("x")).select(*key, "x.*")
        rows = first.join(present, key, "left_anti").select(*types)
    rows.write.mode("append").partitionBy("model_type").saveAsTable(table)


def with_provenance(df: DataFrame, model_type: str, crime_type_filter: str) -> DataFrame:
    return df.withColumns(
        {
            "model_type": F.lit(model_type),
            "crime_type_filter": F.lit(crime_type_filter),
            "created_at": F.current_timestamp().cast("timestamp_ntz"),
        }
    )


def save_clusters(labelled: DataFrame, table: str, model_type: str, crime_type: str = "ALL", **how) -> None:
    rows = with_provenance(labelled, model_type, crime_type)
    append_keyed(rows, table, CLUSTER_TYPES, CLUSTER_KEY, **how)


def save_hotspots(profiles: DataFrame, table: str, model_type: str, crime_type: str = "ALL", **how) -> None:
    """Profiles with their stored names; districts become comma-joined text."""
    rows = with_provenance(profiles, model_type, crime_type).select(
        "cluster_id",
        "model_type",
        "crime_type_filter",
        F.col("center_lat").alias("center_latitude"),
        F.col("center_lon").alias("center_longitude"),
        F.col("size").alias("cluster_size"),
        "risk_score",
        "top_crime_type",
        "violent_crime_ratio",
        "property_crime_ratio",
        "avg_distance_from_center",
        "peak_hour",
        "weekend_ratio",
        F.array_join(F.col("districts").cast("array<string>"), ",").alias("districts"),
        "created_at",
    )
    append_keyed(rows, table, HOTSPOT_TYPES, HOTSPOT_KEY, **how)


def save_forecasts(forecasts: DataFrame, table: str, **how) -> None:
    """Forecasts of any number of series; `series_id` is the crime type."""
    rows = forecasts.withColumnRenamed("series_id", "crime_type").withColumn(
        "created_at", F.current_timestamp().cast("timestamp_ntz")
    )
    append_keyed(rows, table, FORECAST_TYPES, FORECAST_KEY, **how)
