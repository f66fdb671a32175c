"""Incidents per day and type as a stream with late and repeated records.

Files may come in any order, twice, and some days late.  Within `delay` of the newest
record a repeated id is dropped (its state is kept as long) and a late record is added
to its day; what comes later than that is dropped, as the state for it is gone, and
counted in the query's progress.  Each micro-batch writes the days that it changed under
its own number, so a batch repeated after a failure replaces itself and a restart goes
on from the checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

COUNTS = "incident_date date, event_type string, records long, total double, batch long"


def count_new_files(
    spark: SparkSession,
    landing: str,
    record_schema: StructType,
    counts_path: str,
    checkpoint: str,
    delay: str = "3 days",
    when: str = "date",
    kind: str = "event_type",
    value: str = "value",
) -> StreamingQuery:
    """Count the records of the files that have come since the last run, and stop."""
    records = spark.readStream.schema(record_schema).json(landing).withColumn("_at", F.col(when).cast("timestamp"))
    daily = (
        records.withWatermark("_at", delay)
        .dropDuplicatesWithinWatermark(["id"])
        .groupBy(F.window("_at", "1 day").alias("day"), F.col(kind).alias("event_type"))
        .agg(F.count("*").alias("records"), F.sum(value).alias("total"))
        .select(F.to_date("day.start").alias("incident_date"), "event_type", "records", "total")
    )

    def store(batch: DataFrame, number: int) -> None:
        # a row per day and type that changed
        batch.write.mode("overwrite").parquet(f"{counts_path}/batch={number}")

    return (
        daily.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )


def read_counts(spark: SparkSession, counts_path: str) -> DataFrame:
    """The latest count of every day and type."""
    stored = spark.read.schema(COUNTS).option("basePath", counts_path).parquet(counts_path)
    last = F.max_by(F.struct("records", "total"), "batch").alias("x")
    return stored.groupBy("incident_date", "event_type").agg(last).select("incident_date", "event_type", "x.*")
