"""The daily load as an incremental file stream.

Every run picks up the record files that arrived since the last one, appends
them to the raw table and stops; which files are done is kept in the query's
checkpoint, so a run repeated after a failure does not load them twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..schema import RAW_PARTITION
from ..sinks.tables import envelope


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    record_schema: StructType,
    raw_path: str,
    checkpoint: str,
    source: str = "crime_api",
) -> StreamingQuery:
    records = spark.readStream.schema(record_schema).json(landing)
    return (
        envelope(records, source)
        .withColumn(RAW_PARTITION, F.to_date("date"))
        .writeStream.format("parquet")
        .partitionBy(RAW_PARTITION)
        .option("path", raw_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, raw_path: str) -> DataFrame:
    return spark.read.parquet(raw_path)
