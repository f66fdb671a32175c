"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but blank, tab, line feed, vertical tab, form feed
# and carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text; none for a null."""
    pieces = F.split(F.coalesce(text, F.lit("")), BLANKS)
    return F.filter(pieces, lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words: pieces between blanks, less the empty ones that only
    the two ends of a text can give."""
    pieces = F.split(F.coalesce(text, F.lit("")), BLANKS)
    ends = (pieces[0] == "").cast("long") + (F.element_at(pieces, -1) == "").cast("long")
    # one empty piece alone is both ends at once
    return F.greatest(F.size(pieces) - ends, F.lit(0)).cast("long")


def salted(df: DataFrame, salt: str, parts: int, *by: str) -> DataFrame:
    """Add a salt of `parts` values that depends on `by` alone, so it is the same
    however often a task is run."""
    return df.withColumn(salt, F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int"))


def byte_slices(batch, column: str, limit: int):
    """Cut an Arrow batch into slices whose `column` holds about `limit` bytes (a
    longer text is a slice of its own), so that memory does not follow the size
    of batches."""
    import numpy as np
    import pyarrow as pa

    values = batch.column(column)
    if values.offset or len(values) == 0:
        offsets = np.cumsum([0] + [len(v.as_buffer()) if v.is_valid else 0 for v in values])
    else:
        wide = np.int64 if values.type == pa.large_string() else np.int32
        offsets = np.frombuffer(values.buffers()[1], wide, len(values) + 1)
    start = 0
    while start < len(values):
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(values))
        yield batch.slice(start, stop - start)
        start = stop


_held: dict = {}


def in_worker(key, make):
    """What an operator holds in a Python worker (tables, a store of what it has met).
    Workers are reused, so only the operator that ran last holds something."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]
