"""Raw landing sources (S1-S3): every column read as text, no inference.

A line that cannot be read as a row keeps its text in ``_corrupt_record`` (its other
columns are NULL), and quarantine reports it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from adcredit.schemas import CORRUPT, RAW_ADS, RAW_EVENTS, RAW_ORDERS

RAW_SCHEMAS = {"ads": RAW_ADS, "orders": RAW_ORDERS, "events": RAW_EVENTS}


def _reader(reader, kind: str, fmt: str):
    if fmt not in ("json", "csv", "parquet"):
        raise ValueError(f"unsupported format: {fmt}")
    fields = RAW_SCHEMAS[kind].fields
    if fmt == "parquet":
        return reader.schema(T.StructType(fields)).format(fmt)
    reader = reader.schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])) \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).format(fmt)
    return reader.option("header", "true") if fmt == "csv" else reader


def read_raw(spark: SparkSession, kind: str, path: str, fmt: str = "json") -> DataFrame:
    """Batch read of a raw landing folder (newline JSON, CSV with header, Parquet)."""
    return _reader(spark.read, kind, fmt).load(path)


def stream_raw(spark: SparkSession, kind: str, path: str, fmt: str = "json",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """The same source as a stream (new files in the folder are new rows)."""
    reader = _reader(spark.readStream, kind, fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
