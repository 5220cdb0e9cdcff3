"""Table scans and the small control-table writes.

Tables are parquet folders (or catalog tables); the driver-provided fixtures
are ``{sf_dir}/{name}.parquet``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import read_stored, stored_schema


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the generated parquet tables (columns pruned and filters pushed by Catalyst)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Batch scan of a catalog table or a parquet folder (a path contains '/'), a folder under its newest logged schema."""
    if "/" in name_or_path:
        return read_stored(spark, name_or_path)
    return spark.read.table(name_or_path)


def stream_table(spark: SparkSession, name_or_path: str, schema=None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan; new files of a parquet folder or catalog table arrive as micro-batches."""
    if "/" in name_or_path:
        reader = spark.readStream.format("parquet")
        known = schema if schema is not None else stored_schema(spark, name_or_path)
        reader = reader.schema(known if known is not None else spark.read.parquet(name_or_path).schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.load(name_or_path)
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.table(name_or_path)
