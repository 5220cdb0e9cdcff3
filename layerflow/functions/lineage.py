"""Lineage columns added to every ingested row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where the landing date sits in a landed file's name
# ({key}_{YYYYMMDD_HHMMSS}.json) or, for files written by Spark, in the
# landing folder (landed_at=YYYYMMDD_HHMMSS), and its date format.
FILE_NAME_DATE = r"_(\d{8})_\d{6}\.json$"
LANDING_DIR_DATE = r"landed_at=(\d{8})_\d{6}(/|$)"
DATE_FORMAT = "yyyyMMdd"


def file_date(file_name: Column, file_path: Column | None = None) -> Column:
    """Landing date of a file as ``timestamp_ntz``; NULL when neither the name
    nor (if given) the path carries one, or when the digits are not a date."""
    digits = F.regexp_extract(file_name, FILE_NAME_DATE, 1)
    if file_path is not None:
        digits = F.when(digits != "", digits).otherwise(F.regexp_extract(file_path, LANDING_DIR_DATE, 1))
    return F.try_to_date(F.nullif(digits, F.lit("")), DATE_FORMAT).cast("timestamp_ntz")


def with_lineage(df: DataFrame) -> DataFrame:
    """P1 + P2: ``source_metadata`` (the hidden file struct), ``_ingestion_timestamp``
    (one value per micro-batch) and ``file_date``."""
    return (
        df.select("*", F.col("_metadata").alias("source_metadata"), F.current_timestamp().alias("_ingestion_timestamp"))
        .withColumn("file_date", file_date(F.col("source_metadata.file_name"), F.col("source_metadata.file_path")))
    )
