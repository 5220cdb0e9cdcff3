"""Incremental ingest of landed JSON/CSV files into bronze.

* The built-in file stream source with ``trigger(availableNow=True)`` and a
  checkpoint reads every new file exactly once; a second run adds nothing.
* The declared schema is applied at read time (nothing is inferred). File
  sources make every column nullable, so declared non-null columns become a
  quarantine check (B4).
* ``mode="native"``: Spark's JSON/CSV reader in PERMISSIVE mode. A record it
  cannot parse (including a JSON array holding one ``null``) becomes one
  all-NULL row whose raw text is in ``_corrupt_record`` (B1); a wrong-typed
  field is NULL on an otherwise kept row (B3). CSV records with too few or too many fields are
  quarantined as ``short_row`` and ``long_row``, counted by the reader's own rules of quoting.
* ``mode="salvage"`` (JSON): each line (or whole file, ``whole_file=True``) is
  read as text and parsed with ``from_json`` as an array of the schema, so the
  good elements next to a ``null`` survive (B2) and the ``null`` becomes one
  quarantined row.

Every output row carries ``_quarantine_reason`` (NULL for good rows) and
``_corrupt_record`` (raw text of quarantined input, else NULL).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.lineage import with_lineage
from ..schemas import evolve, fitted
from ..storage import bytes_and_files
from ..functions.types import as_nullable, required_columns, schema_from_spec

CORRUPT = "_corrupt_record"
REASON = "_quarantine_reason"
LINEAGE = ("source_metadata", "_ingestion_timestamp", "file_date")


def _reason(schema: StructType, base: Column) -> Column:
    """First declared non-null column that is NULL, else ``base``."""
    out = base
    for c in reversed(required_columns(schema)):
        out = F.when(out.isNull() & F.col(c).isNull(), F.lit(f"missing:{c}")).otherwise(out)
    return out


#: A field that no text holds, put behind a record to find out how many fields it has.
_END_FIELD = "\u0002end\u0002"


def _csv_count_reason(raw: Column, fields: int, options: dict[str, str]) -> Column:
    """Why a raw CSV record does not have the declared number of fields (NULL if it has), as the reader itself parses it
    under the same options (quotes, escapes, separators): the place of a field put behind the last one says it."""
    low = {k.lower(): v for k, v in options.items()}
    sep = low.get("sep", low.get("delimiter", ","))
    own = {k: str(v) for k, v in options.items() if k.lower() not in ("header", "mode", "columnnameofcorruptrecord", "maxfilespertrigger")}
    columns = [f"f{i}" for i in range(fields + 1)]
    parsed = F.from_csv(F.concat(raw, F.lit(sep.replace("\\t", "\t") + _END_FIELD)), ", ".join(f"{c} string" for c in columns), own)
    place = F.array_position(F.array(*[F.coalesce(parsed[c], F.lit("")) for c in columns]), _END_FIELD)
    swallowed = F.exists(F.array(*[parsed[c] for c in columns]), lambda c: F.coalesce(c.contains(_END_FIELD), F.lit(False)))
    return (
        F.when(place == fields + 1, F.lit(None).cast("string")).when(place > 0, F.lit("short_row"))
        .when(swallowed, F.lit("corrupt_record")).otherwise(F.lit("long_row")))


def read_landed(
    spark: SparkSession,
    source_path: str,
    schema,
    file_format: str = "csv",
    stream: bool = True,
    mode: str = "native",
    whole_file: bool = False,
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Landed files with the declared schema, lineage and quarantine columns.

    ``schema`` is a ``StructType`` or the control table's JSON wrapper.
    ``stream=False`` reads the same files as a batch (for backfills and tests).
    """
    declared = schema if isinstance(schema, StructType) else schema_from_spec(schema)
    readable = as_nullable(declared)
    fmt = (file_format or "csv").lower()
    reader = spark.readStream if stream else spark.read
    if max_files_per_trigger and stream:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)

    if mode == "salvage":
        if fmt != "json":
            raise ValueError("salvage mode reads JSON only")
        text = reader.format("text").option("wholetext", str(bool(whole_file)).lower()).load(source_path)
        text = text.filter(F.trim(F.col("value")) != "")
        parsed = with_lineage(text).withColumn("__arr", F.from_json("value", ArrayType(readable, True)))
        rows = parsed.select(
            "*", F.posexplode_outer("__arr").alias("__pos", "__rec")
        ).filter(F.col("__arr").isNull() | F.col("__pos").isNotNull())
        base = (
            F.when(F.col("__arr").isNull(), F.lit("unparsable"))
            .when(F.col("__rec").isNull(), F.lit("null_element"))
        )
        out = rows.select(
            *[F.col(f"__rec.{f.name}").alias(f.name) for f in readable.fields],
            *LINEAGE,
            F.when(base.isNotNull(), F.col("value")).alias(CORRUPT),
            base.alias("__base"),
        )
    elif mode == "native":
        with_corrupt = StructType(readable.fields + [StructField(CORRUPT, StringType(), True)])
        src = (
            reader.format(fmt).schema(with_corrupt)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .load(source_path)
        )
        all_null = F.lit(True)
        for f in readable.fields:
            all_null = all_null & F.col(f.name).isNull()
        base = F.when(F.col(CORRUPT).isNotNull() & all_null, F.lit("corrupt_record"))
        if fmt == "csv":  # a wrong-typed field alone leaves the record (B3)
            counted = _csv_count_reason(F.col(CORRUPT), len(readable.fields), options or {})
            base = F.when(F.col(CORRUPT).isNotNull(), F.coalesce(counted, base))
        out = with_lineage(src).withColumn("__base", base)
    else:
        raise ValueError(f"unknown mode {mode!r}; use 'native' or 'salvage'")
    return (
        out.withColumn(REASON, _reason(declared, F.col("__base")))
        .select(*[f.name for f in readable.fields], *LINEAGE, CORRUPT, REASON)
    )


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(CORRUPT, REASON)


def quarantined_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNotNull())


BUCKET_PREFIX = "__bucket_"


def bucket_column(keys: Sequence[str], buckets: int) -> str:
    """Name of the bucket column for these keys and this number: a table's column of another name is for other
    keys and is never taken for it."""
    return BUCKET_PREFIX + hashlib.md5(repr((list(keys), buckets)).encode()).hexdigest()[:8]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Key bucket used to rewrite silver incrementally (all rows of a key share one)."""
    return df.withColumn(bucket_column(keys, buckets), bucket_of(keys, buckets))


def without_buckets(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(BUCKET_PREFIX)])


def write_bronze(
    df: DataFrame,
    target_path: str,
    checkpoint: str,
    partition_by: list[str] | None = None,
    wait: bool = True,
) -> StreamingQuery | None:
    """Append a streaming DataFrame to a parquet table, every file once.

    ``availableNow`` processes what is there now (in as many micro-batches as
    ``maxFilesPerTrigger`` asks for) and stops; the checkpoint makes a rerun
    pick up only newer files.
    """
    writer = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    q = writer.start(target_path)
    if wait:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        return None
    return q


#: Landed bytes of a bucket's rows in one micro-batch that make a task and a file of their own.
SHARE_BYTES = 16 << 20


def bucket_shares(spark: SparkSession, source_path: str, buckets: int, max_files_per_trigger: int | None = None) -> int:
    """Over how many tasks and files a bucket's rows of a micro-batch are dealt: as many as the landed bytes that a
    micro-batch may hold ask for, and no more than fill the shuffle partitions. Files that are smaller than needed
    would make as many more micro-batches of the streams that read them."""
    held, number = bytes_and_files(spark, source_path)
    if max_files_per_trigger and number:
        held = min(held, held * max_files_per_trigger // number)
    most = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // buckets)
    return max(1, min(most, -(-held // (buckets * SHARE_BYTES))))


def ingest(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    checkpoint: str,
    schema,
    file_format: str = "csv",
    keys: list[str] | None = None,
    buckets: int = 64,
    mode: str = "native",
    whole_file: bool = False,
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """S1 + S6: one ``availableNow`` run of the bronze stream for one source folder.

    With ``keys`` (known from the silver row that reads this table) bronze is
    partitioned by key bucket, so silver can recompute only touched buckets; a bucket's
    rows of a micro-batch are dealt over several tasks where they are many (``bucket_shares``).
    A declared schema that has changed since the last run is merged into the table's
    (``schemas.evolve``) or refused before anything is read.
    """
    df = read_landed(
        spark, source_path, schema, file_format, stream=True, mode=mode, whole_file=whole_file,
        max_files_per_trigger=max_files_per_trigger, options=options,
    )
    part = None
    if keys:
        part = [bucket_column(keys, buckets)]
        df = with_bucket(df, keys, buckets)
    df = fitted(df, evolve(spark, target_path, df.schema, tuple(keys or ())))
    if part:
        shares = bucket_shares(spark, source_path, buckets, max_files_per_trigger)
        tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * buckets * shares)  # a stream's shuffle is not made smaller later
        df = df.repartition(tasks, part[0], F.pmod(F.xxhash64("source_metadata.file_path", "source_metadata.file_block_start", *(
            f.name for f in df.schema.fields if f.name not in (*LINEAGE, part[0]) and f.dataType.typeName() not in ("map", "variant"))), F.lit(shares)))
    write_bronze(df, target_path, checkpoint, partition_by=part)
