"""Helpers shared by the operators: table scans, Arrow mapping, written stages."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Separators of words: space, tab, newline, vertical tab, form feed, return. ``bytes.split()`` has the same set.
WHITE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Later jobs start from the files, so a lost executor costs no recomputation of
    what came before, and a table used twice is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, body): the text as UTF-8 bytes, null as no bytes. Other columns are left behind."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("body"),
    )


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of all executors, once for each context."""
    sc = spark.sparkContext
    if getattr(sc, "_layerflow_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="layerflow-code-"), "layerflow.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._layerflow_shipped = True


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_MODEL: dict[str, object] = {}


def worker_model(key: str, build: Callable[[], object]):
    """What an operator keeps in a Python worker between tasks: its model and memory. A worker holds one operator's
    at a time, as it serves one task after the other and lives longer than a stage."""
    if key not in _MODEL:
        _MODEL.clear()
        _MODEL[key] = build()
    return _MODEL[key]


#: Bytes of an Arrow batch on its way to a Python worker, unless the session sets its own: a task holds several batches at
#: a time, in the JVM and in Python, and rows are whole texts.
ARROW_BATCH = "2m"
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> None:
    """What Python workers need of a session: this package, and batches of bounded bytes."""
    ship(spark)
    if spark.conf.get(_ARROW_BYTES, None) is None:
        spark.conf.set(_ARROW_BYTES, ARROW_BATCH)


def give_back() -> None:
    """Hand freed memory back to the system: a Python worker outlives its task and the stage, and would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not with this C library
        pass


def _then_give_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers."""
    prepare(df.sparkSession)
    return df.mapInArrow(_then_give_back(run), schema)


def map_column(df: DataFrame, column: Column, values: Callable[[pa.Array], pa.Array], kind: str) -> Column:
    """A column of ``df`` made of one other column in Arrow batches; the row's other columns stay in the JVM."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _then_give_back(lambda own: map(values, own))(batches)

    return F.arrow_udf(run, kind)(column)


def map_rows(df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from a batch to columns (name → list or array)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = rows(batch)
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return map_batches(df, run, schema)


def crc_mod(id_col: str, n: int):
    """crc32 of the id's decimal text, modulo ``n`` (null id: null)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(n))
