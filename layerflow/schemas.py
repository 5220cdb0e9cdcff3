"""Schemas of stored tables over time: what a table has held so far, and what a new run may add to it.

A table's folder has a log of its schemas below ``_schema`` (hidden from readers, one file for each version, never
rewritten). A run may add columns and fields of structs, and widen numbers and decimals; what it no longer has stays and is
NULL in its rows. Anything else raises ``SchemaChange`` before a row is written. Tables are read under the newest schema,
so files of earlier runs give NULL for what they lack and are widened as they are read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType, ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType, ShortType, StructField, StructType)

from .storage import file_names, list_folders, read_small, write_small

_WHOLE = (ByteType, ShortType, IntegerType, LongType)


class SchemaChange(ValueError):
    """A column of a new run does not fit the table's."""


def widened(old: DataType, new: DataType, where: str) -> DataType:
    """The type that holds both, if ``new`` is ``old`` or wider; structs are merged field by field."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        return merged(old, new, where)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(widened(old.elementType, new.elementType, f"{where}[]"), True)
    if isinstance(old, MapType) and isinstance(new, MapType) and old.keyType == new.keyType:
        return MapType(old.keyType, widened(old.valueType, new.valueType, f"{where}{{}}"), True)
    if old == new:
        return new
    if isinstance(old, _WHOLE) and isinstance(new, _WHOLE) and _WHOLE.index(type(new)) > _WHOLE.index(type(old)):
        return new
    if isinstance(old, (ByteType, ShortType, IntegerType, FloatType)) and isinstance(new, DoubleType):
        return new
    if isinstance(old, DecimalType) and isinstance(new, DecimalType) and new.scale >= old.scale and (
            new.precision - new.scale >= old.precision - old.scale):
        return new
    raise SchemaChange(f"{where}: {old.simpleString()} cannot become {new.simpleString()}")


def merged(old: StructType, new: StructType, where: str = "") -> StructType:
    """Old fields in their places (widened), then new ones; names compare without case."""
    fresh = {f.name.lower(): f for f in new.fields}
    fields = []
    for f in old.fields:
        other = fresh.pop(f.name.lower(), None)
        kind = f.dataType if other is None else widened(f.dataType, other.dataType, f"{where}.{f.name}".lstrip("."))
        fields.append(StructField(f.name, kind, True))
    return StructType(fields + [StructField(f.name, f.dataType, True) for f in new.fields if f.name.lower() in fresh])


def _versions(spark: SparkSession, path: str) -> list[str]:
    return [name for name in file_names(spark, f"{path.rstrip('/')}/_schema") if name.endswith(".json") and name[0] != "."]


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The newest logged schema of a table's folder; None if it has no log."""
    known = _versions(spark, path)
    return StructType.fromJson(json.loads(read_small(spark, f"{path.rstrip('/')}/_schema/{known[-1]}"))) if known else None


def evolve(spark: SparkSession, path: str, new: StructType, fixed: tuple[str, ...] = ()) -> StructType:
    """The schema of the table's folder after a run of schema ``new``, logged if it differs. Columns in ``fixed`` (the
    keys that files are dealt by) must keep their types. A table without a log begins with what its files hold."""
    old = stored_schema(spark, path)
    if old is None and list_folders(spark, path):
        old = spark.read.parquet(path).schema
    out = merged(old, new) if old is not None else merged(StructType([]), new)
    for name in fixed:
        if old is not None and name in old.names and old[name].dataType != out[name].dataType:
            raise SchemaChange(f"{name}: a key's type cannot change, as files are dealt by it")
    known = _versions(spark, path)
    if not known or old is None or out.jsonValue() != merged(StructType([]), old).jsonValue():
        write_small(spark, f"{path.rstrip('/')}/_schema/{len(known):06}.json", out.json())
    return out


def fitted(df: DataFrame, schema: StructType) -> DataFrame:
    """The rows under a schema that ``evolve`` made of theirs: by name, widened, NULL for what they lack."""
    return df.to(schema)


def read_stored(spark: SparkSession, *paths: str, table: str | None = None) -> DataFrame:
    """Parquet folders of one table under the table's newest schema (of the first folder unless ``table`` says where)."""
    schema = stored_schema(spark, table or paths[0])
    return spark.read.parquet(*paths) if schema is None else spark.read.schema(schema).parquet(*paths)
