"""Order specifications shared by the per-key operators.

An order key is a column name (ascending) or a ``(name, "asc"|"desc")`` pair.
Ascending puts NULLs first and descending puts them last, which is Spark's
default and also how ``struct`` values compare (NULL is the smallest value).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType, ArrayType, VariantType

OrderKey = str | tuple[str, str]


def normalize_order(order_by: Iterable[OrderKey]) -> list[tuple[str, bool]]:
    """``[(name, ascending)]`` from names or (name, direction) pairs."""
    out = []
    for key in order_by:
        if isinstance(key, str):
            out.append((key, True))
            continue
        name, direction = key
        d = str(direction).strip().lower()
        if d not in ("asc", "desc"):
            raise ValueError(f"order direction must be 'asc' or 'desc', got {direction!r}")
        out.append((name, d == "asc"))
    if not out:
        raise ValueError("at least one order key is required")
    return out


def order_columns(order: Sequence[tuple[str, bool]], flip: bool = False) -> list[Column]:
    cols = []
    for name, asc in order:
        up = asc != flip
        cols.append(F.col(name).asc_nulls_first() if up else F.col(name).desc_nulls_last())
    return cols


def is_orderable(dtype: DataType) -> bool:
    """Maps and variants have no ordering; structs and arrays only if their parts do."""
    if isinstance(dtype, (MapType, VariantType)):
        return False
    if isinstance(dtype, StructType):
        return all(is_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return is_orderable(dtype.elementType)
    return True


def tie_break_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """Remaining orderable columns, used to make exact ties deterministic."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if f.name not in skip and is_orderable(f.dataType)]


def check_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    have = set(df.columns)
    missing = [n for n in names if n not in have]
    if missing:
        raise ValueError(f"{what}: unknown column(s) {missing}; available {df.columns}")
