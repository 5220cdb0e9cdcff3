"""Hot keys: keys with so many rows that a window over all of them would fill a task.

``hot_slices`` finds them and cuts the time of each into slices of about ``SLICE_ROWS`` rows by its own approximate
quantiles. Windows then run per key and slice, and what they need from other slices is carried over from one small row
for each slice. Rows of all other keys are of slice -1: their windows are those of the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

SLICE = "__slice"
BOUNDS = "__bounds"
#: Rows of a key from which on it is hot, and rows of one of its slices.
HOT_ROWS, SLICE_ROWS = 1 << 18, 1 << 17


@dataclass(frozen=True)
class HotKeys:
    """(keys, __bounds): the sorted bounds between a key's slices, ``most`` of them at most."""

    bounds: DataFrame
    most: int


def null_safe(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return out


def hot_slices(rows: DataFrame, keys: Sequence[str], path: str) -> HotKeys | None:
    """The hot keys of ``rows`` (keys, ``__at``), stored at ``path``; None if there is none. One number reaches the driver.
    Times that are no numbers, dates or timestamps are not cut."""
    if not isinstance(rows.schema["__at"].dataType, (DateType, NumericType, TimestampNTZType, TimestampType)):
        return None
    hot = rows.groupBy(*keys).agg(F.count("*").alias("__rows")).filter(F.col("__rows") > HOT_ROWS)
    most = hot.agg(F.max("__rows")).first()[0]
    if most is None:
        return None
    parts = max(2, -(-most // SLICE_ROWS))
    quantiles = F.percentile_approx("__at", [i / parts for i in range(1, parts)], 20 * parts)
    (
        rows.alias("l").join(F.broadcast(hot).alias("r"), null_safe(keys), "left_semi").groupBy(*keys)
        .agg(F.array_sort(F.array_distinct(quantiles)).alias(BOUNDS)).write.mode("overwrite").parquet(path)
    )
    return HotKeys(rows.sparkSession.read.parquet(path), parts - 1)


def place_among(array: Column, most: int, value: Column) -> Column:
    """How many of the sorted elements (``most`` at most) are <= the value, by bisection; -1 without an array."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    place = F.aggregate(steps, F.lit(0), lambda p, step: F.when(F.get(array, p + step - 1) <= value, p + step).otherwise(p))
    return F.when(array.isNotNull(), place).otherwise(F.lit(-1))


def with_bounds(df: DataFrame, hot: HotKeys, keys: Sequence[str]) -> DataFrame:
    """The rows with the bounds of their key, NULL if it is not hot."""
    return df.alias("l").join(F.broadcast(hot.bounds).alias("r"), null_safe(keys), "left").select("l.*", f"r.{BOUNDS}")


def with_slice(df: DataFrame, hot: HotKeys | None, keys: Sequence[str], at: Column) -> DataFrame:
    """The rows with the slice that ``at`` falls into; -1 for keys that are not hot."""
    if hot is None:
        return df.withColumn(SLICE, F.lit(-1))
    return with_bounds(df, hot, keys).withColumn(SLICE, place_among(F.col(BOUNDS), hot.most, at)).drop(BOUNDS)


def of_hot(df: DataFrame) -> DataFrame:
    return df.filter(F.col(SLICE) >= 0)
