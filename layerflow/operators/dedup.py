"""Rank rows within a key and keep one row per key.

``first_per_key`` is ``row_number() = 1`` over ``partitionBy(keys)``. Catalyst
rewrites that filter into a WindowGroupLimit that runs once *before* the shuffle
(Partial) and once after (Final), so each map task sends at most one row per key:
a key holding a third of all rows costs one row per input split, not a third of
the data in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import OrderKey, check_columns, normalize_order, order_columns, tie_break_columns


def rank_within_keys(df: DataFrame, keys: Sequence[str], order_by: Iterable[OrderKey], name: str = "row_num") -> DataFrame:
    """``row_number`` per key in the given order (NULL keys form one group)."""
    order = normalize_order(order_by)
    check_columns(df, [*keys, *(n for n, _ in order)], "rank_within_keys")
    w = Window.partitionBy(*keys).orderBy(*order_columns(order))
    return df.withColumn(name, F.row_number().over(w))


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Iterable[OrderKey], deterministic: bool = True) -> DataFrame:
    """W2 + P8: the first row of every key in the given order.

    With ``deterministic`` the remaining orderable columns are appended to the
    order (same direction as the last order key), so exact ties always resolve
    to the same row.
    """
    order = normalize_order(order_by)
    check_columns(df, [*keys, *(n for n, _ in order)], "first_per_key")
    if deterministic:
        last_dir = order[-1][1]
        order = order + [(c, last_dir) for c in tie_break_columns(df, [*keys, *(n for n, _ in order)])]
    w = Window.partitionBy(*keys).orderBy(*order_columns(order))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Iterable[OrderKey], deterministic: bool = True) -> DataFrame:
    """The last row of every key in the given order (every direction flipped)."""
    flipped = [(n, "desc" if asc else "asc") for n, asc in normalize_order(order_by)]
    return first_per_key(df, keys, flipped, deterministic)
