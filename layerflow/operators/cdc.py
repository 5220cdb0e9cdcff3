"""SCD type 1 and type 2 tables from a change feed.

Contract (see README):

* Output of SCD2 = the source columns + ``__START_AT`` and ``__END_AT`` (type of
  the first sequence column). ``__END_AT IS NULL`` marks the open version;
  intervals are half-open ``[start, end)``. SCD1 adds neither column.
* Rows are ordered per key by the sequence columns, then by the remaining
  orderable columns (deterministic tie-break). Of rows sharing the first
  sequence value only the last one counts, so no zero-length version exists.
* Rows whose sequence is NULL are not applied; ``null_sequence_rows`` returns
  them for quarantine. NULL keys form one group.
* Tracked columns: the explicit list, else every column except keys, sequence
  and the except-list. Consecutive rows with equal tracked values are one
  version; its untracked columns (the sequence included) hold the values of
  the version's last row.

Plan: every step is a window over ``partitionBy(keys)`` with one ordering, so
the whole operator is one hash exchange on the keys and one sort; no join, no
group-by, nothing collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from .dedup import latest_per_key
from .ordering import check_columns, is_orderable, tie_break_columns

START_AT = "__START_AT"
END_AT = "__END_AT"


def _as_list(v: str | Sequence[str] | None) -> list[str]:
    if v is None:
        return []
    if isinstance(v, str):
        return [v] if v else []
    return list(v)


def tracked_columns(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    track: Sequence[str] | None = None,
    track_except: Sequence[str] | None = None,
) -> list[str]:
    """Which columns open a new version when they change.

    An explicit ``track`` list wins over ``track_except`` (as in the reference).
    Map and variant columns cannot be compared and are rejected when tracked.
    """
    track = _as_list(track)
    track_except = _as_list(track_except)
    if track:
        check_columns(df, track, "track_history_column_list")
        cols = track
    else:
        check_columns(df, track_except, "track_history_except_column_list")
        skip = {*keys, *sequence_by, *track_except}
        cols = [c for c in df.columns if c not in skip]
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    bad = [c for c in cols if not is_orderable(types[c]) or isinstance(types[c], (MapType, VariantType))]
    if bad:
        raise ValueError(f"columns {bad} cannot be compared and cannot be tracked")
    return cols


def null_sequence_rows(df: DataFrame, sequence_by: str | Sequence[str]) -> DataFrame:
    """Rows that cannot be placed in the history (a NULL sequence value)."""
    cond: Column = F.lit(False)
    for c in _as_list(sequence_by):
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def _with_sequence(df: DataFrame, seq: list[str]) -> DataFrame:
    cond: Column = F.lit(True)
    for c in seq:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def _check(df: DataFrame, keys: list[str], seq: list[str]) -> None:
    if not keys:
        raise ValueError("at least one key is required")
    if not seq:
        raise ValueError("sequence_by is required")
    check_columns(df, keys, "keys")
    check_columns(df, seq, "sequence_by")


def scd1_from_changes(df: DataFrame, keys: Sequence[str], sequence_by: str | Sequence[str]) -> DataFrame:
    """The latest row of every key (ties as in the contract)."""
    keys, seq = _as_list(keys), _as_list(sequence_by)
    _check(df, keys, seq)
    return latest_per_key(_with_sequence(df, seq), keys, seq, deterministic=True)


def scd2_from_changes(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    track: Sequence[str] | None = None,
    track_except: Sequence[str] | None = None,
    segments: int | None = None,
) -> DataFrame:
    """C1 (+C5/C6): one row per version of every key.

    ``segments`` switches to the hot-key plan (``operators.segmented``), which
    spreads each key over that many sequence ranges; same result.
    """
    if segments and segments > 1:
        from .segmented import scd2_from_changes_segmented

        return scd2_from_changes_segmented(df, keys, sequence_by, track, track_except, segments=segments)
    keys, seq = _as_list(keys), _as_list(sequence_by)
    _check(df, keys, seq)
    tracked = tracked_columns(df, keys, seq, track, track_except)
    columns = df.columns
    rest = tie_break_columns(df, [*keys, *seq])
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in (*seq, *rest)])
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s0 = F.col(seq[0])
    trk = F.struct(*[F.col(c) for c in tracked]) if tracked else F.struct(F.lit(0))

    last_of_instant = (
        _with_sequence(df, seq)
        .withColumn("__next", F.lead(s0).over(w))
        .filter(F.col("__next").isNull() | (F.col("__next") != s0))
    )
    flagged = (
        last_of_instant.withColumn("__trk", trk)
        .withColumn("__opens", ~F.lag("__trk").over(w).eqNullSafe(F.col("__trk")))
        .withColumn("__closes", ~F.lead("__trk").over(w).eqNullSafe(F.col("__trk")))
        .withColumn(END_AT, F.lead(s0).over(w))
    )
    versions = (
        flagged.withColumn(START_AT, F.last(F.when(F.col("__opens"), s0), ignorenulls=True).over(running))
        .filter(F.col("__closes"))
    )
    return versions.select(*columns, START_AT, END_AT)


def current_versions(history: DataFrame) -> DataFrame:
    """P5: the open version of every key."""
    return history.filter(F.col(END_AT).isNull())
