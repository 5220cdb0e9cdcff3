"""C3/C4 (+C5/C6): SCD tables from periodic full snapshots.

A snapshot is the complete state of a source at one version. Against the
history built so far:

* a key absent from the new snapshot closes at that version;
* a key whose tracked values changed closes and reopens at that version;
* a key that returns after being absent opens a new version;
* equal tracked values keep the open version; its untracked columns take the
  new snapshot's values (the last value wins, as for change feeds);
* a version not newer than the last applied one changes nothing.

Two forms compute the same table:

``apply_snapshot``  incremental: open versions FULL OUTER JOIN the new snapshot
                    on the keys (NULL-safe). One shuffle of open rows + snapshot;
                    closed history passes through untouched (``diff_snapshot``
                    returns the changed part alone, for a store that only adds).
``scd2_from_snapshots``  batch over all snapshots stacked with a version
                    column: one window per key; a gap between the key's
                    previous version and the previous snapshot breaks the island.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cdc import END_AT, START_AT, _as_list, tracked_columns
from .ordering import check_columns, tie_break_columns


def _null_safe_on(keys: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def last_applied_version(target: DataFrame) -> Any:
    """Greatest version already in the history (one scalar on the driver)."""
    row = target.agg(F.max(F.greatest(F.col(START_AT), F.coalesce(F.col(END_AT), F.col(START_AT)))).alias("v")).first()
    return None if row is None else row["v"]


def apply_snapshot(
    target: DataFrame | None,
    snapshot: DataFrame,
    version: Any,
    keys: Sequence[str],
    track: Sequence[str] | None = None,
    track_except: Sequence[str] | None = None,
    scd_type: int | str = 2,
    skip_applied: bool = False,
) -> DataFrame:
    """The history after applying ``snapshot`` taken at ``version``.

    ``target`` is the current history (``None`` for the first snapshot). With
    ``skip_applied`` a version not newer than the last applied one returns the
    target unchanged (idempotent replay); that check reads one scalar.
    """
    keys = _as_list(keys)
    if int(scd_type) == 1:
        return snapshot
    if int(scd_type) != 2:
        raise ValueError(f"scd_type must be 1 or 2, got {scd_type!r}")
    check_columns(snapshot, keys, "keys")
    cols = snapshot.columns
    tracked = tracked_columns(snapshot, keys, [], track, track_except)
    v = F.lit(version)
    if target is None:
        return snapshot.select(*cols, v.alias(START_AT), F.when(F.lit(False), v).alias(END_AT))
    if skip_applied:
        last = last_applied_version(target)
        if last is not None and version <= last:
            return target
    closed = target.filter(F.col(END_AT).isNotNull()).select(*cols, START_AT, END_AT)
    open_rows = target.filter(F.col(END_AT).isNull())
    return closed.unionByName(diff_snapshot(open_rows, snapshot, version, keys, track, track_except))


def diff_snapshot(
    open_rows: DataFrame,
    snapshot: DataFrame,
    version: Any,
    keys: Sequence[str],
    track: Sequence[str] | None = None,
    track_except: Sequence[str] | None = None,
) -> DataFrame:
    """The open versions after ``snapshot`` (``__END_AT`` NULL) and those that it
    closes, in one pass over both inputs. Keys that may be NULL join NULL-safe."""
    keys = _as_list(keys)
    check_columns(snapshot, keys, "keys")
    cols = snapshot.columns
    tracked = tracked_columns(snapshot, keys, [], track, track_except)
    vtype = open_rows.schema[START_AT].dataType
    v = F.lit(version).cast(vtype)
    t_rows = open_rows.select(*cols, START_AT).withColumn("__in_t", F.lit(True))
    s_rows = snapshot.select(*cols).withColumn("__in_s", F.lit(True))

    def side(alias: str) -> list[Column]:
        return [F.col(f"{alias}.{c}").alias(c) for c in cols]

    in_t = F.col("t.__in_t").isNotNull()
    in_s = F.col("s.__in_s").isNotNull()
    same = F.struct(*[F.col(f"t.{c}") for c in tracked]).eqNullSafe(F.struct(*[F.col(f"s.{c}") for c in tracked])) if tracked else F.lit(True)
    null_end = F.lit(None).cast(vtype)
    kept = F.struct(*side("s"), F.col(f"t.{START_AT}").alias(START_AT), null_end.alias(END_AT))
    closed_t = F.struct(*side("t"), F.col(f"t.{START_AT}").alias(START_AT), v.alias(END_AT))
    opened_s = F.struct(*side("s"), v.alias(START_AT), null_end.alias(END_AT))
    rows = (
        F.when(in_t & in_s & same, F.array(kept))
        .when(in_t & in_s, F.array(closed_t, opened_s))
        .when(in_t, F.array(closed_t))
        .otherwise(F.array(opened_s))
    )
    # Plain equality keeps the partitioning that a per-key dedup leaves; it serves where no key can be NULL.
    nullable = any(snapshot.schema[k].nullable or open_rows.schema[k].nullable for k in keys)
    on = _null_safe_on(keys, "t", "s") if nullable else reduce(
        lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    return t_rows.alias("t").join(s_rows.alias("s"), on, "full_outer").select(F.inline(rows))


def _neighbours(stacked: DataFrame, version_col: str, versions: Sequence[Any] | None) -> DataFrame:
    """``stacked`` with the previous and next snapshot version of every row's version. The window runs over the
    distinct versions (one row for each snapshot ever taken); rows without a version are not applied."""
    if versions is None:
        known = stacked.select(version_col).distinct().filter(F.col(version_col).isNotNull())
    else:
        kind = stacked.schema[version_col].dataType.simpleString()
        known = stacked.sparkSession.createDataFrame([(v,) for v in sorted(set(versions))], f"`{version_col}` {kind}")
    in_order = Window.orderBy(version_col)
    table = known.withColumn("__prev_v", F.lag(version_col).over(in_order)).withColumn(
        "__next_v", F.lead(version_col).over(in_order))
    return stacked.join(table, version_col)


def scd2_from_snapshots(
    stacked: DataFrame,
    keys: Sequence[str],
    version_col: str,
    track: Sequence[str] | None = None,
    track_except: Sequence[str] | None = None,
    versions: Sequence[Any] | None = None,
) -> DataFrame:
    """C3, batch form: history from all snapshots at once.

    ``stacked`` holds every snapshot's rows plus ``version_col``. Each row needs
    the previous and next *snapshot* version: of ``versions`` when given, else of
    the distinct versions found. Rows with a NULL version are not applied.
    """
    keys = _as_list(keys)
    check_columns(stacked, [*keys, version_col], "scd2_from_snapshots")
    data_cols = [c for c in stacked.columns if c != version_col]
    tracked = tracked_columns(stacked.drop(version_col), keys, [], track, track_except)
    rest = tie_break_columns(stacked, [*keys, version_col])
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in (version_col, *rest)])
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ver = F.col(version_col)
    one_per_version = (
        _neighbours(stacked, version_col, versions)
        .withColumn("__dup", F.lead(version_col).over(w))
        .filter(F.col("__dup").isNull() | (F.col("__dup") != ver))
    )
    trk = F.struct(*[F.col(c) for c in tracked]) if tracked else F.struct(F.lit(0))
    flagged = (
        one_per_version.withColumn("__trk", trk)
        .withColumn(
            "__opens",
            ~F.lag(version_col).over(w).eqNullSafe(F.col("__prev_v")) | F.lag(version_col).over(w).isNull()
            | ~F.lag("__trk").over(w).eqNullSafe(F.col("__trk")),
        )
        .withColumn(
            "__closes",
            ~F.lead(version_col).over(w).eqNullSafe(F.col("__next_v")) | F.col("__next_v").isNull()
            | ~F.lead("__trk").over(w).eqNullSafe(F.col("__trk")),
        )
    )
    return (
        flagged.withColumn(START_AT, F.last(F.when(F.col("__opens"), ver), ignorenulls=True).over(running))
        .filter(F.col("__closes"))
        .select(*data_cols, START_AT, F.col("__next_v").alias(END_AT))
    )
