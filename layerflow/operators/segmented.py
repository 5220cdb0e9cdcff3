"""Hot-key-safe SCD2: the change feed of each key is cut into sequence ranges.

The plain plan (``cdc.scd2_from_changes``) sorts all rows of a key in one task.
When one key may hold a large share of the feed, this plan spreads it out:

1. ``__seg``: which of B ranges of the first sequence column a row falls in.
   The range bounds are global approximate quantiles (B-1 numbers on the
   driver), so every key's rows spread over up to B tasks in proportion to the
   data. Equal sequence values share a range, so same-instant rows stay together.
2. Per (key, range) window: local de-duplication, local change flags, and the
   last local island start.
3. Per (key, range) boundary row (first and last row's tracked values and
   sequence, last local start): an aggregate over the same partitioning.
4. Window over the boundary rows of each key (B rows for a hot key): whether a
   range's first row opens a version, the start of the version still open
   when the range begins, and the next range's first row.
5. Boundary info joined back on (key, range) to the stored result of step 2.

The feed is scanned and shuffled once (steps 2 and 3 read the stored local
result); the join of step 5 moves it again unless the boundary rows are few
enough for Spark to broadcast them.

Same result as the plain plan (tests compare both with brute force).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from ..session import scratch_path
from .cdc import END_AT, START_AT, _as_list, _check, _with_sequence, tracked_columns
from .ordering import tie_break_columns

SEG = "__seg"
KID = "__kid"


def _numeric(df: DataFrame, name: str) -> Column:
    """An order-preserving number for the sequence column (for range bounds)."""
    t = df.schema[name].dataType
    c = F.col(name)
    if isinstance(t, TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(t, TimestampNTZType):
        # From the fields of the wall clock: a cast to timestamp would go through the session time zone, which
        # repeats an hour at a clock change.
        day = F.unix_date(c.cast("date")).cast("double")
        second = F.extract(F.lit("SECOND"), c).cast("double")
        return day * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + second
    if isinstance(t, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(t, NumericType):
        return c.cast("double")
    raise ValueError(f"sequence column {name!r} of type {t.simpleString()} cannot be split into ranges")


def range_bounds(df: DataFrame, seq0: str, segments: int, rel_error: float = 0.001) -> list[float]:
    """B-1 approximate quantiles of the first sequence column (one small result)."""
    if segments < 2:
        return []
    probs = [i / segments for i in range(1, segments)]
    num = df.select(_numeric(df, seq0).alias("__n")).filter(F.col("__n").isNotNull())
    bounds = num.approxQuantile("__n", probs, rel_error)
    return sorted(set(bounds))


def _range_of(value: Column, bounds: Sequence[float]) -> Column:
    """How many of the sorted bounds are <= the value, by bisection over one array."""
    if not bounds:
        return F.lit(0)
    array = F.array(*[F.lit(float(b)) for b in bounds])
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def step(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        at_or_below = F.coalesce(F.get(array, mid) <= value, F.lit(False)) & (s["lo"] < s["hi"])
        return F.struct(
            F.when(at_or_below, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(at_or_below, s["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(steps, start, step, lambda s: s["lo"])


def scd2_from_changes_segmented(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    track: Sequence[str] | None = None,
    track_except: Sequence[str] | None = None,
    segments: int = 64,
    bounds: Sequence[float] | None = None,
    ranges: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """C1 with every key split over up to ``segments`` sequence ranges, or over those that the column ``ranges`` numbers
    (in the order of the sequence, equal values in one). The local result is stored at ``path``."""
    keys, seq = _as_list(keys), _as_list(sequence_by)
    _check(df, keys, seq)
    plain = df if ranges is None else df.drop(ranges)
    tracked = tracked_columns(plain, keys, seq, track, track_except)
    columns = plain.columns
    rest = tie_break_columns(plain, [*keys, *seq])
    s0 = F.col(seq[0])
    src = _with_sequence(df, seq)
    if bounds is None and ranges is None:
        bounds = range_bounds(src, seq[0], segments)

    def build_local() -> DataFrame:
        """Per-range window pass: the one full shuffle."""
        rows = src.withColumn(KID, F.struct(*[F.col(k) for k in keys])).withColumn(
            SEG, _range_of(_numeric(src, seq[0]), bounds) if ranges is None else F.col(ranges))
        out = (
            rows.withColumn("__next", F.lead(s0).over(wl))
            .filter(F.col("__next").isNull() | (F.col("__next") != s0))
            .withColumn("__trk", trk)
            .withColumn("__rn", F.row_number().over(wl))
            .withColumn("__lnext_trk", F.lead("__trk").over(wl))
            .withColumn("__lnext_s0", F.lead(s0).over(wl))
            .withColumn("__lopens", (F.col("__rn") > 1) & ~F.lag("__trk").over(wl).eqNullSafe(F.col("__trk")))
        )
        return out.withColumn(
            "__lstart", F.last(F.when(F.col("__lopens"), s0), ignorenulls=True).over(running)
        ).withColumn("__is_last", F.col("__lnext_s0").isNull())

    wl = Window.partitionBy(KID, SEG).orderBy(*[F.col(c).asc_nulls_first() for c in (*seq, *rest)])
    running = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    trk = F.struct(*[F.col(c) for c in tracked]) if tracked else F.struct(F.lit(0))
    # Stored once: the boundary rows and the final join read it, so the feed is scanned and shuffled once.
    spark = df.sparkSession
    path = path or scratch_path(spark, "segmented")
    build_local().write.mode("overwrite").parquet(path)
    local = spark.read.parquet(path)

    rn = F.col("__rn")
    edges = local.groupBy(KID, SEG).agg(
        F.min_by(s0, rn).alias("__e_f_s0"),
        F.min_by("__trk", rn).alias("__e_f_trk"),
        F.max_by("__trk", rn).alias("__e_l_trk"),
        F.max_by("__lstart", rn).alias("__e_l_start"),
    )
    wk = Window.partitionBy(KID).orderBy(SEG)
    f_opens = F.lag(SEG).over(wk).isNull() | ~F.lag("__e_l_trk").over(wk).eqNullSafe(F.col("__e_f_trk"))
    stitched = (
        edges.withColumn("__f_opens", f_opens)
        .withColumn("__seg_start", F.coalesce(F.col("__e_l_start"), F.when(F.col("__f_opens"), F.col("__e_f_s0"))))
        .withColumn(
            "__carried",
            F.last("__seg_start", ignorenulls=True).over(wk.rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select(
            KID, SEG, "__f_opens", "__carried", F.col("__e_f_s0").alias("__f_s0"),
            F.lead("__e_f_trk").over(wk).alias("__next_f_trk"), F.lead("__e_f_s0").over(wk).alias("__next_f_s0"),
        )
    )

    joined = local.join(stitched, [KID, SEG])
    last_row = F.col("__is_last")
    next_trk = F.when(last_row, F.col("__next_f_trk")).otherwise(F.col("__lnext_trk"))
    closes = ~next_trk.eqNullSafe(F.col("__trk"))
    start = F.coalesce(F.col("__lstart"), F.when(F.col("__f_opens"), F.col("__f_s0")), F.col("__carried"))
    end = F.when(last_row, F.col("__next_f_s0")).otherwise(F.col("__lnext_s0"))
    return joined.filter(closes).select(*columns, start.alias(START_AT), end.alias(END_AT))
