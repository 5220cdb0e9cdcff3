"""Keep an SCD table up to date from the growing bronze table.

Silver is stored by key bucket (``pmod(xxhash64(keys), N)``, in a column named after keys and N; all rows of a key share
a bucket) and, inside it, by the era in which a version ended (a month of the sequence; open versions in an era of their
own, the last). A row can change the versions around it only: the one that it falls into, the one before if it falls on
a start or between two, and the one after. Of each key that a micro-batch brings rows for:

1. the versions that its rows can change are found among the stored starts, ends and last sequences (of the batch's
   keys, from the batch's first era of the bucket on);
2. a version that a row falls into (between its start and its last row) is read again from bronze, only that version's
   rows, dealt by key and era; a version that rows fall beside takes part as its one stored row, standing at its start;
3. windows run over these and the batch's rows, apart for each run of neighbouring changed versions; what follows a run
   is its stored edge, the start at which its last version ends;
4. the result, with the unchanged versions of the eras where something changed, is written to a stage first and then
   takes the place of just these eras of the bucket. All other files are neither read nor written.

A key of very many rows is therefore never read again as a whole, and neither are the eras behind a late row. Where so many
versions or rows of a key take part that its windows would fill a task, they run over slices of its time (``operators.slices``).
Rows of bronze that later micro-batches will bring may take part early if they lie in a version read again; they
are applied again, to the same end, when their batch comes.

Work is dealt by key, over all shuffle partitions however few the buckets; only the last step gathers a bucket's era, in
as many tasks and files as its share of the staged bytes asks for (``file_bytes``), so neither many keys in one bucket nor
one key of many versions makes one task or file of it.

A micro-batch of few rows would still rewrite every era that they fall into. Where a run takes bronze in several
micro-batches (``max_files_per_trigger``), the rows of one are put aside (``waiting`` beside the stage) until what waits
holds as many bytes as the table, and are then applied together, the last of them when the run ends: the table is rewritten
as often as it doubles, not once for each micro-batch. Rows that wait when a run fails are applied by the next one.

Late and out-of-order rows are therefore exact (no watermark is needed). A batch that failed on the way is repeated
from its stage, if that was complete, so it never starts from half-replaced eras. SCD type 1 needs no bronze: the
newest of the stored row and the batch's rows stays. One writer per silver table is assumed; a reader may see old and
new eras of a bucket side by side while a batch commits.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, NumericType, StructField, StructType, TimestampNTZType, TimestampType

from ..operators import cdc, segmented, slices
from ..sources.files import BUCKET_PREFIX, CORRUPT, LINEAGE, REASON, bucket_column, bucket_of, without_buckets
from ..schemas import evolve, fitted, read_stored
from ..sources.tables import read_table, stream_table
from ..storage import exists, folder_bytes, list_folders, read_small, remove_folder, write_small
from . import change_feed

NULL_SEQUENCE = "null_sequence"


def plain_rows(bronze: DataFrame) -> DataFrame:
    """Good rows of a bronze table: quarantined ones, and the columns that only keep book, are left out.
    Lineage columns stay."""
    rows = bronze.filter(F.col(REASON).isNull()) if REASON in bronze.columns else bronze
    return without_buckets(rows).drop(CORRUPT, REASON)


def untracked_lineage(df: DataFrame, track: Sequence[str] | None, track_except: Sequence[str] | None) -> list[str]:
    """The except-list with the lineage columns: an ingest alone opens no version, unless ``track`` names them."""
    return list(dict.fromkeys([*(track_except or []), *(c for c in LINEAGE if c in df.columns and c not in (track or []))]))


ERA = f"{BUCKET_PREFIX}era"
OPEN_ERA = 9_000_000_000_000_000_000


def era_of(df: DataFrame, column: str, width: float | None = None) -> Column:
    """The era of a sequence value: its month, or for numbers its multiple of ``width`` (without one, all numbers
    are of one era)."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return (F.year(c) * 12 + F.month(c)).cast("long")
    if width and isinstance(kind, NumericType):
        return F.floor(c / F.lit(width)).cast("long")
    return F.when(c.isNotNull(), F.lit(0).cast("long"))


_null_safe = slices.null_safe


def _nearest(value: Column, keys: Sequence[str], order: Sequence[Column]) -> Column:
    """The last value that is not NULL among the rows before."""
    return F.last(value, ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))


def _carried(df: DataFrame, ends: DataFrame, keys: Sequence[str], before: dict[str, str], after: dict[str, str]) -> DataFrame:
    """``df`` with what the slices before (``before``: new column to one of ``ends``) and after theirs (``after``) hold last and
    first; ``ends`` has a row for each slice of a hot key."""
    side = ends.select(
        *keys, slices.SLICE, *[_nearest(F.col(c), keys, [F.col(slices.SLICE).asc()]).alias(name) for name, c in before.items()],
        *[_nearest(F.col(c), keys, [F.col(slices.SLICE).desc()]).alias(name) for name, c in after.items()])
    return df.alias("l").join(F.broadcast(side).alias("r"), _null_safe([*keys, slices.SLICE]), "left").select(
        "l.*", *[f"r.{name}" for name in (*before, *after)])


def versions_near(
    versions: DataFrame, points: DataFrame, keys: Sequence[str], sequence: str, hot: slices.HotKeys | None = None, path: str | None = None,
) -> DataFrame:
    """(keys, __at, __version, __split, __until): every sequence value of ``points``, and every version (by its start) that a
    row there can change, which is one with a point from the start of the version before it to its own end. ``__split``:
    a point lies between the version's start and its last row, so its rows are needed; else its stored row stands for
    all of them. ``__until``: the start of the next version that stays as it is (NULL if none does), which is the
    same for neighbours that change together. Windows run over slices of the ``hot`` keys, for which ``path`` stores the
    versions that change."""
    at, is_version = F.col("__at"), F.col("__version") == 1
    kind = versions.schema[cdc.START_AT].dataType
    none = F.lit(None).cast(kind)
    rows = versions.select(
        *keys, F.col(cdc.START_AT).alias("__at"), F.col(cdc.END_AT).alias("__end"),
        F.col(sequence).cast(kind).alias("__last"), F.lit(1).alias("__version"),
    ).unionByName(points.select(
        *keys, F.col(sequence).cast(kind).alias("__at"), none.alias("__end"), none.alias("__last"), F.lit(0).alias("__version")))
    rows, group = slices.with_slice(rows, hot, keys, at), [*keys, *([] if hot is None else [slices.SLICE])]
    ascending, descending = [at.asc(), F.col("__version")], [at.desc(), F.col("__version")]
    forward = Window.partitionBy(*group).orderBy(*ascending)
    nearest = lambda where, order: _nearest(F.when(where, at), group, order)
    found = rows.withColumns({
        "__below": nearest(~is_version, ascending), "__before": nearest(is_version, ascending),
        "__again": ~is_version & F.coalesce((F.lag("__version").over(forward) == 0) & (F.lag(at).over(forward) == at), F.lit(False)),
    }).filter(~F.col("__again")).withColumn("__above", nearest(~is_version, descending))  # a point of several rows counts once
    if hot is not None:
        ends = slices.of_hot(rows).groupBy(*group).agg(
            F.min(F.when(~is_version, at)).alias("__first_point"), F.max(F.when(~is_version, at)).alias("__last_point"),
            F.max(F.when(is_version, at)).alias("__last_version"))
        found = _carried(
            found, ends, keys, {"__c_below": "__last_point", "__c_before": "__last_version"}, {"__c_above": "__first_point"})
        found = found.withColumns({f"__{c}": F.coalesce(f"__{c}", f"__c_{c}") for c in ("below", "before", "above")})
    below, above, before, end, last = (F.col(f"__{c}") for c in ("below", "above", "before", "end", "last"))
    changes = (below.isNotNull() & (before.isNull() | (below >= before))) | (above.isNotNull() & (end.isNull() | (above <= end)))
    found = found.withColumn("__changes", is_version & changes).withColumn("__split", F.coalesce(above <= last, F.lit(False)))
    stays, columns = is_version & ~F.col("__changes"), [*keys, "__at", "__version", "__split", "__until"]
    if hot is None:
        found = found.withColumn("__until", nearest(stays, descending))
    else:
        found.select(*group, "__at", "__version", "__split", "__changes").write.mode("overwrite").parquet(path)
        found = rows.sparkSession.read.parquet(path)
        ends = slices.of_hot(found).groupBy(*group).agg(F.min(F.when(stays, at)).alias("__first_stays"))
        found = _carried(found.withColumn("__until", nearest(stays, descending)), ends, keys, {}, {"__c_until": "__first_stays"})
        found = found.withColumn("__until", F.coalesce("__until", "__c_until"))
    return found.filter(~is_version | F.col("__changes")).select(*columns)


def _rows_of_versions(
    rows: DataFrame, ranges: DataFrame, by_key: Sequence[str], sequence: str, era_width: float | None, hot: slices.HotKeys | None = None,
) -> DataFrame:
    """The rows that lie in the given versions (keys, __from, __to, __until), dealt by key and era, those of ``hot`` keys by
    key and slice. Versions of a key do not overlap, so in the order of time only the last one that has begun can hold a
    row: one sort, however many versions and rows a key has in an era. Keys and eras without such a version are left out
    before."""
    kind = ranges.schema["__from"].dataType

    def era(df: DataFrame, column: str) -> Column:
        own = era_of(df, column, era_width)
        if hot is None:
            return own
        return F.when(F.col(slices.BOUNDS).isNull(), own).otherwise(
            slices.place_among(F.col(slices.BOUNDS), hot.most, F.col(column).cast(kind)).cast("long"))

    bounded = (lambda df: df) if hot is None else (lambda df: slices.with_bounds(df, hot, by_key))
    ranges_, rows_, names = bounded(ranges), bounded(rows), rows.columns
    spread = ranges_.withColumn("__era", F.explode(F.sequence(era(ranges_, "__from"), era(ranges_, "__to"))))
    placed, place = rows_.withColumn("__era", era(rows_, sequence)), [*by_key, "__era"]
    met = placed.alias("l").join(spread.select(*place).distinct().alias("r"), _null_safe(place), "left_semi")
    version, row = F.struct("__to", "__until").alias("__version"), F.struct(*names).alias("__row")
    held, found = met.select(*place, row), spread.select(*place, version)
    events = met.select(
        *place, F.col(sequence).cast(kind).alias("__at"), F.lit(1).alias("__order"),
        F.lit(None).cast(found.schema["__version"].dataType).alias("__version"), row,
    ).unionByName(spread.select(
        *place, F.col("__from").alias("__at"), F.lit(0).alias("__order"), version,
        F.lit(None).cast(held.schema["__row"].dataType).alias("__row")))
    begun = Window.partitionBy(*place).orderBy("__at", "__order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = events.withColumn("__version", F.last("__version", ignorenulls=True).over(begun))
    return last.filter((F.col("__order") == 1) & (F.col("__at") <= F.col("__version.__to"))).select("__row.*", "__version.__until")


def stage_scd1(new_rows: DataFrame, silver: DataFrame | None, by_key: Sequence[str], seq: Sequence[str], schema: StructType, stage: str) -> None:
    """The newest row of every key in the touched buckets, whose only era is the open one."""
    rows = new_rows if silver is None else silver.select(*new_rows.columns).unionByName(new_rows)
    now = cdc.scd1_from_changes(rows, by_key, seq).withColumn(ERA, F.lit(OPEN_ERA))
    fitted(now, schema).write.mode("overwrite").parquet(f"{stage}/fresh_rows")


def stage_scd2(
    new_rows: DataFrame,
    bronze: DataFrame,
    silver: DataFrame | None,
    by_key: Sequence[str],
    seq: Sequence[str],
    schema: StructType,
    stage: str,
    track: Sequence[str] | None = None,
    track_except: Sequence[str] | None = None,
    segments: int | None = None,
    era_width: float | None = None,
) -> set[tuple[int, int]]:
    """Write below ``stage`` what a batch changes: the versions that go (``gone``, if there is a table) and those that
    take their place (``fresh``). ``bronze`` and ``silver`` are what the touched buckets hold from the batch's first eras on.
    Returns the (bucket, era) places of both."""
    spark, s0, own = new_rows.sparkSession, seq[0], by_key[0]
    places: set[tuple[int, int]] = set()
    rows = new_rows.withColumns({"__at": F.col(s0), "__until": F.lit(None).cast(new_rows.schema[s0].dataType)})
    times = lambda df, c: df.select(*by_key, F.col(c).alias("__at"))
    of_keys = lambda df, keyed: df.alias("l").join(
        keyed.select(*by_key).distinct().alias("r"), _null_safe(by_key), "left_semi")
    taking_part, read_again = times(new_rows, s0), False
    if silver is not None:
        of_batch = of_keys(silver, new_rows)
        hot = slices.hot_slices(times(of_batch, cdc.START_AT).unionByName(taking_part), by_key, f"{stage}/hot_versions")
        versions_near(of_batch, new_rows, by_key, s0, hot, f"{stage}/near_found").write.mode("overwrite").parquet(f"{stage}/near")
        near = spark.read.parquet(f"{stage}/near")
        points = near.filter("__version = 0")
        rows = new_rows.alias("l").join(
            points.alias("r"), _null_safe(by_key) & (F.col(f"l.{s0}") == F.col("r.__at"))).select("l.*", "r.__at", "r.__until")
        silver.alias("l").join(
            near.filter("__version = 1").alias("r"), _null_safe(by_key) & (F.col(f"l.{cdc.START_AT}") == F.col("r.__at"))
        ).select("l.*", "r.__split", "r.__until").write.mode("overwrite").parquet(f"{stage}/gone")
        gone = spark.read.parquet(f"{stage}/gone")
        standing = gone.filter(~F.col("__split")).withColumn("__at", F.col(cdc.START_AT))
        rows = rows.unionByName(standing.select(*rows.columns))
        ranges = gone.filter("__split").select(
            *by_key, F.col(cdc.START_AT).alias("__from"), F.col(s0).cast(gone.schema[cdc.START_AT].dataType).alias("__to"), "__until")
        start, last = (F.when(F.col("__split"), F.col(c)) for c in (cdc.START_AT, s0))
        bounds = gone.groupBy(own, ERA).agg(F.min(start), F.max(last)).collect()
        places = {(r[0], r[1]) for r in bounds}
        split = [r for r in bounds if r[2] is not None]
        if split:  # both bounds reach the scan: files and row groups of other times are skipped
            least, most = min(r[2] for r in split), max(r[3] for r in split)
            # A time that reached the driver may be off by a change of clocks; the join below is exact.
            slack = F.expr("INTERVAL '1' DAY") if isinstance(gone.schema[cdc.START_AT].dataType, TimestampType) else None
            low, high = (F.lit(least), F.lit(most)) if slack is None else (F.lit(least) - slack, F.lit(most) + slack)
            reach = bronze.filter((F.col(s0) >= low) & (F.col(s0) <= high))
            taking_part, read_again = taking_part.unionByName(times(of_keys(reach, ranges), s0)), True
    hot = slices.hot_slices(taking_part, by_key, f"{stage}/hot_rows")
    if read_again:
        again = _rows_of_versions(reach, ranges, by_key, s0, era_width, hot).withColumn("__at", F.col(s0))
        rows = rows.unionByName(again.select(*rows.columns))
    plan = {"track": track, "track_except": untracked_lineage(new_rows, track, track_except)}
    keys, sequence = [*by_key, "__until"], ["__at", *seq]
    if hot is None:
        history = cdc.scd2_from_changes(rows, keys, sequence, segments=segments, **plan)
    else:
        rows = slices.with_slice(rows, hot, by_key, F.col("__at"))
        if read_again:  # found once, for both kinds of keys
            rows.write.mode("overwrite").parquet(f"{stage}/rows")
            rows = spark.read.parquet(f"{stage}/rows")
        few = rows.filter(F.col(slices.SLICE) < 0).drop(slices.SLICE)
        history = cdc.scd2_from_changes(few, keys, sequence, segments=segments, **plan).unionByName(
            segmented.scd2_from_changes_segmented(
                slices.of_hot(rows), keys, sequence, ranges=slices.SLICE, path=f"{stage}/hot_local", **plan))
    history = history.withColumn(cdc.END_AT, F.coalesce(cdc.END_AT, "__until")).drop("__at", "__until")
    history = history.withColumn(ERA, F.coalesce(era_of(history, cdc.END_AT, era_width), F.lit(OPEN_ERA)))
    fitted(history, schema).write.mode("overwrite").parquet(f"{stage}/fresh_rows")
    changed = spark.read.schema(schema).parquet(f"{stage}/fresh_rows").select(own, ERA).distinct().collect()
    return places | {(r[0], r[1]) for r in changed}


def without_versions(silver: DataFrame, gone: DataFrame, by_key: Sequence[str]) -> DataFrame:
    """The stored versions but those in ``gone``."""
    same = _null_safe(by_key) & (F.col(f"l.{cdc.START_AT}") == F.col(f"r.{cdc.START_AT}"))
    return silver.alias("l").join(gone.alias("r"), same, "left_anti")


#: Bytes of a stage that make one file of a silver table.
FILE_BYTES = 128 << 20


def replace_eras(
    spark: SparkSession, stages: Sequence[str], silver_path: str, own: str, places: Sequence[tuple[int, int]],
    file_bytes: int = FILE_BYTES,
) -> None:
    """Let the staged rows take the place of the (bucket, era) places; those that the stages no longer have go. The rows of
    each place (as many numbers reach the driver) say over how many tasks it is dealt."""
    staged = spark.read.parquet(*stages)
    counts = {(r[0], r[1]): r[2] for r in staged.groupBy(own, ERA).count().collect()}
    row_bytes = sum(folder_bytes(spark, stage) for stage in stages) / max(1, sum(counts.values()))
    many = {place: -(-int(n * row_bytes) // file_bytes) for place, n in counts.items() if n * row_bytes > file_bytes}
    share = F.lit(0)
    if many:
        shares = F.create_map(*[F.lit(x) for (bucket, era), n in many.items() for x in (f"{bucket}/{era}", n)])
        place = F.concat_ws("/", own, ERA)
        plain = [c for c in staged.columns if staged.schema[c].dataType.typeName() not in ("map", "variant")]
        share = F.pmod(F.xxhash64(*plain), F.coalesce(shares[place], F.lit(1)))
    (
        staged.repartition(own, ERA, share).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(own, ERA).parquet(silver_path)
    )
    for bucket, era in places:
        if (bucket, era) not in counts:
            remove_folder(spark, f"{silver_path}/{own}={bucket}/{ERA}={era}")


def apply_changes(
    spark: SparkSession,
    bronze: str,
    silver_path: str,
    checkpoint: str,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    buckets: int = 64,
    track: Sequence[str] | None = None,
    track_except: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    scd_type: int = 2,
    max_files_per_trigger: int | None = None,
    wait: bool = True,
    segments: int | None = None,
    quarantine_path: str | None = None,
    era_width: float | None = None,
    file_bytes: int = FILE_BYTES,
    feed_path: str | None = None,
):
    """Run the silver stream over everything bronze (a table's name or its folder) holds now (``availableNow``).

    Rows that cannot be applied (quarantined by ingest, or without a sequence value) go to ``quarantine_path``, by
    micro-batch, so a repeated batch replaces its own. ``era_width`` sets the eras of a numeric sequence. Columns that bronze
    has gained or widened since the last run are taken into silver and quarantine (``schemas.evolve``). With ``feed_path``
    every micro-batch adds what it changed to a feed there (``change_feed``).
    """
    changes = stream_table(spark, bronze, max_files_per_trigger=max_files_per_trigger)
    key_list = list(keys)
    own = bucket_column(key_list, buckets)
    by_key, seq, scd1 = [own, *key_list], [sequence_by] if isinstance(sequence_by, str) else list(sequence_by), int(scd_type) == 1

    placed = lambda df: plain_rows(df).withColumn(own, bucket_of(key_list, buckets))
    stages, waiting = (f"{checkpoint.rstrip('/')}/{name}" for name in ("stage", "waiting"))

    def stage_rows(session: SparkSession, new_rows: DataFrame, stage: str) -> bool:
        """Write what the rows change below ``stage``, its places last; False if there is no row to apply."""
        first_eras = {r[0]: r[1] for r in new_rows.groupBy(own).agg(F.min(era_of(new_rows, seq[0], era_width))).collect()}
        if not first_eras:
            return False
        touched, kind = list(first_eras), new_rows.schema[seq[0]].dataType
        versions = [] if scd1 else [StructField(cdc.START_AT, kind), StructField(cdc.END_AT, kind)]
        schema = evolve(
            session, silver_path, StructType([*new_rows.schema.fields, *versions, StructField(ERA, LongType())]), (own, ERA, *key_list))
        row_schema = StructType([schema[c] for c in new_rows.columns])
        new_rows, whole, silver, gone = fitted(new_rows, row_schema), None, None, None
        if list_folders(session, silver_path):
            firsts = F.create_map(*[F.lit(x) for pair in first_eras.items() for x in pair])
            whole = fitted(read_stored(session, silver_path), schema)
            silver = whole.filter(F.col(own).isin(touched))
            if not scd1:
                silver = silver.filter(F.col(ERA) >= firsts[F.col(own)])
        if scd1:
            stage_scd1(new_rows, silver, by_key, seq, schema, stage)
            places = [(b, OPEN_ERA) for b in touched]
            gone = silver
        else:
            source = read_table(session, bronze)
            if columns:
                source = source.select(*[c for c in source.columns if c in columns or c in (REASON, CORRUPT, own)])
            at_hand = F.col(own).isin(touched) if own in source.columns else bucket_of(key_list, buckets).isin(touched)
            places = stage_scd2(
                new_rows, fitted(placed(source.filter(at_hand)), row_schema), silver, by_key, seq, schema, stage,
                track, track_except, segments, era_width)
            if silver is not None:
                gone = session.read.parquet(f"{stage}/gone")
                here = F.col(own).isin(sorted({b for b, _ in places})) & F.col(ERA).isin(sorted({e for _, e in places}))
                here = here & F.concat_ws("/", own, ERA).isin([f"{b}/{e}" for b, e in places])
                without_versions(whole.filter(here), gone, by_key).write.mode("overwrite").parquet(f"{stage}/carried")
        if feed_path:
            after, before = session.read.schema(schema).parquet(f"{stage}/fresh_rows"), None
            if whole is not None and not list_folders(session, feed_path):
                # a feed of a table that was there before begins with all of its rows
                rest = whole.filter(~F.col(own).isin(touched)) if scd1 else without_versions(whole, gone, by_key)
                after = after.unionByName(rest.select(*after.columns))
            elif gone is not None:
                before = gone.select(*after.columns)
                if scd1:
                    batch_keys = new_rows.select(*by_key).distinct()
                    of_batch = lambda df: df.alias("l").join(batch_keys.alias("r"), _null_safe(by_key), "left_semi")
                    before, after = of_batch(before), of_batch(after)
            changes = change_feed.changes_between(
                None if before is None else before.drop(own, ERA), after.drop(own, ERA), key_list, scd_type)
            change_feed.stage_changes(session, changes, f"{stage}/feed", feed_path)
        write_small(session, f"{stage}/places.json", json.dumps(sorted(places)))
        return True

    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        batch = batch.select(*[c for c in batch.columns if columns is None or c in columns or c in (REASON, CORRUPT)])
        if quarantine_path:
            reason = F.col(REASON) if REASON in batch.columns else F.lit(None).cast("string")
            late = F.lit(False)
            for c in seq:
                late = late | F.col(c).isNull()
            bad = without_buckets(batch).withColumn(REASON, F.coalesce(reason, F.when(late, F.lit(NULL_SEQUENCE)))).filter(
                F.col(REASON).isNotNull())
            fitted(bad, evolve(session, quarantine_path, bad.schema)).write.mode("overwrite").parquet(f"{quarantine_path}/batch={epoch_id}")
        if not exists(session, f"{stages}/batch={epoch_id}/places.json"):
            rows = placed(batch)
            for c in seq:
                rows = rows.filter(F.col(c).isNotNull())
            gathers = wait and max_files_per_trigger
            if gathers or list_folders(session, waiting):
                fitted(rows, evolve(session, waiting, rows.schema)).write.mode("overwrite").parquet(f"{waiting}/batch={epoch_id}")
                if gathers and folder_bytes(session, waiting) < folder_bytes(session, silver_path):
                    return
                rows = None
            apply_rows(session, rows, epoch_id)
        else:
            apply_rows(session, None, epoch_id)

    def apply_rows(session: SparkSession, rows: DataFrame | None, epoch_id: int) -> None:
        """Apply the rows, or all that wait, under the number of their last micro-batch; from its stage, if that is complete."""
        stage = f"{stages}/batch={epoch_id}"
        done = f"{stage}/places.json"
        if not exists(session, done):
            if rows is None:
                rows = read_stored(session, *[f"{waiting}/{name}" for name in list_folders(session, waiting)], table=waiting)
            if not stage_rows(session, rows, stage):
                remove_folder(session, waiting)
                return
        places = [(bucket, era) for bucket, era in json.loads(read_small(session, done))]
        stored = [p for p in (f"{stage}/fresh_rows" if exists(session, f"{stage}/fresh_rows") else f"{stage}/fresh", f"{stage}/carried") if exists(session, p)]
        replace_eras(session, stored, silver_path, own, places, file_bytes)
        if feed_path:
            change_feed.publish_changes(session, f"{stage}/feed", feed_path)
        remove_folder(session, waiting)
        for name in list_folders(session, stages):
            if name != f"batch={epoch_id}":
                remove_folder(session, f"{stages}/{name}")

    def last_waiting() -> int | None:
        return max((int(name.partition("=")[2]) for name in list_folders(spark, waiting)), default=None)

    last = last_waiting()
    if last is not None and exists(spark, f"{stages}/batch={last}/places.json"):
        apply_rows(spark, None, last)  # a run ended while these took their place
    q = (
        changes.writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        last = last_waiting()
        if last is not None:
            apply_rows(spark, None, last)
        return None
    return q


def read_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    """The SCD table without its bucket column."""
    return without_buckets(read_stored(spark, silver_path))
