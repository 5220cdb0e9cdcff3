"""The registered queries: each one reads the generated tables of a scale
directory and runs one or more library operators over the whole of them.

``QUERIES[name](spark, sf_dir) -> DataFrame``. Outputs are flat and every
computed column is aliased, so they compare column-by-column with the DuckDB
formulations in ``plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators import cdc, dedup, nested, segmented, snapshot
from . import control, gold
from ..functions.lineage import file_date
from ..session import scratch_path, shared_dir
from ..history import SnapshotStore
from ..sources import files, landing
from ..streaming import cdc_stream, change_feed
from ..sources.tables import fixture, read_table, stream_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return wrap


# ---------------------------------------------------------------- W1, W2, P8

ORDER_KEYS = ["o_orderdate", "o_orderkey"]


@register("first_per_key")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Oldest order of every customer (the reference's snapshot view)."""
    return dedup.first_per_key(fixture(spark, sf_dir, "orders"), ["o_custkey"], ORDER_KEYS)


@register("latest_per_key")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest order of every customer."""
    return dedup.latest_per_key(fixture(spark, sf_dir, "orders"), ["o_custkey"], ORDER_KEYS)


@register("rank_within_keys")
def rank_within_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every order among its customer's, in order date and key."""
    orders = fixture(spark, sf_dir, "orders").select("o_custkey", *ORDER_KEYS)
    return dedup.rank_within_keys(orders, ["o_custkey"], ORDER_KEYS)


# ---------------------------------------------------------------- C1, C2, C5, C6, P5

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "events")


@register("scd1_changes")
def scd1_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.scd1_from_changes(_events(spark, sf_dir), ["user_id"], "ts")


@register("scd2_changes")
def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _events(spark, sf_dir).select("user_id", "ts", "event_type")
    return cdc.scd2_from_changes(feed, ["user_id"], "ts", track=["event_type"])


@register("scd2_changes_segmented")
def scd2_changes_segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``scd2_changes``, with every user's feed split over 16 time ranges
    (the plan for feeds where one key may hold a large share of the rows)."""
    feed = _events(spark, sf_dir).select("user_id", "ts", "event_type")
    return segmented.scd2_from_changes_segmented(feed, ["user_id"], "ts", track=["event_type"], segments=16)


@register("scd2_changes_untracked")
def scd2_changes_untracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _events(spark, sf_dir).select("user_id", "ts", "event_type", "value")
    return cdc.scd2_from_changes(feed, ["user_id"], "ts", track=["event_type"])


@register("scd2_changes_except")
def scd2_changes_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.scd2_from_changes(
        _events(spark, sf_dir), ["user_id"], "ts", track_except=["event_id", "value", "props"]
    )


@register("scd2_changes_composite")
def scd2_changes_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.scd2_from_changes(
        fixture(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], track=["o_orderstatus"]
    )


@register("scd2_current")
def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.current_versions(scd2_changes(spark, sf_dir))


# ---------------------------------------------------------------- C3, C4

# Fixed values of the snapshot recipe: the snapshot dates, the last behind all orders. A snapshot shows the customers
# that ordered since the one before, so every order takes part in one, and customers come and go.
SNAPSHOT_CUTOFFS = [dt.date(1995, 1, 1), dt.date(1997, 1, 1), dt.date(1999, 1, 1), dt.date(2100, 1, 1)]


def order_snapshot(orders: DataFrame, since: dt.date | None, cutoff: dt.date) -> DataFrame:
    """State at ``cutoff``: each customer's newest order since the snapshot before."""
    rows = orders.filter(F.col("o_orderdate") < F.lit(cutoff).cast("timestamp_ntz"))
    if since is not None:
        rows = rows.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
    return dedup.latest_per_key(rows, ["o_custkey"], ORDER_KEYS)


def _snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixture(spark, sf_dir, "orders")
    shared_dir(spark)
    history = None
    for i, cutoff in enumerate(SNAPSHOT_CUTOFFS):
        history = snapshot.apply_snapshot(
            history, order_snapshot(orders, SNAPSHOT_CUTOFFS[i - 1] if i else None, cutoff), cutoff, ["o_custkey"], track=["o_orderstatus"]
        )
        if i < len(SNAPSHOT_CUTOFFS) - 1:
            # The next diff reads this history twice (open and closed rows):
            # materialize it in the shared checkpoint folder to cut lineage.
            history = history.checkpoint(eager=True)
    return history


@register("scd2_snapshots")
def scd2_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots applied one after another with the incremental diff."""
    return _snapshot_history(spark, sf_dir)


@register("scd1_snapshots")
def scd1_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every snapshot applied to a stored table, and an older one once more in between, which changes nothing."""
    orders, store = fixture(spark, sf_dir, "orders"), SnapshotStore(spark, scratch_path(spark, "snapshots"))
    for i, cutoff in enumerate(SNAPSHOT_CUTOFFS):
        store.apply(order_snapshot(orders, SNAPSHOT_CUTOFFS[i - 1] if i else None, cutoff), cutoff, ["o_custkey"], scd_type=1)
        if i == 2:
            store.apply(order_snapshot(orders, None, SNAPSHOT_CUTOFFS[0]), SNAPSHOT_CUTOFFS[0], ["o_custkey"], scd_type=1)
    return store.read()


@register("scd2_snapshots_stacked")
def scd2_snapshots_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All snapshots in one pass: every order lands in the first snapshot behind it, the newest per (customer,
    snapshot) is kept (before the shuffle as well as behind it), then islands."""
    orders = fixture(spark, sf_dir, "orders")
    version = F.lit(None).cast("date")
    for cutoff in reversed(SNAPSHOT_CUTOFFS):
        version = F.when(F.col("o_orderdate") < F.lit(cutoff).cast("timestamp_ntz"), F.lit(cutoff)).otherwise(version)
    newest = dedup.latest_per_key(
        orders.withColumn("snapshot_version", version), ["o_custkey", "snapshot_version"], ORDER_KEYS)
    return snapshot.scd2_from_snapshots(
        newest, ["o_custkey"], "snapshot_version", track=["o_orderstatus"], versions=SNAPSHOT_CUTOFFS
    )


# ---------------------------------------------------------------- G1-G3, P3-P6, Q1-Q6, S9

def nested_readings(lineitem: DataFrame) -> DataFrame:
    """Line items in the readings shape, one station record per line, from the line's own columns (no grouping, so no
    record grows with the data). Sensors: the part with two dates and a NULL one, the supplier with no dates (NULL for
    line 1, an empty list for line 2, else one date without a verdict and one without values), and a NULL sensor. Dates
    of the part: ship date, validated for line status F, with two measurements; the day after, validated for return
    flag R, with a measurement and a NULL one."""
    first = F.struct(
        F.col("l_quantity").alias("mean"), F.col("l_discount").alias("min"),
        F.col("l_tax").alias("max"), F.col("l_extendedprice").alias("total"),
    )
    second = F.struct(
        (F.col("l_quantity") + 1).alias("mean"), F.col("l_tax").alias("min"),
        F.col("l_discount").alias("max"), F.col("l_extendedprice").alias("total"),
    )
    nothing = F.when(F.lit(False), first)
    ship = F.col("l_shipdate").cast("date")

    def date(days: int, valid: Column, values: Column) -> Column:
        return F.struct(F.date_add(ship, days).alias("observation_date"), valid.alias("is_validated"), values.alias("values"))

    of_part = [
        date(0, F.col("l_linestatus") == "F", F.array(first, second)),
        date(1, F.col("l_returnflag") == "R", F.array(first, nothing)),
    ]
    of_supplier = F.array(
        date(0, F.lit(None).cast("boolean"), F.array(first)), date(2, F.lit(True), F.array_remove(F.array(first), first)))
    no_dates = F.slice(of_supplier, 1, 0)
    sensor = lambda key, dates: F.struct(F.col(key).alias("id_weatherstationsensor"), dates.alias("dates"))
    part = sensor("l_partkey", F.array(*of_part, F.when(F.lit(False), of_part[0])))
    supplier = sensor("l_suppkey", F.when(F.col("l_linenumber") == 2, no_dates).when(F.col("l_linenumber") != 1, of_supplier))
    return lineitem.select(
        F.col("l_orderkey").alias("id_weatherstation"), F.array(part, supplier, F.when(F.lit(False), part)).alias("sensors"))


# Gold SQL in the form the runner reads from a file, with the names a deployed file has.
READINGS_SQL = """
CREATE OR REFRESH MATERIALIZED VIEW weather.gold.readings AS (
  WITH per_sensor AS (
    SELECT id_weatherstation AS station, explode(sensors) AS s FROM readings_current
  ), per_day AS (
    SELECT station, s.id_weatherstationsensor AS sensor, explode(s.dates) AS d FROM per_sensor
  ), measured AS (
    SELECT station, sensor, d.observation_date AS day, explode(d.`values`) AS m FROM per_day WHERE d.is_validated
  )
  SELECT station AS id_weatherstation, sensor AS id_weatherstationsensor, day AS observation_date,
         m.mean, m.min, m.max, m.total
  FROM measured
);
"""


@register("gold_flatten")
def gold_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested_readings(fixture(spark, sf_dir, "lineitem")).createOrReplaceTempView("readings_current")
    return gold.build_views(spark, READINGS_SQL)["weather.gold.readings"]


@register("gold_flatten_api")
def gold_flatten_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.daily_readings(nested_readings(fixture(spark, sf_dir, "lineitem")))


GOLD_FILE_SQL = """
-- two views; statements other than materialized views are ignored
SET spark.sql.ansi.enabled = true;
create or refresh materialized view gold.customers_positive AS (
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal > 0
);
CREATE OR REFRESH MATERIALIZED VIEW gold.suppliers_by_nation as (
  SELECT s_nationkey, count(*) AS suppliers, round(sum(s_acctbal), 2) AS total_acctbal
  FROM supplier GROUP BY s_nationkey
);
"""


@register("gold_sql_file")
def gold_sql_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixture(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    fixture(spark, sf_dir, "supplier").createOrReplaceTempView("supplier")
    views = gold.build_views(spark, GOLD_FILE_SQL)
    return views["gold.customers_positive"]


@register("gold_sql_file_agg")
def gold_sql_file_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixture(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    fixture(spark, sf_dir, "supplier").createOrReplaceTempView("supplier")
    return gold.build_views(spark, GOLD_FILE_SQL)["gold.suppliers_by_nation"]


# A WITH that has the name of an earlier view, a comma join, FROM inside expressions, a view read in a subquery.
GOLD_NAMES_SQL = """
CREATE OR REFRESH MATERIALIZED VIEW trade.gold.rich AS (
  SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_acctbal > 0
);
CREATE OR REFRESH MATERIALIZED VIEW trade.gold.rich_by_nation AS (
  WITH rich AS (SELECT s_nationkey AS n, count(*) AS suppliers FROM supplier GROUP BY s_nationkey)
  SELECT rich.n AS nation, rich.suppliers, count(*) AS customers, round(sum(g.c_acctbal), 2) AS acctbal
  FROM rich, trade.gold.rich g
  WHERE rich.n = g.c_nationkey AND rich.n IS DISTINCT FROM g.c_acctbal
    AND EXISTS (SELECT 1 FROM gold.rich AS z WHERE z.c_custkey = g.c_custkey)
  GROUP BY rich.n, rich.suppliers
);
"""


@register("gold_cte_names")
def gold_cte_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of a gold file as Spark's parser sees them."""
    fixture(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    fixture(spark, sf_dir, "supplier").createOrReplaceTempView("supplier")
    return gold.build_views(spark, GOLD_NAMES_SQL)["trade.gold.rich_by_nation"]


CURRENT_ORDERS_SQL = """
CREATE OR REFRESH MATERIALIZED VIEW gold.orders_current as (
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate
FROM silver_orders
WHERE `__END_AT` IS NULL
);
"""


@register("gold_project")
def gold_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4-Q6 shape: projection of the current versions of a silver table."""
    scd2_changes_composite(spark, sf_dir).createOrReplaceTempView("silver_orders")
    return gold.build_views(spark, CURRENT_ORDERS_SQL)["gold.orders_current"]


# ---------------------------------------------------------------- S1-S3, S6, S10, P1, P2, B1-B4

# Declared schemas in the control table's JSON form.
EVENTS_SCHEMA = {
    "type": "struct",
    "fields": [
        {"name": "event_id", "type": "bigint", "nullable": False},
        {"name": "ts", "type": "timestamp", "nullable": True},
        {"name": "user_id", "type": "bigint", "nullable": True},
        {"name": "event_type", "type": "string", "nullable": True},
        {"name": "value", "type": "double", "nullable": True},
        {"name": "props", "type": "string", "nullable": True},
    ],
}
PART_SCHEMA = {
    "type": "struct",
    "fields": [
        {"name": "p_partkey", "type": "long", "nullable": False},
        {"name": "p_name", "type": "string"},
        {"name": "p_retailprice", "type": "decimal"},
    ],
}
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _event_landing_time() -> Column:
    """Events land once per day of their timestamp (folder landed_at=YYYYMMDD_000000)."""
    return F.date_format(F.date_trunc("DAY", F.col("ts")), "yyyyMMdd_HHmmss")


#: Ids of one landed array: it holds no more events than these.
EVENTS_AN_ARRAY = 8


def land_events(spark: SparkSession, sf_dir: str, poison: Column | None = None) -> str:
    """Write the events table as landed JSON-array files of several records; returns the key folder."""
    base = scratch_path(spark, "landing")
    landing.land_json_arrays(
        fixture(spark, sf_dir, "events"), base, "events", _event_landing_time(), poison,
        group=F.floor(F.col("event_id") / EVENTS_AN_ARRAY))
    return f"{base}/key=events"


def _events_out(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz") if c == "ts" else F.col(c) for c in EVENT_COLUMNS], *extra)


@register("bronze_file_date")
def bronze_file_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 on landed-file names built from the events; every tenth name lacks the
    time part and therefore has no date."""
    ev = fixture(spark, sf_dir, "events")
    stamp = F.when(F.col("event_id") % 10 == 0, F.date_format("ts", "yyyyMMdd")).otherwise(
        F.date_format("ts", "yyyyMMdd_HHmmss")
    )
    name = F.concat(F.col("event_type"), F.lit("_"), stamp, F.lit(".json"))
    return ev.select("event_id", name.alias("file_name")).withColumn("file_date", file_date(F.col("file_name")))


@register("bronze_ingest")
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as JSON arrays → incremental stream ingest → bronze parquet."""
    source = land_events(spark, sf_dir)
    bronze = scratch_path(spark, "bronze")
    stream = files.read_landed(spark, source, EVENTS_SCHEMA, "json", stream=True)
    files.write_bronze(stream, bronze, scratch_path(spark, "checkpoint"))
    return _events_out(files.good_rows(spark.read.parquet(bronze)), "file_date")


@register("bronze_decimal")
def bronze_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bare ``decimal`` in a declared schema reads as decimal(38,2)."""
    base = scratch_path(spark, "landing")
    landing.land_json_arrays(
        fixture(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice"),
        base, "part", F.lit("20250115_000000"),
    )
    df = files.read_landed(spark, f"{base}/key=part", PART_SCHEMA, "json", stream=False)
    return files.good_rows(df).select("p_partkey", "p_name", "p_retailprice")


def _poisoned_events(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    source = land_events(spark, sf_dir, poison=F.col("event_id") % 10 == 0)
    return files.read_landed(spark, source, EVENTS_SCHEMA, "json", stream=False, mode=mode)


@register("bronze_quarantine")
def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salvage: every event survives; the ``null`` element of an array with every tenth event is one quarantined
    row."""
    return _events_out(_poisoned_events(spark, sf_dir, "salvage"), files.REASON)


@register("bronze_quarantine_native")
def bronze_quarantine_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Native reader: an array holding a ``null`` is one all-NULL corrupt row, its events with it."""
    return _events_out(_poisoned_events(spark, sf_dir, "native"), files.REASON)


def _landed_text(spark: SparkSession, lines: DataFrame) -> str:
    """One column ``value`` of lines written as landed text; returns the folder."""
    path = scratch_path(spark, "landing")
    lines.write.text(path)
    return path


@register("bronze_quarantine_missing")
def bronze_quarantine_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh event lands without its declared-not-null id."""
    ev = fixture(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 7 != 0, F.col("event_id")).alias("event_id"), "user_id", "event_type", "value")
    source = _landed_text(spark, ev.select(F.to_json(F.struct("*")).alias("value")))
    read = files.read_landed(spark, source, EVENTS_SCHEMA, "json", stream=False)
    return read.select("event_id", "user_id", "event_type", "value", files.REASON)


@register("bronze_wrong_type")
def bronze_wrong_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third event lands with text for its number; only that field is lost."""
    ev = fixture(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.lit("none")).otherwise(F.col("user_id").cast("string")).alias("user"),
        "event_type")
    text = F.concat(
        F.lit('{"event_id": '), F.col("event_id"), F.lit(', "user_id": '),
        F.when(F.col("event_id") % 3 == 0, F.lit('"none"')).otherwise(F.col("user")),
        F.lit(', "event_type": "'), F.col("event_type"), F.lit('"}'))
    source = _landed_text(spark, ev.select(text.alias("value")))
    read = files.read_landed(spark, source, EVENTS_SCHEMA, "json", stream=False)
    return read.select("event_id", "user_id", "event_type", files.REASON)


@register("bronze_csv")
def bronze_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: events as CSV files with a header, through the ingest stream; every fifth row has too few fields and is
    quarantined."""
    ev = fixture(spark, sf_dir, "events")
    fields = [F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.col("user_id")]
    row = F.when(F.col("event_id") % 5 == 0, F.concat_ws(",", *fields)).otherwise(
        F.concat_ws(",", *fields, "event_type", "value", F.lit('"a, quoted"')))
    path = scratch_path(spark, "landing")
    # Each file begins with the header: the first line of the writer's partition.
    ev.select(row.alias("event_id,ts,user_id,event_type,value,props")).write.option("header", True).option(
        "quote", "\u0000").option("sep", "\t").csv(path)
    bronze = scratch_path(spark, "bronze")
    files.ingest(spark, path, bronze, scratch_path(spark, "checkpoint"), EVENTS_SCHEMA, "csv", options={"header": "true"})
    read = spark.read.parquet(bronze)
    return read.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props", files.REASON)


@register("bronze_csv_lengths")
def bronze_csv_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: records of a wrong length, counted as the reader counts: too few fields, too few with a quoted separator among
    them, too many, and right ones with a quoted separator."""
    ev = fixture(spark, sf_dir, "events")
    first = [F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.col("user_id")]
    kind = F.col("event_id") % 10
    right = F.concat_ws(",", *first, "event_type", "value", F.lit('"a, quoted"'))
    row = F.when(kind == 0, F.concat_ws(",", *first)).when(kind == 1, F.concat_ws(",", *first, F.lit('"x, y, z, and, more"'))).when(
        kind == 2, F.concat_ws(",", right, F.lit("extra"))).otherwise(right)
    path, bronze = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    ev.select(row.alias("value")).write.text(path)
    files.ingest(spark, path, bronze, scratch_path(spark, "checkpoint"), EVENTS_SCHEMA, "csv")
    return read_table(spark, bronze).select("event_id", "user_id", "event_type", files.REASON)


@register("bronze_lineage")
def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lineage says of every ingested event: its file's folder, that the file has a name and a size, and
    that the row was stamped before now."""
    source = land_events(spark, sf_dir)
    bronze = scratch_path(spark, "bronze")
    files.ingest(spark, source, bronze, scratch_path(spark, "checkpoint"), EVENTS_SCHEMA, "json")
    meta = F.col("source_metadata")
    return files.good_rows(spark.read.parquet(bronze)).select(
        "event_id", F.regexp_extract(meta["file_path"], r"key=(\w+)/landed_at=(\d{8})_", 1).alias("file_key"),
        F.regexp_extract(meta["file_path"], r"landed_at=(\d{8})_", 1).alias("file_day"),
        F.endswith(meta["file_path"], meta["file_name"]).alias("named"), (meta["file_size"] > 0).alias("sized"),
        (F.col("_ingestion_timestamp") <= F.current_timestamp()).alias("stamped"))


@register("table_scans")
def table_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table of the events read as a batch and as a stream, by name; both reads side by side."""
    root = scratch_path(spark, "tables")
    wh = control.Warehouse(spark, root)
    fixture(spark, sf_dir, "events").write.parquet(wh.path("scans.events"))
    wh.register("scans.events", replace=True)
    streamed = scratch_path(spark, "tables")
    files.write_bronze(stream_table(spark, "scans.events", max_files_per_trigger=1), streamed, scratch_path(spark, "checkpoint"))
    once = read_table(spark, "scans.events").select(F.lit("batch").alias("scan"), "event_id", "user_id", "event_type", "value")
    return once.unionByName(spark.read.parquet(streamed).select(
        F.lit("stream").alias("scan"), "event_id", "user_id", "event_type", "value"))


# ---------------------------------------------------------------- C7, S5, S7

STREAM_APPENDS = 5
STREAM_BUCKETS = 16
BRONZE_FILES_PER_TRIGGER = 2
SILVER_FILES_PER_TRIGGER = 32


@register("scd2_stream")
def scd2_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event feed arrives in five appends split by a hash of the event id (so
    every append holds late and out-of-order rows); after the third and the fifth
    append bronze ingest and the silver stream run, several micro-batches each."""
    events = fixture(spark, sf_dir, "events")
    base = scratch_path(spark, "landing")
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    ck_bronze, ck_silver = scratch_path(spark, "checkpoint"), scratch_path(spark, "checkpoint")
    part = F.pmod(F.xxhash64("event_id"), F.lit(STREAM_APPENDS))
    for rounds in ((0, 1, 2), (3, 4)):
        for p in rounds:
            landing.land_json_arrays(events.filter(part == p), base, "events", F.lit(f"2025010{p + 1}_000000"))
        files.ingest(
            spark, f"{base}/key=events", bronze, ck_bronze, EVENTS_SCHEMA, "json",
            keys=["user_id"], buckets=STREAM_BUCKETS, max_files_per_trigger=BRONZE_FILES_PER_TRIGGER,
        )
        cdc_stream.apply_changes(
            spark, bronze, silver, ck_silver, ["user_id"], "ts", buckets=STREAM_BUCKETS,
            track=["event_type"], columns=["user_id", "ts", "event_type"],
            max_files_per_trigger=SILVER_FILES_PER_TRIGGER,
        )
    out = cdc_stream.read_silver(spark, silver)
    return out.select(
        "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type",
        F.col(cdc.START_AT).cast("timestamp_ntz").alias(cdc.START_AT),
        F.col(cdc.END_AT).cast("timestamp_ntz").alias(cdc.END_AT),
    )


@register("silver_change_feed")
def silver_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 on a CDC target: the events arrive in three appends split by a hash of the event id; after each the control rows run,
    and a stream of the target's feed adds what is new to a copy. The copy's changes, replayed, are the history."""
    events = fixture(spark, sf_dir, "events")
    base, root = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    copy, ck_copy = scratch_path(spark, "copy"), scratch_path(spark, "checkpoint")
    ctl = _control(spark, "feed", [
        ("bronze_events", "bronze", {
            "source_path": f"{base}/key=events", "file_format": "json", "target_table": "bronze.feed_events", "schema": EVENTS_SCHEMA}),
        ("events_cdc", "silver", {"source_table": "bronze.feed_events", "target_table": "silver.feed_events_cdc", "cdc_parameters": {
            "cdc_type": "auto_cdc", "keys": ["user_id"], "sequence_by": "ts", "scd_type": "2",
            "track_history_column_list": ["event_type"], "change_feed": True}}),
    ])
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for p in range(3):
        landing.land_json_arrays(events.filter(part == p), base, "events", F.lit(f"2025010{p + 1}_000000"))
        control.run_operations(spark, ctl, "feed", root, buckets=STREAM_BUCKETS, replace_tables=True)
        feed = stream_table(spark, control.Warehouse(spark, root).feed("silver.feed_events_cdc"))
        files.write_bronze(feed.select("user_id", "ts", "event_type", cdc.START_AT, cdc.END_AT, "_change", "batch"), copy, ck_copy)
    out = change_feed.replay(spark.read.parquet(copy), ["user_id"])
    return out.select(
        "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type",
        F.col(cdc.START_AT).cast("timestamp_ntz").alias(cdc.START_AT),
        F.col(cdc.END_AT).cast("timestamp_ntz").alias(cdc.END_AT),
    )


# ---------------------------------------------------------------- L1-L7

@register("payload_extract")
def payload_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses wrap each event's ``props`` in a list under ``stations``, except
    error events, whose list sits under another key and so yields no row."""
    ev = fixture(spark, sf_dir, "events")
    list_key = F.when(F.col("event_type") == "error", F.lit("summarized")).otherwise(F.lit("stations"))
    body = F.concat(F.lit('{"'), list_key, F.lit('": ['), F.col("props"), F.lit("]}"))
    responses = ev.select("event_id", body.alias("body"))
    return landing.extract_payload(responses, "body", "stations", StructType([StructField("k", LongType())]), ["event_id"])


# Fixed values of the request recipe.
REQUEST_TEMPLATE = "/readings/summarized/station/{idWeatherstation}/year/{year}"
REQUEST_BASE_URL = "https://api.example.test/meteo"
REQUEST_RUN_DATE = dt.date(2025, 1, 15)


@register("request_plan")
def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per supplier for the month before the run date."""
    return landing.fan_out_requests(
        fixture(spark, sf_dir, "supplier"), "s_suppkey", REQUEST_TEMPLATE, REQUEST_BASE_URL, F.lit(REQUEST_RUN_DATE)
    )


@register("resource_keys")
def resource_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 on every shape of endpoint, one for each supplier."""
    sup = fixture(spark, sf_dir, "supplier")
    n = F.col("s_suppkey").cast("string")
    shapes = F.array(
        F.concat(F.lit("/measures"), n), F.concat(F.lit("/stations"), n, F.lit("/{idWeatherstation}/sensors")),
        F.concat(F.lit("/readings"), n, F.lit("/station/{idWeatherstation}/year/{year}")), F.concat(F.lit("plain"), n))
    endpoint = F.element_at(shapes, (F.pmod("s_suppkey", F.lit(4)) + 1).cast("int"))
    return sup.select("s_suppkey", endpoint.alias("endpoint")).withColumn("resource_key", landing.resource_key(F.col("endpoint")))


@register("dependent_requests")
def dependent_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 by the dependency of a control row: each nation's response lists two of its children under the key that the
    row names; one request per child, its id in place of the row's placeholder."""
    dependency = {"endpoint": "/nations", "key": "areas"}
    body = F.concat(
        F.lit('{"areas": [{"area": '), F.col("n_nationkey") * 10, F.lit('}, {"area": '), F.col("n_nationkey") * 10 + 1,
        F.lit('}], "other": [{"area": -1}]}'))
    responses = fixture(spark, sf_dir, "nation").select(body.alias("body"))
    return landing.dependent_requests(
        responses, "body", dependency["key"], "area", LongType(), "/areas/{idArea}/sensors", base_url=REQUEST_BASE_URL,
        placeholder="{idArea}")


@register("child_concat")
def child_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn is one response: a list of two stations. The first holds two sensors (the turn, and
    the turn negated) and is empty for every fourth turn; the second's sensors are not kept."""
    conv = fixture(spark, sf_dir, "conversations")
    child = F.struct(F.col("turn"), F.col("role"))
    other = F.struct((-F.col("turn")).alias("turn"), F.col("role"))
    both = F.array(child, other)
    stations = F.array(
        F.struct(F.when(F.col("turn") % 4 == 3, F.slice(both, 1, 0)).otherwise(both).alias("sensors")),
        F.struct(F.array(other).alias("sensors")),
    )
    return landing.first_element_children(conv.select("conv_id", stations.alias("response")), "response", "sensors", ["conv_id"])


# ---------------------------------------------------------------- R1-R5, S4, S11

def supplier_control_rows(supplier: DataFrame) -> DataFrame:
    """A control table derived from the suppliers: one operation per supplier,
    three pipelines by nation, type by key, active when the balance is positive."""
    kinds = F.array(*[F.lit(k) for k in ("api", "bronze", "silver", "gold")])
    params = F.to_json(F.struct(
        F.concat(F.lit("bronze.t"), F.col("s_suppkey").cast("string")).alias("target_table"),
        F.concat(F.lit("/landing/s"), F.col("s_suppkey").cast("string")).alias("source_path"),
        F.lit("json").alias("file_format"),
        F.struct(F.array(F.lit("id")).alias("keys"), F.lit("2").alias("scd_type")).alias("cdc_parameters"),
    ))
    return supplier.select(
        F.concat(F.lit("suppliers_"), F.pmod("s_nationkey", F.lit(3)).cast("string")).alias("operation_name"),
        F.concat(F.lit("api_"), F.col("s_name")).alias("ingestion_name"),
        F.element_at(kinds, (F.pmod("s_suppkey", F.lit(4)) + 1).cast("int")).alias("operation_type"),
        params.alias("parameters"),
        (F.col("s_acctbal") > 0).alias("is_active"),
        F.current_timestamp().alias("creation_date"),
    )


@register("control_delete")
def control_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created, inserted into, rows deleted by name, listed. Every third supplier's row is deleted; rows
    without a name stay."""
    path = scratch_path(spark, "control")
    rows = supplier_control_rows(fixture(spark, sf_dir, "supplier"))
    key = F.regexp_extract("ingestion_name", r"(\d+)$", 1).cast("int")
    control.write_control(rows.filter(key % 2 == 0), path, mode="overwrite")
    control.write_control(
        rows.filter(key % 2 == 1).withColumn("ingestion_name", F.when(key % 5 != 0, F.col("ingestion_name"))), path)
    control.delete_operations(spark, path, rows.filter(key % 3 == 0).select("ingestion_name"))
    return control.list_operations(spark, path).select("operation_name", "ingestion_name", "operation_type", "is_active")


@register("control_active")
def control_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control table written (S11), read back (S4), filtered to one pipeline's
    active rows (P7) and its JSON parameters parsed (P9)."""
    path = scratch_path(spark, "control")
    control.write_control(supplier_control_rows(fixture(spark, sf_dir, "supplier")), path, mode="overwrite")
    ops = control.active_operations(spark.read.parquet(path), "suppliers_1")
    return ops.select(
        "operation_name", "ingestion_name", "operation_type",
        F.col("params.target_table").alias("target_table"),
        F.col("params.source_path").alias("source_path"),
        F.col("params.file_format").alias("file_format"),
        F.col("params.cdc_parameters.scd_type").alias("scd_type"),
    )


CONTROL_GOLD_SQL = """
CREATE OR REFRESH MATERIALIZED VIEW gold.events_current as (
SELECT user_id, ts, event_type, `__START_AT`, `__END_AT`
FROM silver.events_cdc
WHERE `__END_AT` IS NULL
);
"""


# One row of each supplier, by its key: what is wrong with it is in the order of ``control_rejected``'s oracle.
CONTROL_ROWS = (
    ("silver", '{"source_table": "b.t#", "target_table": "s.t#", "cdc_parameters": {"cdc_type": "auto_cdc", "keys": ["k"], "sequence_by": "at"}}'),
    ("bronze", '{"target_table": "b.t#", "source_path": "/land/#", "schema": {"type": "struct", "fields": []}}'),
    ("gold", '{"sql_file_path": "/sql/#.sql"}'),
    ("bronze", '{"target_table": "b.t#", "schema": {"type": "struct", "fields": []}}'),
    ("bronze", '{"target_table": "b.t#", "source_path": "/land/#", "schema": null}'),
    ("silver", '{"source_table": "b.t#", "target_table": "s.t#"}'),
    ("silver", '{"source_table": "b.t#", "target_table": "s.t#", "cdc_parameters": {"cdc_type": "merge", "keys": ["k"], "sequence_by": "at"}}'),
    ("silver", '{"source_table": "b.t#", "target_table": "s.t#", "cdc_parameters": {"cdc_type": "auto_cdc", "keys": [], "sequence_by": "at"}}'),
    ("silver", '{"source_table": "b.t#", "target_table": "s.t#", "cdc_parameters": {"cdc_type": "auto_cdc", "keys": ["k"], "sequence_by": "at", "scd_type": "3"}}'),
    ("silver", '{"source_table": "b.t#", "target_table": "s.t#", "cdc_parameters": {"cdc_type": "auto_cdc", "keys": ["k"]}}'),
    ("silver", '{"source_table": "b.t#", "target_table": "s.t#", "cdc_parameters": {"cdc_type": "auto_cdc_from_snapshot", "keys": ["k"]}}'),
    ("gold", '{"sql_file_path": ""}'),
    ("gold", '["/sql/#.sql"]'),
    ("silver", '{"source_table": "b.t#", "target_table": "s.t#", "cdc_parameters": {"cdc_type": "auto_cdc", "keys": ["k"], "sequence_by": []}}'),
    ("silver", None),
    ("api", "{}"),
)


@register("control_rejected")
def control_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One control row for each supplier, of sixteen forms; those that a run would refuse, with the reason."""
    form = F.pmod(F.col("s_suppkey"), F.lit(len(CONTROL_ROWS))).cast("int") + 1
    pick = lambda values: F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), form)
    name = F.col("s_suppkey").cast("string")
    rows = fixture(spark, sf_dir, "supplier").select(
        F.lit("suppliers").alias("operation_name"), F.concat(F.lit("row_"), name).alias("ingestion_name"),
        pick([t for t, _ in CONTROL_ROWS]).alias("operation_type"),
        F.replace(pick([j for _, j in CONTROL_ROWS]), F.lit("#"), name).alias("parameters"), F.lit(True).alias("is_active"))
    return control.rejected_operations(rows).select("ingestion_name", "operation_type", "reason")


@register("control_run")
def control_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows drive the whole flow on the events: landed JSON → bronze
    (bucketed by the silver keys) → SCD2 silver tracking ``event_type`` → gold
    view of the current versions. An inactive row and an ``api`` row are skipped."""
    source = land_events(spark, sf_dir)
    sql_path = scratch_path(spark, "sql")
    spark.createDataFrame([(CONTROL_GOLD_SQL,)], "value string").coalesce(1).write.text(sql_path)
    rows = [
        ("events_flow", "api_events", "api", json.dumps({"endpoint": "/events", "base_url": "https://api.example.test"}), True),
        ("events_flow", "bronze_events", "bronze", json.dumps(
            {"source_path": source, "file_format": "json", "target_table": "bronze.events", "schema": EVENTS_SCHEMA}), True),
        ("events_flow", "events_cdc", "silver", json.dumps({
            "source_table": "bronze.events", "target_table": "silver.events_cdc",
            "cdc_parameters": {"cdc_type": "auto_cdc", "keys": ["user_id"], "sequence_by": "ts",
                               "scd_type": "2", "track_history_column_list": ["event_type"]}}), True),
        ("events_flow", "events_cdc_old", "silver", json.dumps({"source_table": "bronze.events"}), False),
        ("events_flow", "gold_layer", "gold", json.dumps({"sql_file_path": sql_path}), True),
    ]
    ctl = spark.createDataFrame(rows, "operation_name string, ingestion_name string, operation_type string, "
                                      "parameters string, is_active boolean").withColumn(
        "creation_date", F.current_timestamp())
    control.run_operations(spark, ctl, "events_flow", scratch_path(spark, "warehouse"), buckets=STREAM_BUCKETS, replace_tables=True)
    out = spark.read.table("gold.events_current")
    return out.select(
        "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type",
        F.col(cdc.START_AT).cast("timestamp_ntz").alias(cdc.START_AT),
        F.col(cdc.END_AT).cast("timestamp_ntz").alias(cdc.END_AT),
    )


# Silver rows as a deployed control table has them: no ``scd_type``, order keys and except-list on lineage columns.
ORDERS_SCHEMA = {
    "type": "struct",
    "fields": [
        {"name": "o_orderkey", "type": "bigint", "nullable": False},
        {"name": "o_custkey", "type": "bigint"},
        {"name": "o_orderstatus", "type": "string"},
        {"name": "o_totalprice", "type": "double"},
    ],
}
SNAPSHOT_PARTS = 3


def _control(spark: SparkSession, name: str, rows: list[tuple[str, str, dict]]) -> DataFrame:
    return spark.createDataFrame(
        [(name, ingestion, kind, json.dumps(params), True) for ingestion, kind, params in rows],
        "operation_name string, ingestion_name string, operation_type string, parameters string, is_active boolean",
    ).withColumn("creation_date", F.current_timestamp())


def _snapshot_runs(spark: SparkSession, sf_dir: str, pipeline: str, order_keys: list[str], scd: dict) -> DataFrame:
    """Orders land in three parts by order key; after each the pipeline runs, with the part's number as the snapshot's
    version, and once more with the same version, which changes nothing."""
    orders = fixture(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    base, root = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    ctl = _control(spark, pipeline, [
        ("bronze_orders", "bronze", {
            "source_path": f"{base}/key=orders", "file_format": "json", "target_table": f"cat.bronze.{pipeline}", "schema": ORDERS_SCHEMA}),
        ("orders_cdc", "silver", {
            "source_table": f"cat.bronze.{pipeline}", "target_table": f"cat.silver.{pipeline}", "cdc_parameters": {
                "cdc_type": "auto_cdc_from_snapshot", "keys": ["o_custkey"], "order_keys": order_keys, **scd,
                "track_history_except_column_list": ["source_metadata", "file_date", "o_orderkey", "o_totalprice"]}}),
    ])
    for part in range(SNAPSHOT_PARTS):
        landing.land_json_arrays(
            orders.filter(F.col("o_orderkey") % SNAPSHOT_PARTS == part), base, "orders", F.lit(f"2025010{part + 1}_000000"))
        for _ in range(2):
            control.run_operations(spark, ctl, pipeline, root, snapshot_version=part + 1, replace_tables=True)
    return spark.read.table(f"silver.{pipeline}")


@register("control_run_snapshot")
def control_run_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oldest row of every customer, as deployed rows ask for it: a customer opens with the part that first names
    it and never changes."""
    out = _snapshot_runs(
        spark, sf_dir, "orders_first", ["_ingestion_timestamp", "file_date"], {"stored_as_scd_type": "2"})
    return out.select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.date_format("file_date", "yyyyMMdd").alias("landed"), cdc.START_AT, cdc.END_AT)


@register("control_run_versions")
def control_run_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of every customer in three versions: statuses open and close versions."""
    out = _snapshot_runs(
        spark, sf_dir, "orders_last", ["file_date desc", "o_orderkey desc"], {"scd_type": 2})
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", cdc.START_AT, cdc.END_AT)


@register("control_run_scd1")
def control_run_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD type 1 from snapshots, and the session's view of the last one (S8), which hold the same rows."""
    table = _snapshot_runs(spark, sf_dir, "orders_now", ["file_date desc", "o_orderkey desc"], {"scd_type": "1"})
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    view = spark.read.table("orders_now_snapshot").select(F.lit("view").alias("kept_in"), *columns)
    return table.select(F.lit("table").alias("kept_in"), *columns).unionByName(view)


@register("scd2_two_targets")
def scd2_two_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two targets of different keys on one bronze table, in two ingests: by user, tracking the event type, and by event
    type with a composite sequence, tracking the user. Sequences come as a name and as a list in the JSON text."""
    events = fixture(spark, sf_dir, "events")
    base, root = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    silver = lambda target, keys, sequence, track: (f"{target}_cdc", "silver", {
        "source_table": "bronze.two_targets", "target_table": f"silver.{target}", "cdc_parameters": {
            "cdc_type": "auto_cdc", "keys": keys, "sequence_by": sequence, "track_history_column_list": track}})
    ctl = _control(spark, "two_targets", [
        ("bronze_events", "bronze", {
            "source_path": f"{base}/key=events", "file_format": "json", "target_table": "bronze.two_targets", "schema": EVENTS_SCHEMA}),
        silver("by_user", ["user_id"], "ts", ["event_type"]),
        silver("by_type", ["event_type"], ["ts", "event_id"], ["user_id"]),
    ])
    part = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for p in (0, 1):
        landing.land_json_arrays(events.filter(part == p), base, "events", F.lit(f"2025010{p + 1}_000000"))
        control.run_operations(spark, ctl, "two_targets", root, buckets=STREAM_BUCKETS, replace_tables=True)
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return spark.read.table("silver.by_user").select(F.lit("by_user").alias("target"), "user_id", "event_type", ntz(cdc.START_AT), ntz(cdc.END_AT)).unionByName(
        spark.read.table("silver.by_type").select(F.lit("by_type").alias("target"), "user_id", "event_type", ntz(cdc.START_AT), ntz(cdc.END_AT)))


@register("null_sequence")
def null_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without a time cannot be placed: they are in the target's quarantine table, with the reason."""
    events = fixture(spark, sf_dir, "events").withColumn("ts", F.when(F.col("event_id") % 9 != 0, F.col("ts")))
    base, root = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    landing.land_json_arrays(events, base, "events", F.lit("20250101_000000"))
    ctl = _control(spark, "late_events", [
        ("bronze_events", "bronze", {
            "source_path": f"{base}/key=events", "file_format": "json", "target_table": "bronze.late_events", "schema": EVENTS_SCHEMA}),
        ("events_cdc", "silver", {
            "source_table": "bronze.late_events", "target_table": "silver.late_events", "cdc_parameters": {
                "cdc_type": "auto_cdc", "keys": ["user_id"], "sequence_by": "ts", "track_history_column_list": ["event_type"]}}),
    ])
    control.run_operations(spark, ctl, "late_events", root, buckets=STREAM_BUCKETS, replace_tables=True)
    bad = spark.read.parquet(control.Warehouse(spark, root).quarantine("silver.late_events"))
    return bad.select("event_id", "user_id", "event_type", files.REASON)


# ---------------------------------------------------------------- Q4-Q6 over landed, bronze and silver

GOLD_ENTITIES_SQL = """
-- current rows of three entities, each a projection of its silver table
CREATE OR REFRESH MATERIALIZED VIEW trade.gold.stations AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM trade.silver.stations_cdc WHERE `__END_AT` IS NULL
);
CREATE OR REFRESH MATERIALIZED VIEW trade.gold.measures AS (
  SELECT p_partkey, p_name, p_brand FROM trade.silver.measures_cdc WHERE `__END_AT` IS NULL
);
CREATE OR REFRESH MATERIALIZED VIEW trade.gold.sensors AS (
  SELECT s_suppkey, s_name, s_nationkey FROM trade.silver.sensors_cdc WHERE `__END_AT` IS NULL
);
"""
# Table, key and columns (with their declared types) behind each view.
GOLD_ENTITIES = {
    "stations": ("customer", "c_custkey", {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_mktsegment": "string"}),
    "measures": ("part", "p_partkey", {"p_partkey": "bigint", "p_name": "string", "p_brand": "string"}),
    "sensors": ("supplier", "s_suppkey", {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int"}),
}


def _gold_entity(spark: SparkSession, sf_dir: str, wanted: str) -> DataFrame:
    """The whole flow of one entity: landed arrays, bronze, snapshot-fed silver, and its statement of the gold file."""
    base, root, sql = scratch_path(spark, "landing"), scratch_path(spark, "warehouse"), scratch_path(spark, "sql")
    table, key, columns = GOLD_ENTITIES[wanted]
    schema = {"type": "struct", "fields": [{"name": c, "type": t, "nullable": c != key} for c, t in columns.items()]}
    landing.land_json_arrays(
        fixture(spark, sf_dir, table).select(*columns), base, wanted, F.lit("20250101_000000"), group=F.floor(F.col(key) / 8))
    body = next(b for n, b in gold.view_statements(GOLD_ENTITIES_SQL) if gold.short_name(n) == wanted)
    text = f"CREATE OR REFRESH MATERIALIZED VIEW trade.gold.{wanted} AS (\n{body}\n);"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(sql)
    ctl = _control(spark, "trade", [
        (f"bronze_{wanted}", "bronze", {
            "source_path": f"{base}/key={wanted}", "file_format": "json", "target_table": f"trade.bronze.{wanted}", "schema": schema}),
        (f"{wanted}_cdc", "silver", {
            "source_table": f"trade.bronze.{wanted}", "target_table": f"trade.silver.{wanted}_cdc", "cdc_parameters": {
                "cdc_type": "auto_cdc_from_snapshot", "keys": [key], "stored_as_scd_type": "2",
                "order_keys": ["_ingestion_timestamp", "file_date"],
                "track_history_except_column_list": ["source_metadata", "file_date"]}}),
        ("gold_layer", "gold", {"sql_file_path": sql}),
    ])
    control.run_operations(spark, ctl, "trade", root, snapshot_version=1, replace_tables=True)
    return spark.read.table(f"gold.{wanted}")


@register("gold_stations")
def gold_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_entity(spark, sf_dir, "stations")


@register("gold_measures")
def gold_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_entity(spark, sf_dir, "measures")


@register("gold_sensors")
def gold_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_entity(spark, sf_dir, "sensors")


# ---------------------------------------------------------------- declared schemas that change, nested readings

#: The events' schema before it was widened: an integer id, no values.
EARLIER_EVENTS_SCHEMA = {
    "type": "struct",
    "fields": [{**f, "type": "int"} if f["name"] == "event_id" else f for f in EVENTS_SCHEMA["fields"] if f["name"] not in ("value", "props")],
}


@register("schema_change")
def schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events are ingested under a schema without values and with an integer id; then the control row's schema gains the
    values and widens the id, and the odd events follow. Both SCD types take it over; earlier rows hold NULL."""
    events = fixture(spark, sf_dir, "events")
    base, root = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    silver = lambda target, scd: (target, "silver", {
        "source_table": "bronze.changing", "target_table": f"silver.{target}", "cdc_parameters": {
            "cdc_type": "auto_cdc", "keys": ["user_id"], "sequence_by": "ts", "scd_type": scd, "track_history_column_list": ["event_type", "value"]}})
    for part, schema in enumerate((EARLIER_EVENTS_SCHEMA, EVENTS_SCHEMA)):
        landing.land_json_arrays(events.filter(F.col("event_id") % 2 == part), base, "events", F.lit(f"2025010{part + 1}_000000"))
        rows = [
            ("bronze_changing", "bronze", {
                "source_path": f"{base}/key=events", "file_format": "json", "target_table": "bronze.changing", "schema": schema}),
            silver("changing_history", 2), silver("changing_now", 1)]
        if not part:  # the column to track is not there yet
            for _, kind, p in rows[1:]:
                p["cdc_parameters"]["track_history_column_list"] = ["event_type"]
        control.run_operations(spark, _control(spark, "changing", rows), "changing", root, buckets=STREAM_BUCKETS, replace_tables=True)
    ntz = lambda c: c.cast("timestamp_ntz")
    history, now = spark.read.table("silver.changing_history"), spark.read.table("silver.changing_now")
    columns = ["user_id", "event_id", "event_type", "value"]
    return history.select(F.lit("history").alias("target"), *columns, ntz(F.col(cdc.START_AT)).alias("since"), ntz(F.col(cdc.END_AT)).alias("until")).unionByName(
        now.select(F.lit("now").alias("target"), *columns, ntz(F.col("ts")).alias("since"), F.lit(None).cast("timestamp_ntz").alias("until")))


MEASURED = {"type": "struct", "fields": [{"name": n, "type": "double"} for n in ("mean", "min", "max", "total")]}
READINGS_SCHEMA = {
    "type": "struct",
    "fields": [
        {"name": "id_weatherstation", "type": "bigint", "nullable": False},
        {"name": "sensors", "type": {"type": "array", "elementType": {"type": "struct", "fields": [
            {"name": "id_weatherstationsensor", "type": "bigint"},
            {"name": "dates", "type": {"type": "array", "elementType": {"type": "struct", "fields": [
                {"name": "observation_date", "type": "date"}, {"name": "is_validated", "type": "boolean"},
                {"name": "values", "type": {"type": "array", "elementType": MEASURED}}]}}}]}}},
    ],
}
GOLD_READINGS_SQL = """
CREATE OR REFRESH MATERIALIZED VIEW weather.gold.readings_flat AS (
  WITH by_sensor AS (
    SELECT id_weatherstation, explode(sensors) AS sensor FROM weather.silver.readings_cdc WHERE `__END_AT` IS NULL
  ), by_date AS (
    SELECT id_weatherstation, sensor.id_weatherstationsensor, explode(sensor.dates) AS day FROM by_sensor
  ), by_value AS (
    SELECT id_weatherstation, id_weatherstationsensor, day.observation_date, explode(day.`values`) AS v
    FROM by_date WHERE day.is_validated = 'true'
  )
  SELECT id_weatherstation, id_weatherstationsensor, observation_date, v.mean, v.min, v.max, v.total FROM by_value
);
"""


def station_readings(orders: DataFrame, shift: Column) -> DataFrame:
    """An order as a station: its customer is the sensor, with two dates (the order's, validated for status F, of two
    measurements; the day after, validated for even keys, of one) and a sensor without dates."""
    measured = lambda k: F.struct(
        (F.col("o_totalprice") * k + shift).alias("mean"), F.col("o_totalprice").alias("min"), (F.col("o_totalprice") * 2).alias("max"),
        F.lit(float(k)).alias("total"))
    date = lambda days, valid, values: F.struct(
        F.date_add(F.col("o_orderdate").cast("date"), days).alias("observation_date"), valid.alias("is_validated"), values.alias("values"))
    dates = F.array(
        date(0, F.col("o_orderstatus") == "F", F.array(measured(1), measured(2))), date(1, F.col("o_orderkey") % 2 == 0, F.array(measured(3))))
    sensor = lambda key, of: F.struct(key.alias("id_weatherstationsensor"), of.alias("dates"))
    return orders.select(
        F.col("o_orderkey").alias("id_weatherstation"), F.array(sensor(F.col("o_custkey"), dates), sensor(-F.col("o_custkey"), F.slice(dates, 1, 0))).alias("sensors"))


@register("gold_readings")
def gold_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings flow as deployed: nested arrays landed, bronze under the nested schema, snapshot-fed history that tracks
    the array, the gold view of its current rows. Every fifth station's readings are corrected in a second snapshot."""
    orders = fixture(spark, sf_dir, "orders")
    base, root, sql = scratch_path(spark, "landing"), scratch_path(spark, "warehouse"), scratch_path(spark, "sql")
    spark.createDataFrame([(GOLD_READINGS_SQL,)], "value string").coalesce(1).write.text(sql)
    ctl = _control(spark, "readings", [
        ("bronze_readings", "bronze", {
            "source_path": f"{base}/key=readings", "file_format": "json", "target_table": "weather.bronze.readings", "schema": READINGS_SCHEMA}),
        ("readings_cdc", "silver", {
            "source_table": "weather.bronze.readings", "target_table": "weather.silver.readings_cdc", "cdc_parameters": {
                "cdc_type": "auto_cdc_from_snapshot", "keys": ["id_weatherstation"], "order_keys": ["file_date desc"],
                "stored_as_scd_type": "2", "track_history_column_list": ["sensors"]}}),
        ("gold_layer", "gold", {"sql_file_path": sql}),
    ])
    for version, rows in enumerate((orders, orders.filter(F.col("o_orderkey") % 5 == 0)), 1):
        landing.land_json_arrays(
            station_readings(rows, F.lit(float(version - 1))), base, "readings", F.lit(f"2025010{version}_000000"), group=F.floor(F.col("id_weatherstation") / 8))
        control.run_operations(spark, ctl, "readings", root, snapshot_version=version, replace_tables=True)
    return spark.read.table("gold.readings_flat")
