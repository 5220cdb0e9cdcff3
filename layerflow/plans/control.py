"""A control table of operations drives bronze → silver → gold.

Control table columns: ``operation_name, ingestion_name, operation_type,
parameters (JSON text), is_active, creation_date``. Only the few rows of one
pipeline are collected on the driver; all data work runs as Spark jobs.

Tables are named ``layer.table`` and stored as parquet folders
``{warehouse}/{layer}/{table}``; each is exposed in the session catalog as an
external table of that two-part name (a snapshot history as a view over its
folders), so gold SQL can refer to it. Rows that cannot be applied are written
below ``{warehouse}/_quarantine/{table}``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, StringType, StructField, StructType, TimestampType

from ..first_rows import FirstRows
from ..history import SnapshotStore
from ..operators import dedup
from ..schemas import evolve, fitted, read_stored, stored_schema
from ..sources import files
from ..sources.tables import read_table
from ..storage import exists, list_folders, remove_folder, replace_folder
from ..streaming import cdc_stream
from . import gold

CONTROL_SCHEMA = StructType([
    StructField("operation_name", StringType()),
    StructField("ingestion_name", StringType()),
    StructField("operation_type", StringType()),
    StructField("parameters", StringType()),
    StructField("is_active", BooleanType()),
    StructField("creation_date", TimestampType()),
])

# The layers processed, in order, and the CDC flow names.
LAYER_ORDER = ("bronze", "silver", "gold")
CDC_TYPES = ("auto_cdc", "auto_cdc_from_snapshot")

# Parameters read from the JSON text (P9); unknown keys are ignored.
PARAMETERS_SCHEMA = (
    "target_table string, source_path string, file_format string, source_table string, "
    "sql_file_path string, base_url string, base_volume_path string, endpoint string, "
    "dependencies array<struct<endpoint string, key string>>, "
    "mode string, whole_file boolean, options map<string,string>, "
    "cdc_parameters struct<cdc_type string, keys array<string>, sequence_by string, scd_type string, "
    "stored_as_scd_type string, order_keys array<string>, track_history_column_list array<string>, "
    "track_history_except_column_list array<string>, segments int, change_feed boolean>"
)


# ---------------------------------------------------------------- S11

def write_control(df: DataFrame, path: str, mode: str = "append") -> None:
    """Create (overwrite) or insert into (append) the control table."""
    df.select(*[F.col(f.name).cast(f.dataType) for f in CONTROL_SCHEMA.fields]).write.mode(mode).parquet(path)


def delete_operations(spark: SparkSession, path: str, ingestion_names: Iterable[str] | DataFrame) -> None:
    """DELETE by ingestion name, of a few names or of a table's column ``ingestion_name``: plain parquet has no DELETE,
    so the rest is written beside it and takes its place. Rows without a name are no one's and stay."""
    rows = spark.read.parquet(path)
    if isinstance(ingestion_names, DataFrame):
        rest = rows.join(ingestion_names.select("ingestion_name"), "ingestion_name", "left_anti").select(rows.columns)
    else:
        rest = rows.filter(~F.coalesce(F.col("ingestion_name").isin(list(ingestion_names)), F.lit(False)))
    replace_folder(spark, rest, path)


def list_operations(spark: SparkSession, path: str) -> DataFrame:
    """The control table's rows by pipeline, layer and name."""
    return spark.read.parquet(path).orderBy("operation_name", "operation_type", "ingestion_name")


def drop_control(spark: SparkSession, path: str) -> None:
    """Remove the control table; a table that is not there is no error."""
    remove_folder(spark, path)


def active_operations(control: DataFrame, operation_name: str) -> DataFrame:
    """R1 + P7 + P9: active rows of one pipeline with parsed parameters."""
    return (
        control.filter((F.col("operation_name") == F.lit(operation_name)) & F.col("is_active"))
        .withColumn("params", F.from_json("parameters", PARAMETERS_SCHEMA))
    )


# ---------------------------------------------------------------- R3 validation

class ConfigError(ValueError):
    pass


def _need(value: Any, what: str) -> Any:
    if value is None or value == "" or value == []:
        raise ConfigError(f"the control row gives no {what.lower()}")
    return value


def scd_type_of(cdc: dict) -> int:
    """``scd_type``, else ``stored_as_scd_type``, as number or text; 2 if neither says anything."""
    raw = next((cdc[k] for k in ("scd_type", "stored_as_scd_type") if cdc.get(k) not in (None, "")), 2)
    if str(raw).strip() not in ("1", "2"):
        raise ConfigError(f"an SCD type is 1 or 2, not {raw!r}")
    return int(raw)


def sequence_columns(raw: Any) -> list[str]:
    """``sequence_by`` as a name, a list, or a list as JSON text."""
    if isinstance(raw, str) and raw.lstrip().startswith("["):
        raw = json.loads(raw)
    return [raw] if isinstance(raw, str) else list(raw)


def order_key(text: str) -> tuple[str, str]:
    """``name`` or ``name asc|desc``."""
    name, _, direction = text.strip().rpartition(" ")
    return (name.strip(), direction.lower()) if name and direction.lower() in ("asc", "desc") else (text.strip(), "asc")


def silver_plan(params: dict) -> dict:
    """Validated silver parameters."""
    cdc = _need(params.get("cdc_parameters"), "CDC_PARAMETERS")
    cdc_type = _need(cdc.get("cdc_type"), "CDC_TYPE")
    if cdc_type not in CDC_TYPES:
        raise ConfigError(f"a CDC type is one of {CDC_TYPES}, not {cdc_type!r}")
    plan = {
        "cdc_type": cdc_type,
        "source_table": _need(params.get("source_table"), "SOURCE_TABLE"),
        "target_table": _need(params.get("target_table"), "TARGET_TABLE"),
        "keys": list(_need(cdc.get("keys"), "KEYS")),
        "scd_type": scd_type_of(cdc),
        "track": list(cdc.get("track_history_column_list") or []),
        "track_except": list(cdc.get("track_history_except_column_list") or []),
        "segments": cdc.get("segments"),
        "change_feed": bool(cdc.get("change_feed")),
    }
    if cdc_type == "auto_cdc":
        plan["sequence_by"] = _need(sequence_columns(_need(cdc.get("sequence_by"), "SEQUENCE_BY")), "SEQUENCE_BY")
    else:
        plan["order_keys"] = [order_key(k) for k in _need(cdc.get("order_keys"), "ORDER_KEYS")]
    return plan


def rejected_operations(control: DataFrame) -> DataFrame:
    """R3 over a whole control table, without running it: the rows that a run would refuse, active or not, with the first
    ``reason`` in the order in which a run looks. Rows of other layers (``api``) are not run and not judged."""
    p, cdc = F.col("params"), F.col("params.cdc_parameters")
    layer, text = F.col("operation_type"), F.col("parameters")

    def gone(c: Column) -> Column:
        return c.isNull() | (c == "")

    def no_items(c: Column) -> Column:
        return c.isNull() | (F.size(c) == 0)

    sequence, listed = cdc["sequence_by"], F.from_json(cdc["sequence_by"], "array<string>")
    scd_type = F.coalesce(*[F.when(~gone(cdc[name]), F.trim(cdc[name])) for name in ("scd_type", "stored_as_scd_type")], F.lit("2"))
    schema = F.get_json_object(text, "$.schema")
    rules = [
        (F.col("operation_type").isin(*LAYER_ORDER), F.from_json(text, "map<string,string>").isNull(), "parameters are no JSON object"),
        (layer == "bronze", gone(p["target_table"]), "no target_table"),
        (layer == "bronze", gone(p["source_path"]), "no source_path"),
        (layer == "bronze", gone(schema) | (schema == "[]"), "no schema"),
        (layer == "silver", cdc.isNull(), "no cdc_parameters"),
        (layer == "silver", gone(cdc["cdc_type"]), "no cdc_type"),
        (layer == "silver", ~cdc["cdc_type"].isin(*CDC_TYPES), "unknown cdc_type"),
        (layer == "silver", gone(p["source_table"]), "no source_table"),
        (layer == "silver", gone(p["target_table"]), "no target_table"),
        (layer == "silver", no_items(cdc["keys"]), "no keys"),
        (layer == "silver", ~scd_type.isin("1", "2"), "unknown scd_type"),
        ((layer == "silver") & (cdc["cdc_type"] == CDC_TYPES[0]),
         gone(sequence) | (F.ltrim(sequence).startswith("[") & no_items(listed)), "no sequence_by"),
        ((layer == "silver") & (cdc["cdc_type"] == CDC_TYPES[1]), no_items(cdc["order_keys"]), "no order_keys"),
        (layer == "gold", gone(p["sql_file_path"]), "no sql_file_path"),
    ]
    reason = F.coalesce(*[F.when(where & wrong, F.lit(why)) for where, wrong, why in rules])
    judged = control.withColumn("params", F.from_json("parameters", PARAMETERS_SCHEMA)).withColumn("reason", reason)
    return judged.filter(F.col("reason").isNotNull()).drop("params")


# ---------------------------------------------------------------- runner

def _type_ddl(kind: DataType) -> str:
    """A type as SQL text; names of fields are quoted."""
    return StructType([StructField("c", kind)]).toDDL().removeprefix("c ")


class Warehouse:
    """Where ``layer.table`` lives, and its catalog registration."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        parts = name.split(".")[-2:]
        return "/".join([self.root, *parts])

    def checkpoint(self, name: str, what: str) -> str:
        return f"{self.root}/_checkpoints/{name.split('.')[-1]}/{what}"

    def quarantine(self, name: str) -> str:
        return f"{self.root}/_quarantine/{name.split('.')[-1]}"

    def feed(self, name: str) -> str:
        return f"{self.root}/_feeds/{name.split('.')[-1]}"

    def _name(self, name: str) -> tuple[str, str]:
        """The two-part name in the session catalog, quoted and plain; its database exists afterwards."""
        parts = name.split(".")[-2:]
        if len(parts) == 2:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{parts[0]}` LOCATION '{self.root}/{parts[0]}'")
        return ".".join(f"`{p}`" for p in parts), ".".join(parts)

    def _make_room(self, ident: str, plain: str, location: str | None, replace: bool) -> bool:
        """Drop what stands under a name if that loses no data. Only an external table or a view can go, and one of
        another place only with ``replace``. True if the table already is the one wanted."""
        if not self.spark.catalog.tableExists(plain):
            return False
        if self.spark.catalog.getTable(plain).tableType == "VIEW":
            self.spark.sql(f"DROP VIEW {ident}")
            return False
        about = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {ident}").collect()}
        here = str(about.get("Location", "")).removeprefix("file:").rstrip("/")
        same = location is not None and here == location.removeprefix("file://").removeprefix("file:").rstrip("/")
        if about.get("Type") != "EXTERNAL" or not (same or replace):
            raise ConfigError(f"{plain} is a table of someone else ({about.get('Type')}, {here})")
        if same:
            return True
        self.spark.sql(f"DROP TABLE {ident}")
        return False

    def register(self, name: str, location: str | None = None, replace: bool = False) -> None:
        """Expose a parquet folder as an external table. Managed tables and tables of another folder are refused
        (those of another folder are replaced if asked: their files stay). A folder with a schema log is declared with
        its newest schema, again when that has changed."""
        location = location or self.path(name)
        ident, plain = self._name(name)
        self._declare(ident, plain, location, stored_schema(self.spark, location), self._partitions(location), replace)

    def _partitions(self, location: str) -> list[str]:
        """Names of the partition columns, from the first folders."""
        found: list[str] = []
        while inner := list_folders(self.spark, location):
            found.append(inner[0].partition("=")[0])
            location = f"{location}/{inner[0]}"
        return found

    def _declare(
        self, ident: str, plain: str, location: str, schema: StructType | None, partitions: list[str], replace: bool,
    ) -> None:
        there = self._make_room(ident, plain, location, replace)
        if there and schema is not None:
            there = {f.name: f.dataType for f in self.spark.read.table(plain).schema} == {f.name: f.dataType for f in schema}
            if not there:
                self.spark.sql(f"DROP TABLE {ident}")
        if not there:
            columns = "" if schema is None else f"({', '.join(f'`{f.name}` {_type_ddl(f.dataType)}' for f in schema)})"
            parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partitions)})" if partitions and columns else ""
            self.spark.sql(f"CREATE TABLE {ident} {columns} USING parquet {parts} LOCATION '{location}'")
        if any(c.isPartition for c in self.spark.catalog.listColumns(plain)):
            self.spark.catalog.recoverPartitions(plain)
        self.spark.catalog.refreshTable(plain)

    def register_history(self, name: str, store: SnapshotStore, replace: bool = False) -> None:
        """Expose a snapshot history as a view: the open rows of its newest run and the closed rows of all complete ones, over
        two tables partitioned by run (``<name>__open``, ``<name>__closed``), however many runs there were."""
        ident, plain = self._name(name)
        self._make_room(ident, plain, None, replace)
        schema = stored_schema(self.spark, store.root)
        columns, bodies = ", ".join(f"`{c}`" for c in schema.names), []
        which = {"open": f"run = '{store.last()[1]}'", "closed": f"run IN (SELECT run FROM parquet.`{store.root}/log`)"}
        for kind, live in which.items():
            if exists(self.spark, f"{store.root}/{kind}"):
                part, part_plain = self._name(f"{name}__{kind}")
                by_run = StructType([*schema.fields, StructField("run", StringType())])
                self._declare(part, part_plain, f"{store.root}/{kind}", by_run, ["run"], replace)
                bodies.append(f"SELECT {columns} FROM {part} WHERE {live}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {ident} AS {' UNION ALL '.join(bodies)}")


def run_operations(
    spark: SparkSession,
    control: DataFrame,
    operation_name: str,
    warehouse_root: str,
    buckets: int = 64,
    snapshot_version: Any = None,
    replace_tables: bool = False,
    max_files_per_trigger: int | None = None,
) -> dict[str, list[str]]:
    """R2: run one pipeline's active bronze, then silver, then gold rows.

    Returns the tables written per layer. ``api`` rows are not run here. ``replace_tables`` lets a run take over names
    of external tables that belong to another warehouse folder.
    """
    rows = active_operations(control, operation_name).select(
        "ingestion_name", "operation_type", "parameters", "params").collect()
    done: dict[str, list[str]] = {layer: [] for layer in LAYER_ORDER}
    for r in rows:
        if r.operation_type in LAYER_ORDER and (r.params is None or not _is_object(r.parameters)):
            raise ConfigError(f"{r.ingestion_name}: the parameters are no JSON object")
    wh = Warehouse(spark, warehouse_root)
    by_type = {layer: [r for r in rows if r.operation_type == layer] for layer in LAYER_ORDER}
    silver_rows = [silver_plan(r.params.asDict(recursive=True)) for r in by_type["silver"]]
    # Bronze is stored by the buckets of one target's keys; targets of other keys read it by the hash itself.
    keys_for: dict[str, list[str]] = {}
    for p in silver_rows:
        if p["cdc_type"] == "auto_cdc":
            keys_for.setdefault(p["source_table"], p["keys"])

    for r in by_type["bronze"]:
        p = r.params
        target = _need(p.target_table, "TARGET_TABLE")
        files.ingest(
            spark, _need(p.source_path, "SOURCE_PATH"), wh.path(target), wh.checkpoint(target, "bronze"),
            _need(json.loads(r.parameters).get("schema"), "SCHEMA"), p.file_format or "csv",
            keys=keys_for.get(target), buckets=buckets, mode=p.mode or "native", whole_file=bool(p.whole_file),
            max_files_per_trigger=max_files_per_trigger, options=p.options,
        )
        wh.register(target, replace=replace_tables)
        done["bronze"].append(target)

    for p in silver_rows:
        target, source = p["target_table"], p["source_table"]
        stored = wh.path(source) if exists(spark, wh.path(source)) else ".".join(source.split(".")[-2:])
        if p["cdc_type"] == "auto_cdc":
            cdc_stream.plain_rows(read_table(spark, stored)).createOrReplaceTempView(f"{target.split('.')[-1]}_source")
            cdc_stream.apply_changes(
                spark, stored, wh.path(target), wh.checkpoint(target, "silver"), p["keys"],
                p["sequence_by"], buckets=buckets, track=p["track"] or None, track_except=p["track_except"] or None,
                scd_type=p["scd_type"], segments=p["segments"], quarantine_path=wh.quarantine(target),
                feed_path=wh.feed(target) if p["change_feed"] else None,
            )
            wh.register(target, replace=replace_tables)
            if p["change_feed"] and list_folders(spark, wh.feed(target)):
                wh.register(f"{target}__changes", wh.feed(target), replace_tables)
        else:
            apply_snapshot_flow(spark, wh, p, stored, snapshot_version, replace_tables)
        done["silver"].append(target)

    for r in by_type["gold"]:
        path = _need(r.params.sql_file_path, "SQL_FILE_PATH")
        written = gold.materialize_views(spark, gold.read_sql_file(spark, path), f"{wh.root}/gold")
        for name, folder in written.items():
            wh.register(gold.table_name(name), folder, replace_tables)
            done["gold"].append(name)
    return done


def _is_object(text: str | None) -> bool:
    try:
        return isinstance(json.loads(text or ""), dict)
    except ValueError:
        return False


def _plain_version(version: Any) -> Any:
    """The version as Spark gives it back: a timestamp without zone, in local time."""
    if version is None:
        return dt.datetime.now()
    if isinstance(version, dt.datetime) and version.tzinfo is not None:
        return version.astimezone().replace(tzinfo=None)
    return version


def apply_snapshot_flow(spark: SparkSession, wh: Warehouse, p: dict, stored: str, version: Any, replace: bool) -> None:
    """Snapshot flow: the W2 view of bronze (first good row per key in ``order_keys`` order, all its columns,
    named ``<target>_snapshot`` for the session) diffed against the stored history. A version that is not newer than the
    last one applied changes nothing, for either SCD type. Of a bronze folder only files that no earlier run has merged are
    read (``first_rows``); a run without new files adds a version and no rows. A table that is known by its
    name alone is read as a whole."""
    target = p["target_table"]
    store = SnapshotStore(spark, wh.path(target))
    version, last = _plain_version(version), store.last()
    newer = last is None or version > last[2]
    view = f"{target.split('.')[-1]}_snapshot"
    firsts = step = None
    if "/" in stored:
        plan = (p["track"], p["track_except"], int(p["scd_type"]))
        firsts = FirstRows(spark, wh.checkpoint(target, "first_rows"), stored, p["keys"], p["order_keys"], plan)
        step = firsts.step()
        snap, fresh, batch = step.rows, step.new, f"place{step.place:06}"
    else:
        fresh = read_table(spark, stored)
        snap = dedup.first_per_key(cdc_stream.plain_rows(fresh), p["keys"], p["order_keys"])
        batch = hashlib.md5(str(version).encode()).hexdigest()[:12]
    if newer:
        if fresh is not None:
            write_rejected(spark, wh, target, fresh, batch, seen_before=step is None or step.whole)
        if step is not None:
            snap = firsts.publish(step)
        if step is not None and last is not None and firsts.used(step):
            store.repeat(version)
        else:
            keep_out = cdc_stream.untracked_lineage(snap, p["track"], p["track_except"])
            store.apply(snap, version, p["keys"], p["track"], keep_out, p["scd_type"])
        if step is not None:
            firsts.mark_used(step)
    snap.createOrReplaceTempView(view)
    wh.register_history(target, store, replace)


def write_rejected(spark: SparkSession, wh: Warehouse, target: str, rows: DataFrame, batch: str, seen_before: bool) -> None:
    """The bronze rows that no version of the target can apply, with their reason, in a folder for each run that met
    them first (a repeated run replaces its own). ``seen_before``: the rows may hold some that earlier runs met."""
    if files.REASON not in rows.columns:
        return
    path = wh.quarantine(target)
    bad = files.without_buckets(rows).filter(F.col(files.REASON).isNotNull())
    schema = evolve(spark, path, bad.schema)
    own = f"batch={batch}"
    earlier = [f"{path}/{name}" for name in list_folders(spark, path) if name != own]
    stamp = "_ingestion_timestamp"
    if seen_before and earlier and stamp in bad.columns:  # bronze only grows: its rows have later times
        newest = read_stored(spark, *earlier, table=path).agg(F.max(stamp)).first()[0]
        bad = bad.filter(F.col(stamp) > F.lit(newest)) if newest is not None else bad
    fitted(bad, schema).write.mode("overwrite").parquet(f"{path}/{own}")
