"""The control-table runner: validation, the snapshot store, catalog names."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from layerflow.operators import cdc, segmented, snapshot
from layerflow.plans import control
from layerflow.sources import files, landing
from layerflow.history import SnapshotStore
from layerflow.storage import exists
from layerflow.streaming import cdc_stream

SEEDED = {
    "source_table": "cat.bronze.stations", "target_table": "cat.silver.stations_cdc", "cdc_parameters": {
        "cdc_type": "auto_cdc_from_snapshot", "keys": ["id"], "stored_as_scd_type": "2",
        "track_history_except_column_list": ["source_metadata", "file_date"], "order_keys": ["_ingestion_timestamp", "file_date"]}}


def _plan(**changes):
    params = json.loads(json.dumps(SEEDED))
    params["cdc_parameters"].update(changes)
    return control.silver_plan(params)


def test_silver_plan_of_seeded_rows():
    plan = _plan()
    assert plan["scd_type"] == 2 and plan["order_keys"] == [("_ingestion_timestamp", "asc"), ("file_date", "asc")]
    assert _plan(stored_as_scd_type="1")["scd_type"] == 1
    assert _plan(scd_type=1)["scd_type"] == 1  # the first that says something
    assert _plan(scd_type=None, stored_as_scd_type=None)["scd_type"] == 2
    assert _plan(order_keys=["a desc", "b asc", "c"])["order_keys"] == [("a", "desc"), ("b", "asc"), ("c", "asc")]
    feed = dict(cdc_type="auto_cdc", sequence_by='["ts", "id"]')
    assert _plan(**feed)["sequence_by"] == ["ts", "id"]
    assert _plan(cdc_type="auto_cdc", sequence_by="ts")["sequence_by"] == ["ts"]


@pytest.mark.parametrize("changes", [
    {"cdc_type": "other"}, {"cdc_type": None}, {"keys": []}, {"order_keys": None}, {"scd_type": 3}, {"scd_type": "x"},
    {"cdc_type": "auto_cdc"}, {"cdc_type": "auto_cdc", "sequence_by": "[]"},
])
def test_silver_plan_refuses(changes):
    with pytest.raises(control.ConfigError):
        _plan(**changes)


def _control(spark, rows):
    return spark.createDataFrame(
        [("flow", n, kind, p if isinstance(p, str) else json.dumps(p), True) for n, kind, p in rows],
        "operation_name string, ingestion_name string, operation_type string, parameters string, is_active boolean")


def test_bad_json_and_no_rows(spark, tmp_path):
    for text in ("{not json", "[1]", "7"):
        with pytest.raises(control.ConfigError, match="bronze_x"):
            control.run_operations(spark, _control(spark, [("bronze_x", "bronze", text)]), "flow", str(tmp_path))
    done = control.run_operations(spark, _control(spark, [("a", "api", "{}")]), "flow", str(tmp_path))
    assert done == {"bronze": [], "silver": [], "gold": []}


@pytest.mark.parametrize("versions", [
    (1, 2, 3), (dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 3)),
    (dt.datetime(2025, 1, 1, 0, 0, 0, 1), dt.datetime(2025, 1, 1, 0, 0, 0, 2), dt.datetime(2025, 1, 1, 0, 0, 0, 900)),
])
@pytest.mark.parametrize("scd_type", [1, 2])
def test_snapshot_replays_lose_nothing(spark, tmp_path, versions, scd_type):
    """Three versions within one second; then an unchanged snapshot, and older versions that would undo it."""
    wh = control.Warehouse(spark, str(tmp_path))
    bronze = str(tmp_path / "bronze")
    plan = {"target_table": f"replay{scd_type}.t{abs(hash(versions))}", "keys": ["k"], "order_keys": [("at", "desc")], "track": ["v"],
            "track_except": [], "scd_type": scd_type}
    states = ([(1, "a", 1), (2, "b", 1)], [(1, "x", 2), (3, "c", 2)], [(1, "x", 3), (3, "c", 3)])

    def apply(state, version):
        spark.createDataFrame(state, "k int, v string, at int").coalesce(1).write.mode("overwrite").parquet(bronze)
        control.apply_snapshot_flow(spark, wh, plan, bronze, version, False)
        return sorted((tuple(r) for r in spark.read.table(plan["target_table"]).collect()), key=repr)

    for state, version in zip(states, versions):
        last = apply(state, version)
    one, two, _ = versions
    assert last == (sorted(states[2]) if scd_type == 1 else sorted([
        (1, "a", 1, one, two), (2, "b", 1, one, two), (1, "x", 3, two, None), (3, "c", 3, two, None)], key=repr))
    runs = SnapshotStore(spark, wh.path(plan["target_table"])).folders()
    for state, version in ((states[2], versions[2]), (states[0], versions[0]), ([], versions[1])):
        assert apply(state, version) == last
    assert SnapshotStore(spark, wh.path(plan["target_table"])).folders() == runs


def test_a_failed_run_is_not_there(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    rows = spark.createDataFrame([(1, 5, None)], "k int, __START_AT int, __END_AT int")
    store.add(rows, None, 5)
    rows.write.parquet(str(tmp_path / "s" / "open" / "run=half"))  # written, but not in the log
    rows.write.parquet(str(tmp_path / "s" / "closed" / "run=half"))
    assert store.read().count() == 1 and store.last()[2] == 5


def test_register_spares_other_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS keepme")
    spark.range(3).write.mode("overwrite").saveAsTable("keepme.t")
    wh = control.Warehouse(spark, str(tmp_path))
    spark.range(1).write.parquet(wh.path("keepme.t"))
    for replace in (False, True):
        with pytest.raises(control.ConfigError):
            wh.register("keepme.t", replace=replace)
    assert spark.read.table("keepme.t").count() == 3
    spark.sql("DROP TABLE keepme.t")
    wh.register("keepme.t")
    wh.register("keepme.t")
    other = control.Warehouse(spark, str(tmp_path / "other"))
    spark.range(2).write.parquet(other.path("keepme.t"))
    with pytest.raises(control.ConfigError):
        other.register("keepme.t")
    other.register("keepme.t", replace=True)
    assert spark.read.table("keepme.t").count() == 2 and spark.read.parquet(wh.path("keepme.t")).count() == 1
    spark.sql("DROP TABLE keepme.t")


def test_control_table_delete_list_drop(spark, tmp_path):
    path = str(tmp_path / "control")
    rows = spark.createDataFrame(
        [("p", "a", "bronze", "{}", True), ("p", None, "gold", "{}", True), ("p", "b", "silver", "{}", False)],
        "operation_name string, ingestion_name string, operation_type string, parameters string, is_active boolean",
    ).withColumn("creation_date", F.current_timestamp())
    control.write_control(rows, path)
    control.delete_operations(spark, path, ["a", "none"])
    assert [r.ingestion_name for r in control.list_operations(spark, path).collect()] == [None, "b"]
    control.drop_control(spark, path)
    control.drop_control(spark, path)
    assert not exists(spark, path)


def test_quarantined_rows_stay_out_of_snapshot_silver(spark, tmp_path):
    land = str(tmp_path / "land")
    spark.createDataFrame([('[{"id": 1, "n": "a"}, {"id": 2, "n": "b"}]',), ('[{"n": "no id"}]',), ("[{broken",)], "value string").write.text(land)
    schema = {"type": "struct", "fields": [{"name": "id", "type": "int", "nullable": False}, {"name": "n"}]}
    silver = {"source_table": "quar.src", "target_table": "quar.dst", "cdc_parameters": SEEDED["cdc_parameters"]}
    ctl = _control(spark, [
        ("b", "bronze", {"source_path": land, "file_format": "json", "target_table": "quar.src", "schema": schema}), ("s", "silver", silver)])
    control.run_operations(spark, ctl, "flow", str(tmp_path / "wh"), snapshot_version=1)
    out = spark.read.table("quar.dst")
    assert sorted((r.id, r.n) for r in out.collect()) == [(1, "a"), (2, "b")]
    assert {"source_metadata", "_ingestion_timestamp", "file_date"} <= set(out.columns)


def test_buckets_of_other_keys_are_not_trusted(spark, tmp_path):
    rows = [(1, 10, "x", 1), (1, 10, "y", 6), (2, 10, "x", 3), (2, 11, "z", 4), (1, 11, "q", 9)]
    bronze = files.with_bucket(spark.createDataFrame(rows, "a int, b int, v string, s int"), ["a"], 8)
    path = str(tmp_path / "bronze")
    bronze.write.partitionBy(files.bucket_column(["a"], 8)).parquet(path)
    for keys, buckets in ((["a"], 8), (["b"], 8), (["a"], 5)):
        silver = str(tmp_path / f"silver-{keys[0]}-{buckets}")
        cdc_stream.apply_changes(spark, path, silver, silver + "-ck", keys, "s", buckets=buckets, track=["v"])
        got = cdc_stream.read_silver(spark, silver).select("a", "b", "v", "s", cdc.START_AT, cdc.END_AT)
        want = cdc.scd2_from_changes(spark.createDataFrame(rows, "a int, b int, v string, s int"), keys, "s", track=["v"])
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_null_keys_and_unnamed_versions_of_snapshots(spark):
    first = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    second = spark.createDataFrame([(None, "z"), (2, "c")], "k int, v string")
    history = snapshot.apply_snapshot(snapshot.apply_snapshot(None, first, 1, ["k"]), second, 2, ["k"])
    want = [(1, "b", 1, 2), (2, "c", 2, None), (None, "a", 1, 2), (None, "z", 2, None)]
    assert sorted(map(tuple, history.collect()), key=repr) == sorted(want, key=repr)
    stacked = spark.createDataFrame([(None, "a", 1), (1, "b", 1), (None, "z", 2), (2, "c", 2), (9, "q", None)], "k int, v string, version int")
    assert sorted(map(tuple, snapshot.scd2_from_snapshots(stacked, ["k"], "version").collect()), key=repr) == sorted(want, key=repr)


def test_segmented_plan_at_a_clock_change(spark):
    """Wall-clock sequences through an hour that the session's zone skips and one that it repeats."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    times = [dt.datetime(2024, 3, 10, 0) + dt.timedelta(minutes=20 * i) for i in range(15)]
    times += [dt.datetime(2024, 11, 3, 0) + dt.timedelta(minutes=20 * i) for i in range(15)]
    text = "\n".join(f"SELECT {i % 2} AS k, TIMESTAMP_NTZ'{t}' AS ts, {i // 3 % 2} AS v" + (" UNION ALL" if i < 29 else "") for i, t in enumerate(times))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        feed = spark.sql(text)
        plain = sorted(map(repr, cdc.scd2_from_changes(feed, ["k"], "ts", track=["v"]).collect()))
        for segments in (2, 7, 40):
            cut = segmented.scd2_from_changes_segmented(feed, ["k"], "ts", track=["v"], segments=segments)
            assert sorted(map(repr, cut.collect())) == plain
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_more_ranges_than_fit_a_chain(spark):
    feed = spark.range(4000).selectExpr("id % 3 as k", "id as s", "(id div 5) % 2 as v")
    cut = segmented.scd2_from_changes_segmented(feed, ["k"], "s", track=["v"], segments=1500)
    plain = cdc.scd2_from_changes(feed, ["k"], "s", track=["v"])
    assert sorted(map(tuple, cut.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_csv_rows_with_too_few_fields(spark, tmp_path):
    path = str(tmp_path / "csv")
    spark.createDataFrame([("id,n,x",), ("1,a,2.5",), ("2,b",), ("x,c,1",), ('3,"d, e",4',)], "value string").coalesce(1).write.text(path)
    schema = {"type": "struct", "fields": [{"name": "id", "type": "int"}, {"name": "n"}, {"name": "x", "type": "double"}]}
    got = files.read_landed(spark, path, schema, "csv", stream=False, options={"header": "true"})
    assert sorted((r.n, r[files.REASON]) for r in got.collect()) == [("a", None), ("b", "short_row"), ("c", None), ("d, e", None)]


def test_landed_arrays_hold_several_records(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"r{i}") for i in range(10)], "id int, n string")
    landing.land_json_arrays(rows, str(tmp_path), "k", F.lit("20250101_000000"), group=F.floor(F.col("id") / 4))
    assert spark.read.text(f"{tmp_path}/key=k").count() == 3
    schema = {"type": "struct", "fields": [{"name": "id", "type": "int"}, {"name": "n"}]}
    for mode in ("native", "salvage"):
        got = files.good_rows(files.read_landed(spark, f"{tmp_path}/key=k", schema, "json", stream=False, mode=mode))
        assert sorted((r.id, r.n) for r in got.collect()) == [(i, f"r{i}") for i in range(10)]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from layerflow import session

    context = SimpleNamespace(
        master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: SimpleNamespace(get=lambda k, d: None))
    with pytest.raises(RuntimeError):
        session.shared_dir(SimpleNamespace(sparkContext=context))


def test_delete_by_a_table_of_names(spark, tmp_path):
    path, schema = str(tmp_path / "control"), "operation_name string, ingestion_name string, operation_type string"
    spark.createDataFrame([("o", n, "gold") for n in ("a", "b", "b", "c", None)], schema).write.parquet(path)
    control.delete_operations(spark, path, spark.createDataFrame([("b",), ("b",), ("z",), (None,)], "ingestion_name string"))
    left = spark.read.parquet(path)
    assert left.columns == ["operation_name", "ingestion_name", "operation_type"]
    assert sorted(r.ingestion_name or "" for r in left.collect()) == ["", "a", "c"]


def test_rejected_rows_are_those_that_a_run_refuses(spark):
    """The rules as columns say what ``silver_plan`` raises for."""
    cdc = {"cdc_type": "auto_cdc", "keys": ["k"], "sequence_by": "at"}
    snap = {"cdc_type": "auto_cdc_from_snapshot", "keys": ["k"], "order_keys": ["at desc"]}
    whole = {"source_table": "b.t", "target_table": "s.t"}
    flows = [cdc, snap, {**snap, "order_keys": []}, {**cdc, "sequence_by": '["a","b"]'}, {**cdc, "sequence_by": ["a"]}, {**cdc, "sequence_by": "[]"},
             {**cdc, "scd_type": 1}, {**cdc, "scd_type": " 2 "}, {**cdc, "scd_type": "", "stored_as_scd_type": "7"}, {**cdc, "scd_type": 0},
             {**cdc, "keys": None}, {**cdc, "cdc_type": ""}, {**cdc, "cdc_type": "other"}, {}, None]
    rows = [{**whole, "cdc_parameters": f} for f in flows] + [{**whole, "source_table": ""}, {"cdc_parameters": cdc, "source_table": "b.t"}, {}]
    ctl = _control(spark, [(f"r{i:02}", "silver", r) for i, r in enumerate(rows)])
    refused = {}
    for r in ctl.withColumn("params", F.from_json("parameters", control.PARAMETERS_SCHEMA)).collect():
        try:
            control.silver_plan(r.params.asDict(recursive=True))
        except control.ConfigError as why:
            refused[r.ingestion_name] = str(why)
    found = {r.ingestion_name: r.reason for r in control.rejected_operations(ctl).collect()}
    assert set(found) == set(refused) and len(found) == 12
    assert all(found[n].split()[-1] in refused[n] for n in found if found[n].startswith("no "))
