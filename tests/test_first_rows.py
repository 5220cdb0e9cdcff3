"""First rows per key kept from run to run: only new files are read, and the history is that of a full reread."""

import random

import pytest
from pyspark.sql import functions as F

from layerflow.first_rows import FirstRows
from layerflow.history import SnapshotStore
from layerflow.operators import dedup
from layerflow.plans import control
from layerflow.schemas import evolve
from layerflow.sources import files


def add(spark, bronze, rows, run):
    """Append (k, at, v, reason) rows as one run of ingest would."""
    made = spark.createDataFrame([(k, at, v, reason) for k, at, v, reason in rows], "k int, at int, v string, r string")
    made.select(
        "k", "at", "v", F.timestamp_seconds(F.lit(1_700_000_000 + run)).alias("_ingestion_timestamp"),
        F.lit(None).cast("string").alias(files.CORRUPT), F.col("r").alias(files.REASON),
    ).write.mode("append").parquet(bronze)


def plan(target, order, scd_type=2):
    return {"target_table": target, "keys": ["k"], "order_keys": order, "track": ["v"], "track_except": [], "scd_type": scd_type}


def rows_of(df):
    return sorted(map(repr, df.collect()))


def full_reread(spark, root, bronze, p, version):
    """The flow as one would write it without kept rows."""
    store = SnapshotStore(spark, root)
    good = control.cdc_stream.plain_rows(spark.read.parquet(bronze))
    store.apply(dedup.first_per_key(good, p["keys"], p["order_keys"]), version, p["keys"], p["track"], None, p["scd_type"])
    return store


@pytest.mark.parametrize("direction, scd_type", [("asc", 2), ("desc", 2), ("desc", 1)])
def test_history_equals_a_full_reread(spark, tmp_path, direction, scd_type):
    """Late rows, ties, repeated rows, NULL keys and orders, rows with a reason, and runs without any new row."""
    rng = random.Random(f"{direction}{scd_type}")
    wh, bronze = control.Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "bronze")
    p = plan(f"firsts.{direction}{scd_type}", [("at", direction)], scd_type)
    bad = 0
    for version in range(1, 5):
        if version != 3:
            rows = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, *range(6)]), rng.choice("abc"), rng.choice([None, None, "short_row"]))
                    for _ in range(12)]
            bad += sum(r[3] is not None for r in rows)
            add(spark, bronze, rows, version)
        control.apply_snapshot_flow(spark, wh, p, bronze, version, True)
        want = full_reread(spark, str(tmp_path / "plain"), bronze, p, version)
        assert rows_of(spark.read.table(p["target_table"])) == rows_of(want.read())
        assert spark.read.parquet(wh.quarantine(p["target_table"])).count() == bad


def test_a_run_reads_new_files_only(spark, tmp_path):
    bronze, root = str(tmp_path / "bronze"), str(tmp_path / "firsts")
    firsts = FirstRows(spark, root, bronze, ["k"], [("at", "asc")])
    add(spark, bronze, [(1, 5, "a", None), (2, 5, "a", None)], 1)
    step = firsts.step()
    assert step.whole and step.place == 0
    firsts.publish(step)
    old = set(spark.read.parquet(bronze).inputFiles())
    add(spark, bronze, [(1, 3, "earlier", None), (3, 9, "c", None)], 2)
    step = firsts.step()
    assert not step.whole and set(step.new.inputFiles()) == set(spark.read.parquet(bronze).inputFiles()) - old
    assert not old & set(step.rows.inputFiles())
    got = firsts.publish(step)
    assert sorted((r.k, r.at, r.v) for r in got.collect()) == [(1, 3, "earlier"), (2, 5, "a"), (3, 9, "c")]
    assert firsts.step().new is None
    # Another order cannot use the rows, nor can a table that was replaced.
    assert FirstRows(spark, root, bronze, ["k"], [("at", "desc")]).step().whole
    spark.createDataFrame([(7, 1, "z")], "k int, at int, v string").write.mode("overwrite").parquet(bronze)
    step = firsts.step()
    assert step.whole and [r.k for r in firsts.publish(step).collect()] == [7]


def test_a_run_without_new_rows_adds_a_version_only(spark, tmp_path):
    wh, bronze, p = control.Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "bronze"), plan("firsts.still", [("at", "asc")])
    add(spark, bronze, [(1, 5, "a", None), (2, 5, "a", None)], 1)
    control.apply_snapshot_flow(spark, wh, p, bronze, 1, True)
    store = SnapshotStore(spark, wh.path(p["target_table"]))
    before, rows = store.folders(), rows_of(spark.read.table(p["target_table"]))
    for version in (2, 3):
        control.apply_snapshot_flow(spark, wh, p, bronze, version, True)
    assert store.last()[2] == 3 and store.folders() == before and rows_of(spark.read.table(p["target_table"])) == rows
    add(spark, bronze, [(2, 1, "b", None)], 4)
    control.apply_snapshot_flow(spark, wh, p, bronze, 4, True)
    control.apply_snapshot_flow(spark, wh, p, bronze, 5, True)
    got = sorted((r["k"], r["v"], r["__START_AT"], r["__END_AT"] or 0) for r in spark.read.table(p["target_table"]).collect())
    assert got == [(1, "a", 1, 0), (2, "a", 1, 4), (2, "b", 4, 0)]
    assert rows_of(store.read()) == rows_of(spark.read.table(p["target_table"]))


@pytest.mark.parametrize("where", ["rejected", "published", "applied"])
def test_a_run_that_failed_is_repeated(spark, tmp_path, monkeypatch, where):
    wh, bronze, p = control.Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "bronze"), plan(f"firsts.fail_{where}", [("at", "asc")])
    add(spark, bronze, [(1, 5, "a", None), (9, 9, "x", "short_row")], 1)
    control.apply_snapshot_flow(spark, wh, p, bronze, 1, True)
    add(spark, bronze, [(1, 2, "b", None), (2, 5, "c", None), (9, 8, "y", "short_row")], 2)

    def stop(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        owner, name = {"rejected": (FirstRows, "publish"), "published": (SnapshotStore, "apply"), "applied": (FirstRows, "mark_used")}[where]
        broken.setattr(owner, name, stop)
        with pytest.raises(RuntimeError):
            control.apply_snapshot_flow(spark, wh, p, bronze, 2, True)
    control.apply_snapshot_flow(spark, wh, p, bronze, 2 if where != "applied" else 3, True)
    got = sorted((r["k"], r["v"], r["__START_AT"], r["__END_AT"] or 0) for r in spark.read.table(p["target_table"]).collect())
    assert got == [(1, "a", 1, 2), (1, "b", 2, 0), (2, "c", 2, 0)]
    assert spark.read.parquet(wh.quarantine(p["target_table"])).count() == 2


def test_columns_that_bronze_gains(spark, tmp_path):
    bronze, root = str(tmp_path / "bronze"), str(tmp_path / "firsts")
    def put(df):
        evolve(spark, bronze, df.schema)
        df.write.mode("append").parquet(bronze)

    put(spark.createDataFrame([(1, 5), (2, 5)], "k int, at int"))
    firsts = FirstRows(spark, root, bronze, ["k"], [("at", "asc")])
    firsts.publish(firsts.step())
    put(spark.createDataFrame([(2, 4, "new"), (3, 1 << 40, "w")], "k int, at bigint, w string"))
    step = firsts.step()
    assert not step.whole
    got = firsts.publish(step)
    assert sorted((r.k, r.at, r.w or "") for r in got.collect()) == [(1, 5, ""), (2, 4, "new"), (3, 1 << 40, "w")]
