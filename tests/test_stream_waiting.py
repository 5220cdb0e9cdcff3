"""Many small micro-batches: bronze files as large as their bytes ask for, silver rows put aside until they are worth a rewrite."""

import pytest
from pyspark.sql import functions as F

from layerflow.operators import cdc
from layerflow.plans.registry import EVENTS_SCHEMA
from layerflow.sources import files
from layerflow.streaming import cdc_stream

SCHEMA = "k int, s int, v string"


def canon(df):
    return sorted(map(repr, df.select("k", "s", "v", cdc.START_AT, cdc.END_AT).collect()))


def small_files(spark, path, number, seed=0):
    """So many appends of five rows each, late ones and NULL keys among them."""
    for i in range(number):
        rows = [(None if j == 4 else (i + j) % 6, (i * 37 + j * 11 + seed) % 90, "abc"[(i * j + seed) % 3]) for j in range(5)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, root, **more):
    cdc_stream.apply_changes(
        spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck", ["k"], "s", buckets=2, track=["v"], era_width=10,
        max_files_per_trigger=1, **more)
    return canon(cdc_stream.read_silver(spark, f"{root}/silver"))


def plain(spark, root):
    return canon(cdc.scd2_from_changes(spark.read.schema(SCHEMA).parquet(f"{root}/bronze"), ["k"], "s", track=["v"]))


def test_small_micro_batches_rewrite_the_table_a_few_times(spark, tmp_path, monkeypatch):
    written, real = [], cdc_stream.replace_eras
    monkeypatch.setattr(cdc_stream, "replace_eras", lambda *a, **k: written.append(a) or real(*a, **k))
    small_files(spark, f"{tmp_path}/bronze", 14)
    assert run(spark, tmp_path, quarantine_path=f"{tmp_path}/bad") == plain(spark, tmp_path)
    assert 2 <= len(written) <= 7  # 14 micro-batches
    assert len(list((tmp_path / "bad").glob("batch=*"))) == 14
    assert not (tmp_path / "ck" / "waiting").exists()


def test_rows_that_wait_outlive_a_failed_run(spark, tmp_path, monkeypatch):
    """A run fails before, then while its waiting rows take their place; the next one applies them, also if bronze has
    nothing new, and before it computes anything from a half-written table."""
    small_files(spark, f"{tmp_path}/bronze", 3)
    run(spark, tmp_path)
    big = spark.range(400).select((F.col("id") % 6).cast("int").alias("k"), F.col("id").cast("int").alias("s"), F.lit("x").alias("v"))
    big.coalesce(1).write.mode("append").parquet(f"{tmp_path}/bronze")
    run(spark, tmp_path)
    small_files(spark, f"{tmp_path}/bronze", 2, seed=1)

    def fail(*_, **__):
        raise OSError("stopped")

    with monkeypatch.context() as m:
        m.setattr(cdc_stream, "stage_scd2", fail)
        with pytest.raises(OSError):
            run(spark, tmp_path)
    assert len(list((tmp_path / "ck" / "waiting").glob("batch=*"))) == 2
    with monkeypatch.context() as m:
        m.setattr(cdc_stream, "replace_eras", fail)
        with pytest.raises(OSError):
            run(spark, tmp_path)
    small_files(spark, f"{tmp_path}/bronze", 1, seed=2)
    order, stage_scd2, replace_eras = [], cdc_stream.stage_scd2, cdc_stream.replace_eras
    monkeypatch.setattr(cdc_stream, "stage_scd2", lambda *a, **k: order.append("stage") or stage_scd2(*a, **k))
    monkeypatch.setattr(cdc_stream, "replace_eras", lambda *a, **k: order.append("replace") or replace_eras(*a, **k))
    assert run(spark, tmp_path) == plain(spark, tmp_path)
    assert order == ["replace", "stage", "replace"]


def test_scd1_rows_wait_too(spark, tmp_path):
    small_files(spark, f"{tmp_path}/bronze", 5)
    cdc_stream.apply_changes(
        spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/ck", ["k"], "s", buckets=2, scd_type=1, max_files_per_trigger=1)
    got = cdc_stream.read_silver(spark, f"{tmp_path}/silver").select("k", "s", "v")
    want = cdc.scd1_from_changes(spark.read.schema(SCHEMA).parquet(f"{tmp_path}/bronze"), ["k"], "s")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_bronze_files_follow_the_landed_bytes(spark, tmp_path, monkeypatch):
    """Many shuffle partitions: a bucket's few rows of a micro-batch are one file; many rows are still dealt."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.select(F.to_json(F.struct("*")).alias("value")).repartition(3).write.text(f"{tmp_path}/land")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        def ingested(name, **more):
            files.ingest(spark, f"{tmp_path}/land", f"{tmp_path}/{name}", f"{tmp_path}/{name}-ck", EVENTS_SCHEMA, "json",
                         keys=["user_id"], buckets=4, **more)
            bronze = spark.read.parquet(f"{tmp_path}/{name}")
            assert bronze.select("event_id").exceptAll(events.select("event_id")).count() == 0 and bronze.count() == events.count()
            return len(list((tmp_path / name).rglob("part-*.parquet")))

        assert ingested("few", max_files_per_trigger=1) <= 3 * 4
        monkeypatch.setattr(files, "SHARE_BYTES", 1 << 10)
        assert ingested("many") > 2 * 4
        assert files.bucket_shares(spark, f"{tmp_path}/land", 4) == 16  # as many as fill the partitions
        assert files.bucket_shares(spark, f"{tmp_path}/la*", 4, max_files_per_trigger=1) >= 2
        assert files.bucket_shares(spark, f"{tmp_path}/none", 4) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
