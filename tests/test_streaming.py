"""Incremental SCD stream: late rows, several micro-batches, replay."""

from pyspark.sql import functions as F

from layerflow.operators import cdc
from layerflow.plans.registry import EVENTS_SCHEMA
from layerflow.sources import files, landing
from layerflow.streaming import cdc_stream

SF = "/root/testdata/sf0.001"
COLS = ["user_id", "ts", "event_type"]


def canon(df):
    return sorted(tuple(r) for r in df.select(*COLS, cdc.START_AT, cdc.END_AT).collect())


def test_late_rows_and_replay_equal_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    base, bronze, silver = str(tmp_path / "land"), str(tmp_path / "bronze"), str(tmp_path / "silver")
    part = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for p in range(4):  # every append holds rows from the whole time range
        landing.land_json_arrays(events.filter(part == p), base, "events", F.lit(f"2025010{p + 1}_000000"))
        files.ingest(spark, f"{base}/key=events", bronze, str(tmp_path / "ckb"), EVENTS_SCHEMA, "json",
                     keys=["user_id"], buckets=8, max_files_per_trigger=1)
        cdc_stream.apply_changes(spark, bronze, silver, str(tmp_path / "cks"), ["user_id"], "ts", buckets=8,
                                 track=["event_type"], columns=COLS, max_files_per_trigger=4)
    expected = canon(cdc.scd2_from_changes(spark.read.parquet(bronze).select(*COLS), ["user_id"], "ts", track=["event_type"]))
    assert canon(cdc_stream.read_silver(spark, silver)) == expected

    # Replay from scratch with a new checkpoint into the same silver table:
    # every bucket is rewritten with the same rows.
    cdc_stream.apply_changes(spark, bronze, silver, str(tmp_path / "cks2"), ["user_id"], "ts", buckets=8,
                             track=["event_type"], columns=COLS, max_files_per_trigger=2)
    assert canon(cdc_stream.read_silver(spark, silver)) == expected


def test_stream_with_segmented_plan(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    base, bronze, silver = str(tmp_path / "land"), str(tmp_path / "bronze"), str(tmp_path / "silver")
    landing.land_json_arrays(events, base, "events", F.lit("20250101_000000"))
    files.ingest(spark, f"{base}/key=events", bronze, str(tmp_path / "ckb"), EVENTS_SCHEMA, "json",
                 keys=["user_id"], buckets=4)
    cdc_stream.apply_changes(spark, bronze, silver, str(tmp_path / "cks"), ["user_id"], "ts", buckets=4,
                             track=["event_type"], columns=COLS, segments=8)
    expected = canon(cdc.scd2_from_changes(spark.read.parquet(bronze).select(*COLS), ["user_id"], "ts", track=["event_type"]))
    assert canon(cdc_stream.read_silver(spark, silver)) == expected


def _files(folder):
    import os

    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def test_new_rows_leave_old_files_and_late_rows_are_exact(spark, tmp_path):
    """Rows of a new month touch no file of versions that ended before; a late row rewrites from its month on."""
    events = spark.read.parquet(f"{SF}/events.parquet").select(*COLS)
    months = [events.withColumn("ts", F.expr(f"ts + INTERVAL '{m}' MONTH")) for m in range(4)]
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")

    def arrive(rows):
        files.with_bucket(rows, ["user_id"], 4).repartition(files.bucket_column(["user_id"], 4)).write.mode("append").partitionBy(
            files.bucket_column(["user_id"], 4)).parquet(bronze)
        cdc_stream.apply_changes(spark, bronze, silver, str(tmp_path / "ck"), ["user_id"], "ts", buckets=4, track=["event_type"])
        want = cdc.scd2_from_changes(spark.read.parquet(bronze).select(*COLS), ["user_id"], "ts", track=["event_type"])
        assert canon(cdc_stream.read_silver(spark, silver)) == canon(want)
        return _files(silver)

    arrive(months[0])
    second = arrive(months[1])
    third = arrive(months[3])
    old = {f for f in second if f in third}
    assert old and all(second[f] == third[f] for f in old)
    assert all("era=" in f and f"era={cdc_stream.OPEN_ERA}" not in f for f in old)
    folders = [f.rsplit("/", 1)[0] for f in third]
    assert len(folders) == len(set(folders))  # one file for each bucket and era
    late = arrive(months[2].filter("user_id % 2 = 0"))  # between the second and the fourth month
    kept = {f for f in third if f in late}
    assert kept and all(third[f] == late[f] for f in kept)
    arrive(months[0].withColumn("ts", F.expr("ts - INTERVAL '1' SECOND")).filter("user_id % 3 = 0"))  # late in the first


def test_a_batch_is_repeated_from_its_stage(spark, tmp_path):
    """Eras are lost half-way through a commit: the repeated batch restores them, though silver no longer has the
    starts that it was computed from."""
    import shutil

    rows = spark.read.parquet(f"{SF}/events.parquet").select(*COLS)
    bronze, silver, ck = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ck")
    rows.filter("user_id % 2 = 0 or ts < '2024-01-15'").write.mode("append").parquet(bronze)
    cdc_stream.apply_changes(spark, bronze, silver, ck, ["user_id"], "ts", buckets=4, track=["event_type"])
    rows.filter("user_id % 2 = 1 and ts >= '2024-01-15'").write.mode("append").parquet(bronze)
    cdc_stream.apply_changes(spark, bronze, silver, ck, ["user_id"], "ts", buckets=4, track=["event_type"])
    want = canon(cdc_stream.read_silver(spark, silver))
    for folder in list((tmp_path / "silver").glob("*/*"))[::2]:
        if folder.is_dir():
            shutil.rmtree(folder)
    (tmp_path / "ck" / "commits" / "1").unlink()
    for crc in (tmp_path / "ck" / "commits").glob(".1*"):
        crc.unlink()
    cdc_stream.apply_changes(spark, bronze, silver, ck, ["user_id"], "ts", buckets=4, track=["event_type"])
    got = canon(cdc_stream.read_silver(spark, silver))
    touched = {r for r in got}
    assert touched <= set(want) and len(got) == len(touched)
    odd = {r for r in want if r[0] % 2 == 1}
    assert odd <= touched  # the batch's keys are whole again


def test_scd1_stream(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/events.parquet").select(*COLS)
    bronze, silver, ck = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ck")
    for p in (1, 0, 2):  # out of order
        rows.filter(F.pmod(F.dayofmonth("ts"), F.lit(3)) == p).write.mode("append").parquet(bronze)
        cdc_stream.apply_changes(spark, bronze, silver, ck, ["user_id"], "ts", buckets=4, scd_type=1)
    want = cdc.scd1_from_changes(rows, ["user_id"], "ts")
    got = cdc_stream.read_silver(spark, silver).select(*COLS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
