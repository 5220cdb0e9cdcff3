"""Keys of very many rows in the silver stream: windows over slices of a key's time give what windows over the key give."""

import random

import pytest
from pyspark.sql import functions as F

from layerflow.operators import cdc, segmented, slices
from layerflow.sources import files
from layerflow.streaming import cdc_stream

SCHEMA = "k int, s long, v string, note string"


@pytest.fixture(autouse=True)
def small_slices(monkeypatch):
    monkeypatch.setattr(slices, "HOT_ROWS", 60)
    monkeypatch.setattr(slices, "SLICE_ROWS", 20)


def hot_rows(rng, n, span):
    """Key 1 and the NULL key hold most rows; many rows share a time, and some values stay long enough to make versions
    that reach over slices."""
    return [(rng.choice([1, 1, 1, None, None, 2, 3, 4]), s := rng.randrange(span), "abc"[s // 97 % 3] if s % 7 else rng.choice("xy"),
             f"{rng.random():.6f}") for _ in range(n)]


def versions(df):
    return sorted(map(repr, df.select("k", "s", "v", "note", cdc.START_AT, cdc.END_AT).collect()))


@pytest.mark.parametrize("kind, width", [("long", 50), ("timestamp_ntz", None), ("date", None)])
def test_hot_keys_equal_the_plain_plan(spark, tmp_path, kind, width):
    rng, bronze, silver, seen = random.Random(3), f"{tmp_path}/bronze", f"{tmp_path}/silver", []
    at = {"long": F.col("s"), "date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("s").cast("int")),
          "timestamp_ntz": F.timestamp_seconds(F.col("s") * 7200).cast("timestamp_ntz")}[kind]
    for n in (500, 200, 40, 150):
        spark.createDataFrame(hot_rows(rng, n, 600), SCHEMA).withColumn("s", at).coalesce(2).write.mode("append").parquet(bronze)
        cdc_stream.apply_changes(spark, bronze, silver, f"{tmp_path}/ck", ["k"], "s", buckets=2, track=["v"], era_width=width)
        plain = cdc.scd2_from_changes(spark.read.parquet(bronze), ["k"], "s", track=["v"])
        assert versions(cdc_stream.read_silver(spark, silver)) == versions(plain)
        stage = next((tmp_path / "ck" / "stage").iterdir())
        seen.append({p.name for p in stage.iterdir()})
    assert "hot_local" in seen[0] and {"hot_versions", "near_found", "hot_rows", "rows", "hot_local"} <= seen[1]
    local = spark.read.parquet(f"{stage}/hot_local")
    groups = [r["count"] for r in local.groupBy(segmented.KID, segmented.SEG).count().collect()]
    assert len(groups) > 8 and max(groups) <= 60


def test_a_slice_has_about_as_many_rows_as_asked_and_every_key_its_own(spark, tmp_path):
    """One key lies in a short time, two are spread; one of few rows is not hot."""
    rows = spark.range(3000).select(
        F.when(F.col("id") < 1000, 1).when(F.col("id") < 2000, 2).when(F.col("id") < 2950, 3).otherwise(4).alias("k"),
        F.when(F.col("id") < 1000, F.col("id")).otherwise(F.col("id") * 1000).alias("__at"))
    hot = slices.hot_slices(rows, ["k"], f"{tmp_path}/hot")
    assert sorted(r.k for r in hot.bounds.collect()) == [1, 2, 3]
    placed = slices.with_slice(rows, hot, ["k"], F.col("__at"))
    held = {(r["k"], r[slices.SLICE]): r["count"] for r in placed.groupBy("k", slices.SLICE).count().collect()}
    assert held[4, -1] == 50
    of_hot = [n for (k, _), n in held.items() if k < 4]
    assert len(of_hot) >= 130 and max(of_hot) <= 30
    disorder = placed.alias("l").join(placed.alias("r"), "k").filter(
        (F.col("l.__at") < F.col("r.__at")) & (F.col(f"l.{slices.SLICE}") > F.col(f"r.{slices.SLICE}")))
    assert disorder.filter("k = 1").count() == 0
    assert slices.hot_slices(rows.filter("k = 4"), ["k"], f"{tmp_path}/none") is None


def test_versions_near_over_slices(spark, tmp_path):
    """Random versions and few points, so that what a version needs often lies several slices away."""
    rng = random.Random(11)
    starts = {k: sorted(rng.sample(range(0, 4000, 2), 300)) for k in (1, None, 5)}
    stored = spark.createDataFrame(
        [(k, s + rng.randrange(2), s, end) for k, own in starts.items() for s, end in zip(own, [*own[1:], None])],
        f"k int, s int, {cdc.START_AT} int, {cdc.END_AT} int")
    points = spark.createDataFrame([(k, rng.randrange(-10, 4010)) for k in (1, 1, None) for _ in range(6)], "k int, s int")
    times = stored.select("k", F.col(cdc.START_AT).alias("__at"))
    hot = slices.hot_slices(times.filter("k is null or k = 1"), ["k"], f"{tmp_path}/hot")
    plain = cdc_stream.versions_near(stored, points, ["k"], "s")
    sliced = cdc_stream.versions_near(stored, points, ["k"], "s", hot, f"{tmp_path}/found")
    assert sorted(map(repr, sliced.collect())) == sorted(map(repr, plain.collect()))
    assert spark.read.parquet(f"{tmp_path}/found").select(slices.SLICE).distinct().count() > 5


def test_two_targets_one_of_them_hot(spark, tmp_path):
    """Few values as keys, as a target by event type has them, with a composite sequence and a feed of ties."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    for part in range(2):
        files.with_bucket(events.filter(F.col("event_id") % 2 == part), ["user_id"], 4).write.mode("append").partitionBy(
            files.bucket_column(["user_id"], 4)).parquet(bronze)
        cdc_stream.apply_changes(
            spark, bronze, silver, f"{tmp_path}/ck", ["event_type"], ["ts", "event_id"], buckets=4, track=["user_id"])
    cols = ["event_type", "ts", "event_id", "user_id", cdc.START_AT, cdc.END_AT]
    want = cdc.scd2_from_changes(events, ["event_type"], ["ts", "event_id"], track=["user_id"])
    assert sorted(map(repr, cdc_stream.read_silver(spark, silver).select(cols).collect())) == sorted(map(repr, want.select(cols).collect()))
