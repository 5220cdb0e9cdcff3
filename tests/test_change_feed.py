"""The feed of a CDC target: each change once, replay gives the table, failed batches are delivered once."""

import random

import pytest
from pyspark.sql import functions as F

from layerflow.sources import files
from layerflow.sources.tables import stream_table
from layerflow.streaming import cdc_stream, change_feed

SCHEMA = "k int, s int, v string, m map<string,int>"


def rows_of(df):
    return sorted(map(repr, df.select("k", "s", "v", *(c for c in ("__START_AT", "__END_AT") if c in df.columns)).collect()))


class Flow:
    def __init__(self, spark, root, scd_type=2, feed=True):
        self.spark, self.root, self.scd_type = spark, str(root), scd_type
        self.bronze, self.silver, self.feed = (f"{root}/{x}" for x in ("bronze", "silver", "feed"))
        self.on = feed

    def add(self, rows):
        df = self.spark.createDataFrame([(k, s, v, {"a": s} if s else None) for k, s, v in rows], SCHEMA)
        df.coalesce(1).write.mode("append").parquet(self.bronze)

    def run(self):
        cdc_stream.apply_changes(
            self.spark, self.bronze, self.silver, f"{self.root}/ck", ["k"], "s", buckets=3, track=["v"], scd_type=self.scd_type,
            era_width=5, feed_path=self.feed if self.on else None)

    def table(self):
        return cdc_stream.read_silver(self.spark, self.silver)

    def replayed(self, feed=None):
        return change_feed.replay(change_feed.read_feed(self.spark, self.feed) if feed is None else feed, ["k"], self.scd_type)


@pytest.mark.parametrize("scd_type", [1, 2])
def test_replay_gives_the_table_and_a_stream_gets_each_change_once(spark, tmp_path, scd_type):
    rng, flow = random.Random(scd_type), Flow(spark, tmp_path, scd_type)
    copy = str(tmp_path / "copy")
    for _ in range(3):  # late rows, ties, NULL keys and sequences
        flow.add([(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, *range(20)]), rng.choice("ab")) for _ in range(12)])
        flow.run()
        files.write_bronze(stream_table(spark, flow.feed), copy, str(tmp_path / "ckc"))
        delivered = spark.read.parquet(copy)
        assert rows_of(flow.replayed(delivered)) == rows_of(flow.table())
        once = delivered.groupBy(*change_feed.identity(["k"], scd_type), "batch").count()
        assert once.filter("count > 1").count() == 0
    assert delivered.count() == change_feed.read_feed(spark, flow.feed).count()


def test_what_the_feed_says(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    flow.add([(1, 10, "a"), (2, 10, "a")])
    flow.run()
    flow.add([(1, 20, "b")])  # closes a version and opens one; key 2 stays
    flow.run()
    flow.add([(1, 5, "b"), (2, 4, "a")])  # a version before the first; a version that now starts earlier
    flow.run()
    got = sorted((r.batch, r.k, r["__START_AT"], r["__END_AT"] or 0, r[change_feed.CHANGE])
                 for r in change_feed.read_feed(spark, flow.feed).collect())
    assert got == [
        (0, 1, 10, 0, "insert"), (0, 2, 10, 0, "insert"), (1, 1, 10, 20, "update"), (1, 1, 20, 0, "insert"),
        (2, 1, 5, 10, "insert"), (2, 2, 4, 0, "insert"), (2, 2, 10, 0, "delete")]


@pytest.mark.parametrize("where", ["replace_eras", "publish_changes"])
def test_a_batch_that_failed_is_delivered_once(spark, tmp_path, monkeypatch, where):
    flow = Flow(spark, tmp_path)
    flow.add([(1, 1, "a"), (2, 1, "a")])
    flow.run()
    flow.add([(1, 3, "b"), (3, 7, "c")])
    owner = cdc_stream if where == "replace_eras" else change_feed
    done = getattr(owner, where)

    def stop(*args, **kwargs):
        done(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(owner, where, stop)
        with pytest.raises(Exception, match="lost"):
            flow.run()
    flow.run()
    feed = change_feed.read_feed(spark, flow.feed)
    assert sorted((r.batch, r.k, r[change_feed.CHANGE]) for r in feed.filter(F.col("batch") > 0).collect()) == [
        (1, 1, "insert"), (1, 1, "update"), (1, 3, "insert")]
    assert rows_of(flow.replayed()) == rows_of(flow.table())


def test_a_feed_of_a_table_that_was_there_before(spark, tmp_path):
    flow = Flow(spark, tmp_path, feed=False)
    flow.add([(k, s, "ab"[s % 2]) for k in range(4) for s in range(0, 12, 3)])
    flow.run()
    flow.on = True
    flow.add([(1, 11, "z")])
    flow.run()
    assert rows_of(flow.replayed()) == rows_of(flow.table())
