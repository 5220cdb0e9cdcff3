"""What a micro-batch of the silver stream recomputes: the versions around its rows, and no other rows of their keys."""

import random

from pyspark.sql import functions as F

from layerflow.operators import cdc
from layerflow.streaming import cdc_stream

SCHEMA = "k int, s int, v string, note string"


def versions(df):
    return sorted(map(repr, df.select("k", "s", "v", "note", cdc.START_AT, cdc.END_AT).collect()))


class Flow:
    def __init__(self, spark, root, **options):
        self.spark, self.options = spark, {"track": ["v"], "era_width": 10, **options}
        self.bronze, self.silver, self.ck = (f"{root}/{x}" for x in ("bronze", "silver", "ck"))

    def add(self, rows):
        df = self.spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
        df.coalesce(1).write.mode("append").parquet(self.bronze)

    def run(self, **more):
        cdc_stream.apply_changes(
            self.spark, self.bronze, self.silver, self.ck, ["k"], "s", buckets=2, **{**self.options, **more})
        return versions(cdc_stream.read_silver(self.spark, self.silver))

    def plain(self):
        return versions(cdc.scd2_from_changes(self.spark.read.schema(SCHEMA).parquet(self.bronze), ["k"], "s", track=["v"]))


def random_rows(rng, n, keys):
    """Few sequence values and fewer tracked ones: ties, merges and splits of versions in every key."""
    return [(rng.choice([None, *range(keys)]), rng.randrange(40), rng.choice("abc"), f"{rng.random():.6f}") for _ in range(n)]


def test_random_late_rows_equal_the_plain_plan(spark, tmp_path):
    rng, flow = random.Random(5), Flow(spark, tmp_path)
    for n in (600, 250, 60):
        flow.add(random_rows(rng, n, 150))
        assert flow.run() == flow.plain()
    for _ in range(3):  # several micro-batches in one run: later ones find rows of theirs applied already
        flow.add(random_rows(rng, 80, 150))
    assert flow.run(max_files_per_trigger=1) == flow.plain()


def test_a_late_row_reads_its_version_only_and_leaves_later_eras(spark, tmp_path):
    """A key with most of the rows: after a run, all bronze rows of it but those of one version are taken away. A
    row that falls into that version, one between two versions, one at the end and one before all still give the right history."""
    flow = Flow(spark, tmp_path)
    # Versions of ten rows each: a at 0..18, b at 20..38, c at 40..58, and so on.
    rows = [(1, 2 * i, "abc"[i // 10 % 3], f"n{i:03}") for i in range(100)] + [(2, i, "x", "") for i in range(5)]
    flow.add(rows)
    assert flow.run() == flow.plain()
    late = [(1, 45, "z", "into c"), (1, 99, "z", "between two"), (1, 300, "z", "at the end"), (1, -5, "z", "before all")]
    full = spark.createDataFrame(rows + late, SCHEMA)
    want = versions(cdc.scd2_from_changes(full, ["k"], "s", track=["v"]))
    places = lambda: {p.parent: p.stat().st_mtime_ns for p in (tmp_path / "silver").glob("*/*/part-*")}
    before = places()
    kept = [r for r in rows if r[0] == 1 and 40 <= r[1] <= 58]
    spark.createDataFrame(kept + late, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    real, cdc_stream.read_table = cdc_stream.read_table, lambda *a, **k: left
    try:
        flow.add(late)
        assert flow.run() == want
    finally:
        cdc_stream.read_table = real
    after = places()
    same = {p for p in before if after.get(p) == before[p]}
    bucket = next(p.parent for p in before if p.name.endswith("era=14"))
    # The versions that end at 140, 160 and 180 are not touched; the one that ends at 40 shares its era with new ends.
    assert sorted(int(p.name.partition("=")[2]) for p in same if p.parent == bucket) == [14, 16, 18]


def test_rows_behind_an_open_version_read_no_bronze(spark, tmp_path, monkeypatch):
    flow = Flow(spark, tmp_path)
    flow.add([(1, i, "a", f"n{i}") for i in range(50)])
    flow.run()
    def refuse(*_):
        raise AssertionError("bronze rows are read again")

    monkeypatch.setattr(cdc_stream, "_rows_of_versions", refuse)
    flow.add([(1, 50, "a", "same"), (1, 51, "b", "other"), (3, 7, "c", "new key")])
    assert flow.run() == flow.plain()


def test_segments_and_eras_without_width(spark, tmp_path):
    rng, flow = random.Random(9), Flow(spark, tmp_path, era_width=None, segments=4)
    for _ in range(2):
        flow.add(random_rows(rng, 120, 20))
        assert flow.run() == flow.plain()


def test_versions_near_points(spark):
    stored = spark.createDataFrame(
        [(1, 3, 0, 10), (1, 15, 10, 20), (1, 29, 20, 30), (1, 34, 30, 40), (1, 45, 40, None)],
        f"k int, s int, {cdc.START_AT} int, {cdc.END_AT} int")

    def near(*points):
        found = cdc_stream.versions_near(stored, spark.createDataFrame([(1, p) for p in points], "k int, s int"), ["k"], "s")
        return {r["__at"]: (r["__split"], r["__until"]) for r in found.filter("__version = 1").collect()}

    assert near(5) == {0: (False, 20), 10: (False, 20)}  # behind the first version's rows: it and the next
    assert near(12) == {10: (True, 30), 20: (False, 30)}  # into a version: it and the next
    assert near(20) == {10: (False, 40), 20: (True, 40), 30: (False, 40)}  # on a start: also the version before
    assert near(-1) == {0: (False, 10)}
    assert near(50) == {40: (False, None)}
    assert near(2, 50) == {0: (True, 20), 10: (False, 20), 40: (False, None)}


def test_rows_of_versions_are_found_in_order_of_time(spark):
    """One key with many versions and rows in one era, a NULL key, ranges over several eras: the rows are those between
    start and last row, and no join compares times (every row with every version of its key)."""
    rows = [(0, k, i) for k in (1, None) for i in range(600)] + [(1, 2, 5)]
    ranges = [(0, k, i, i + 2, i + 4) for k in (1, None) for i in range(0, 500, 4)] + [(0, 1, 500, 590, None), (0, 3, 1, 9, 10)]
    got = cdc_stream._rows_of_versions(
        spark.createDataFrame(rows, "b int, k int, s long"),
        spark.createDataFrame(ranges, "b int, k int, __from long, __to long, __until long"), ["b", "k"], "s", 100.0)
    want = [(b, k, s, until) for b, k, s in rows for rb, rk, least, most, until in ranges if (b, k) == (rb, rk) and least <= s <= most]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and len(want) > 800
    assert got.columns == ["b", "k", "s", "__until"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and (" <= " in line or " >= " in line)]
