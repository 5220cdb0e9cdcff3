"""Snapshot flows: diff and stacked forms against each other and the contract."""

import random

from layerflow import history
from layerflow.operators import snapshot

COLS = ("k", "s", "v", "__START_AT", "__END_AT")
SCHEMA = "k int, s string, v int"


def rows_of(df, cols=COLS):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def diff_history(spark, snaps):
    hist = None
    for version, rows in snaps:
        hist = snapshot.apply_snapshot(hist, spark.createDataFrame(rows, SCHEMA), version, ["k"], track=["s"])
        hist = spark.createDataFrame(hist.collect(), hist.schema)  # small test data: cut the plan
    return hist


def stacked_history(spark, snaps):
    rows = [(*r, v) for v, rs in snaps for r in rs]
    df = spark.createDataFrame(rows, SCHEMA + ", ver int")
    return snapshot.scd2_from_snapshots(df, ["k"], "ver", track=["s"])


def test_absent_key_closes_and_returns_as_new_version(spark):
    snaps = [(1, [(1, "A", 1), (2, "A", 1)]), (2, [(2, "A", 2)]), (3, [(1, "A", 3), (2, "B", 3)])]
    expected = sorted([
        (1, "A", 1, 1, 2), (1, "A", 3, 3, None), (2, "A", 2, 1, 3), (2, "B", 3, 3, None),
    ], key=repr)
    assert rows_of(diff_history(spark, snaps)) == expected
    assert rows_of(stacked_history(spark, snaps)) == expected


def test_replayed_version_is_a_no_op(spark):
    first = snapshot.apply_snapshot(None, spark.createDataFrame([(1, "A", 1)], SCHEMA), 5, ["k"])
    first = spark.createDataFrame(first.collect(), first.schema)
    again = snapshot.apply_snapshot(first, spark.createDataFrame([(1, "B", 1)], SCHEMA), 5, ["k"], skip_applied=True)
    assert rows_of(again) == rows_of(first)


def test_null_key_is_matched_null_safely(spark):
    snaps = [(1, [(None, "A", 1)]), (2, [(None, "A", 2)])]
    assert rows_of(diff_history(spark, snaps)) == [(None, "A", 2, 1, None)]


def test_scd1_is_the_newest_snapshot(spark):
    snap = spark.createDataFrame([(1, "A", 1)], SCHEMA)
    assert snapshot.apply_snapshot(None, snap, 1, ["k"], scd_type=1) is snap


def test_diff_equals_stacked_on_random_snapshots(spark):
    rnd = random.Random(7)
    snaps = []
    for version in range(1, 7):
        rows = [(k, rnd.choice("AB"), rnd.randint(0, 3)) for k in range(15) if rnd.random() < 0.7]
        snaps.append((version, rows))
    assert rows_of(diff_history(spark, snaps)) == rows_of(stacked_history(spark, snaps))


def test_changes_of_a_run_are_written_once(spark, tmp_path, monkeypatch):
    """The staged rows become the run's folders: no second write of them; runs that close all rows or none have both."""
    store = history.SnapshotStore(spark, str(tmp_path / "h"))
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    store.apply(rows((1, "a"), (2, "b"), (None, "c")), 1, ["k"])
    monkeypatch.setattr(history.SnapshotStore, "add", None)
    store.apply(rows((1, "a"), (2, "x"), (None, "c")), 2, ["k"])
    store.apply(rows((1, "a"), (2, "x"), (None, "c")), 3, ["k"])
    store.apply(rows().limit(0), 4, ["k"])
    assert store.open_rows().count() == 0 and not list((tmp_path / "h" / "stage").iterdir())
    got = sorted((tuple(r) for r in store.read().select("k", "v", "__START_AT", "__END_AT").collect()), key=str)
    assert got == sorted([(1, "a", 1, 4), (2, "b", 1, 2), (2, "x", 2, 4), (None, "c", 1, 4)], key=str)
