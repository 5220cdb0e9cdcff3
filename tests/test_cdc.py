"""Contract of SCD1/SCD2 from change feeds, plus a brute-force comparison."""

import datetime as dt
import random

import pytest

from layerflow.operators import cdc, dedup


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def brute_scd2(rows, track_idx):
    """Versions of (key, seq, *values) rows, unique (key, seq), by direct iteration."""
    out = []
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for k, rs in by_key.items():
        rs.sort(key=lambda r: r[1])
        versions = []
        for r in rs:
            t = tuple(r[i] for i in track_idx)
            if versions and versions[-1]["t"] == t:
                versions[-1]["last"] = r
            else:
                versions.append({"t": t, "start": r[1], "last": r})
        for i, v in enumerate(versions):
            end = versions[i + 1]["start"] if i + 1 < len(versions) else None
            out.append((*v["last"], v["start"], end))
    return sorted(out, key=repr)


def test_a_b_a_and_untracked_last_value(spark):
    df = spark.createDataFrame(
        [(1, 1, "A", 10.0), (1, 2, "A", 11.0), (1, 3, "B", 12.0), (1, 4, "A", 13.0), (2, 5, "X", 1.0)],
        "k int, seq int, status string, v double",
    )
    got = rows_of(cdc.scd2_from_changes(df, ["k"], "seq", track=["status"]), "k", "seq", "status", "v", "__START_AT", "__END_AT")
    assert got == sorted([
        (1, 2, "A", 11.0, 1, 3), (1, 3, "B", 12.0, 3, 4), (1, 4, "A", 13.0, 4, None), (2, 5, "X", 1.0, 5, None),
    ], key=repr)


def test_equal_consecutive_rows_do_not_open_versions(spark):
    df = spark.createDataFrame([(1, 1, "A"), (1, 2, "A"), (1, 3, "A")], "k int, seq int, s string")
    got = rows_of(cdc.scd2_from_changes(df, ["k"], "seq"), "seq", "__START_AT", "__END_AT")
    assert got == [(3, 1, None)]


def test_null_key_is_one_group_and_null_tracked_value_compares(spark):
    df = spark.createDataFrame(
        [(None, 1, None), (None, 2, None), (None, 3, "B"), (None, 4, None)], "k int, seq int, s string"
    )
    got = rows_of(cdc.scd2_from_changes(df, ["k"], "seq"), "k", "s", "__START_AT", "__END_AT")
    assert got == sorted([(None, None, 1, 3), (None, "B", 3, 4), (None, None, 4, None)], key=repr)


def test_null_sequence_goes_to_quarantine(spark):
    df = spark.createDataFrame([(1, None, "A"), (1, 2, "B")], "k int, seq int, s string")
    assert cdc.scd2_from_changes(df, ["k"], "seq").count() == 1
    assert cdc.null_sequence_rows(df, "seq").count() == 1
    assert cdc.scd1_from_changes(df, ["k"], "seq").collect()[0]["s"] == "B"


def test_exact_ties_keep_greatest_remaining_columns(spark):
    df = spark.createDataFrame([(1, 5, "A", 1), (1, 5, "B", 2), (1, 5, "A", 3)], "k int, seq int, s string, n int")
    assert rows_of(cdc.scd1_from_changes(df, ["k"], "seq"), "s", "n") == [("B", 2)]
    assert rows_of(cdc.scd2_from_changes(df, ["k"], "seq", track=["s"]), "s", "n", "__END_AT") == [("B", 2, None)]


def test_composite_sequence_collapses_same_first_value(spark):
    d = dt.datetime
    df = spark.createDataFrame(
        [(1, d(2020, 1, 1), 10, "O"), (1, d(2020, 1, 1), 11, "F"), (1, d(2020, 1, 2), 12, "F"), (1, d(2020, 1, 3), 13, "O")],
        "k int, day timestamp, n int, s string",
    )
    got = rows_of(cdc.scd2_from_changes(df, ["k"], ["day", "n"], track=["s"]), "n", "s", "__START_AT", "__END_AT")
    assert got == sorted([(12, "F", d(2020, 1, 1), d(2020, 1, 3)), (13, "O", d(2020, 1, 3), None)], key=repr)


def test_except_list_and_map_rejection(spark):
    df = spark.createDataFrame([(1, 1, "A", {"a": 1})], "k int, seq int, s string, m map<string,int>")
    with pytest.raises(ValueError):
        cdc.scd2_from_changes(df, ["k"], "seq")
    assert cdc.scd2_from_changes(df, ["k"], "seq", track_except=["m"]).count() == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for k in range(12):
        seqs = rnd.sample(range(1000), rnd.randint(1, 40))
        for s in seqs:
            rows.append((k if k else None, s, rnd.choice("ABC"), rnd.choice([None, "x", "y"]), rnd.random()))
    df = spark.createDataFrame(rows, "k int, seq int, a string, b string, v double")
    got = rows_of(cdc.scd2_from_changes(df, ["k"], "seq", track=["a", "b"]), "k", "seq", "a", "b", "v", "__START_AT", "__END_AT")
    assert got == brute_scd2(rows, [2, 3])


def test_first_and_latest_per_key(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, None, "n"), (2, 2, "b")], "k int, o int, x string")
    assert rows_of(dedup.first_per_key(df, ["k"], ["o"]), "k", "x") == [(1, "n"), (2, "b")]
    assert rows_of(dedup.latest_per_key(df, ["k"], ["o"]), "k", "x") == [(1, "c"), (2, "b")]
    assert rows_of(dedup.first_per_key(df, ["k"], [("o", "desc")]), "k", "x") == [(1, "c"), (2, "b")]
    with pytest.raises(ValueError):
        dedup.first_per_key(df, ["k"], [("o", "down")])


@pytest.mark.parametrize("seed,bounds", [(4, [100.0, 500.0, 900.0]), (5, [float(b) for b in range(10, 1000, 25)]), (6, [])])
def test_segmented_matches_brute_force(spark, seed, bounds):
    from layerflow.operators.segmented import scd2_from_changes_segmented

    rnd = random.Random(seed)
    rows = []
    for k in range(6):
        n = 300 if k == 0 else rnd.randint(1, 30)  # key 0 is hot
        for s in rnd.sample(range(1000), n):
            rows.append((k if k != 3 else None, s, rnd.choice("AB" if k == 0 else "ABC"), rnd.random()))
    df = spark.createDataFrame(rows, "k int, seq int, a string, v double")
    got = rows_of(scd2_from_changes_segmented(df, ["k"], "seq", track=["a"], bounds=bounds),
                  "k", "seq", "a", "v", "__START_AT", "__END_AT")
    assert got == brute_scd2(rows, [2])


def test_segmented_same_instant_and_long_island(spark):
    from layerflow.operators.segmented import scd2_from_changes_segmented

    # one version spanning every range, and ties on the first sequence column
    rows = [(1, s, "A", s) for s in range(0, 100)] + [(1, 50, "B", -1), (1, 100, "B", 0)]
    df = spark.createDataFrame(rows, "k int, seq int, a string, n int")
    plain = rows_of(cdc.scd2_from_changes(df, ["k"], "seq", track=["a"]), "seq", "a", "n", "__START_AT", "__END_AT")
    seg = rows_of(scd2_from_changes_segmented(df, ["k"], "seq", track=["a"], bounds=[10.0, 20.0, 50.0, 51.0, 99.0]),
                  "seq", "a", "n", "__START_AT", "__END_AT")
    assert seg == plain
