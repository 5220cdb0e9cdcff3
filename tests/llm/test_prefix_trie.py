"""op13 against a plain trie."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from layerflow.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, place int, digest string, words int, block int, key string"


def _digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def _plain(rows, family=20, heads=4):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, _digest(role or "", text or ""), role or "", text or ""))
    convs = {c: [(r, t) for _, _, _, r, t in sorted(v)] for c, v in convs.items()}
    full = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        full[c] = convs.get(base, [])[:h] + convs[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[tuple(full[c][:d])].append(c)
        ends[tuple(full[c])].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for k in range(len(node) + 1):
            leaves[node[:k]] += not children.get(node)
            saved[node[:k]] += (len(own) - 1) * words
    return sorted((
        own[0], len(node), members[node[:-1]][0] if node else None, len(own), children.get(node, 0), leaves[node], saved[node],
        hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest()) for node, own in members.items())


def _same(got, want):
    key = lambda r: tuple(-1 << 70 if v is None else v for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def _table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], SCHEMA)


def test_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    _same(pt.trie(rows).collect(), _plain([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]))


def _odd_rows():
    rnd = random.Random(4)
    rows = []
    for c in [*range(-45, 130), 10 ** 18, 10 ** 18 + 7]:
        for _ in range(rnd.choice([1, 1, 2, 3, 4, 9])):
            rows.append((c, rnd.choice([None, 0, 1, 1, 2, 3]), rnd.choice(["u", "a", None, ""]), rnd.choice(["x", "y z", None, "", " \t", "漢字 😀", "w " * 300])))
    rows += rows[:40] + [(None, 1, "u", "x")] * 5 + [(400, None, None, None)] * 6
    return rows


def test_odd_rows(spark):
    rows = _odd_rows()
    _same(pt.trie(_table(spark, rows).repartition(5)).collect(), _plain(rows))
    assert pt.trie(_table(spark, rows).limit(0)).count() == 0
    _same(pt.trie(_table(spark, [(None, 1, "u", "x"), (21, 1, "u", "x")])).collect(), _plain([(21, 1, "u", "x")]))


def test_long_conversations_hot_beginnings_and_small_shards(spark):
    """Blocks of four turns, shards of three blocks: conversations over many blocks, a third of all rows in one of them, a
    beginning that most share, and conversations that end where a block does."""
    rnd = random.Random(9)
    rows = [(20, i, "u", rnd.choice("ab")) for i in range(400)]
    first = [(r[1], "u", r[3]) for r in rows]
    for c in range(21, 110):
        n = rnd.choice([1, 3, 4, 5, 8, 12, 16, 17, 40])
        rows += [(c, *t) for t in first[:n]]
        rows += [(c, 1000 + i, "a", rnd.choice("cd")) for i in range(rnd.choice([0, 0, 1, 4]))]
    rows += [(c, i, "u", "same") for c in range(200, 240) for i in range(8)]
    table = _table(spark, rows)
    want = _plain(rows)
    _same(pt.trie(table, size=4, shard_blocks=3, shard_turns=10).collect(), want)
    _same(pt.trie(table, size=1, shard_blocks=50, shard_turns=10 ** 6).collect(), want)
    _same(pt.trie(table).collect(), want)


def test_places_do_not_need_whole_conversations(spark):
    rows = [(7, None, "u", "same")] * 3000 + [(8, i % 3, "u", str(i % 5)) for i in range(200)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = pt.placed(pt.turns_of(_table(spark, rows).repartition(4)))
        per_task = [r["n"] for r in got.withColumn("f", pt.F.input_file_name()).filter("conv_id = 7").groupBy("f").agg(pt.F.count("*").alias("n")).collect()]
        assert len(per_task) > 2 and max(per_task) < 2000
        for c, n in ((7, 3000), (8, 200)):
            assert sorted(r.place for r in got.filter(f"conv_id = {c}").collect()) == list(range(1, n + 1))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize("seed", range(3))
def test_a_shard_alone(seed):
    """Children, popcounts and ends of one shard, without Spark."""
    rnd = random.Random(seed)
    blocks = [(c, 0, b"", None, False, [(bytes([rnd.randrange(2)]), 1) for _ in range(rnd.randrange(6))]) for c in rnd.sample(range(1000), 60)]
    got = [dict(zip(pt._ARROW.names, r)) for r in pt.shard_nodes(blocks)]
    paths = defaultdict(list)
    for c, *_, turns in blocks:
        for d in range(len(turns) + 1):
            paths[tuple(t for t, _ in turns[:d])].append((c, d == len(turns)))
    assert sorted((r["depth"], r["conv_id"], r["n_convs"]) for r in got) == sorted((len(p), min(m)[0], len(m)) for p, m in paths.items())
    ends = {tuple(sorted(c for c, last in m if last)) for m in paths.values()}
    assert {tuple(sorted(r["ends"])) for r in got if r["edge"]} <= ends
    digests = {hashlib.sha256(",".join(map(str, e)).encode()).hexdigest() for e in ends}
    assert {r["ends_sha256"] for r in got if not r["edge"]} <= digests
    edges = {r["key"] for r in got if r["edge"]}
    assert b"" in edges and all(r["parent"] in edges for r in got if r["under_edge"]) and all(r["parent"] in edges or not r["depth"] for r in got if r["edge"])
