"""op1: targets, quotas, draws and shards."""

import math
import re
from collections import Counter

import pytest

from layerflow.llm import mixing
from layerflow.llm.mixing import Mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """The contract's words: shares by weight, targets stop at the cap, the excess shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, free, target = share * sum(sizes.values()), list(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        above = [s for s in free if unit * weight[s] > cap * sizes[s]]
        if not above:
            target |= {s: unit * weight[s] for s in free}
            break
        for s in above:
            target[s] = cap * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def _check(rows, got):
    sizes = Counter()
    for i, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = _targets(sizes)
    assert Counter((i, len(WORD.findall(t or ""))) for i, t, _ in rows) == Counter((r.doc_id, r.size) for r in got)
    assert Counter((sizes[s], round(want[s], 6)) for _, _, s in rows) == Counter((r.source_size, round(r.target, 6)) for r in got)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    return sizes, want


def test_takes_of_documents(documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    got = mixing.takes(documents).collect()
    sizes, want = _check(rows, got)
    source_of = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        taken[source_of[r.doc_id]] += r.taken
    longest = max(r.size for r in got)
    for s in sizes:  # a source of ten documents comes as near as its documents allow
        assert abs(taken[s] - want[s]) <= min(longest, 0.2 * sizes[s])
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.takes(documents.repartition(5)).collect()))


def test_takes_of_odd_rows(odd, odd_rows, none):
    _check([(r[0], r[1], r[3]) for r in odd_rows], mixing.takes(odd).collect())
    assert mixing.takes(none).count() == 0


def test_all_sources_at_their_cap(spark):
    rows = [(k, "w " * 10, s) for k, s in enumerate("ab")]
    got = mixing.takes(spark.createDataFrame(rows, "doc_id long, text string, source string"), Mix(share=2.5)).collect()
    assert [r.target for r in got] == [20.0, 20.0] and [r.taken for r in got] == [20, 20]


def _exact(pop, good, taken):
    return {k: math.comb(good, k) * math.comb(pop - good, taken - k) / math.comb(pop, taken)
            for k in range(max(0, taken - pop + good), min(good, taken) + 1)}


@pytest.mark.parametrize("pop,good,taken", [(10, 4, 5), (50, 1, 25), (7, 7, 3), (200, 120, 100), (1, 0, 1), (30, 15, 0)])
def test_hypergeometric_draws(spark, pop, good, taken):
    n = 4000
    expr = mixing.hypergeometric("p", "g", "t", "u")
    drawn = spark.range(n).selectExpr(
        f"{pop}L as p", f"{good}L as g", f"{taken}L as t", f"(id + 0.5D) / {n} as u").selectExpr(f"{expr} as k").groupBy("k").count().collect()
    exact = _exact(pop, good, taken)
    for k, c in ((r["k"], r["count"]) for r in drawn):
        assert k in exact and abs(c / n - exact[k]) < 2 / n + 1e-9


def test_splitting_tree_keeps_quotas(spark):
    counts = [100, 0, 37, 1, 262]
    for shards in (1, 2, 7, 64):
        rows = mixing.split_quotas(spark.createDataFrame([(counts,)], "counts array<bigint>"), shards, 3).collect()
        per_source, per_shard = Counter(), Counter()
        for r in rows:
            assert r.quota >= 0
            per_source[r.source_rank] += r.quota
            per_shard[r.shard] += r.quota
        assert [per_source[k] for k in range(len(counts))] == counts
        assert len(per_shard) == shards and max(per_shard.values()) - min(per_shard.values()) <= 1


def test_the_mix_holds_what_is_taken(documents, odd, none):
    for docs, mix in ((documents, Mix(shard_words=3000)), (odd, Mix())):
        mixed = mixing.mixed(docs, mix, shard_col="shard")
        assert mixed.columns == [*docs.columns, "shard"]
        want = Counter()
        for r in mixing.takes(docs, mix).collect():
            want[r.doc_id] += r.copies
        assert Counter(r.doc_id for r in mixed.collect()) == +want
    assert mixing.mixed(none).count() == 0
    first = mixing.mixed(documents, Mix(shard_words=3000)).select("doc_id").collect()
    assert first == mixing.mixed(documents, Mix(shard_words=3000)).select("doc_id").collect()
    assert [r.doc_id for r in first] != sorted(r.doc_id for r in first)


def test_takes_are_what_the_tree_deals(documents, odd):
    for docs, mix in ((documents, Mix(shard_words=3000)), (odd, Mix(least_blocks=8, shard_words=2000))):
        got = mixing.takes(docs, mix).collect()
        assert all(r.copies == len(r.dealt) and r.taken == r.size * r.copies for r in got)
        dealt = sorted((d.shard, d.order, r.doc_id or 0) for r in got for d in r.dealt)
        mixed = mixing.mixed(docs, mix, shard_col="shard")
        by_shard = {}
        for r in mixed.collect():
            by_shard.setdefault(r.shard, []).append(r.doc_id or 0)
        assert len(by_shard) > 2
        assert [(s, i) for s, _, i in dealt] == [(s, i) for s in sorted(by_shard) for i in by_shard[s]]


def test_taken_is_counted_from_the_dealt_blocks(documents, monkeypatch):
    deal = mixing.block_shards
    monkeypatch.setattr(mixing, "block_shards", lambda *args: deal(*args).filter("block % 2 = 0"))
    got = mixing.takes(documents).collect()
    taken = sum(r.taken for r in got)
    monkeypatch.undo()
    assert 0 < taken < sum(r.taken for r in mixing.takes(documents).collect())


@pytest.mark.parametrize("part", [3, 5, 11])
def test_one_dominant_document_leaves_no_gap(spark, part):
    """40 sources, each of 400 documents and one that holds 1/part of all words; half of the words are wanted."""
    small = [1 + k * 7 % 40 for k in range(400)]
    large = round(sum(small) / (part - 1))
    rows = [(k, f"s{s:02}", hash((s, k)), n) for s in range(40) for k, n in enumerate([*small, large])]
    sized = spark.createDataFrame(rows, "doc_id long, source_key string, place long, size long")
    taken, target = Counter(), {}
    for r in mixing.blocks(sized, Mix(weights=(1,), share=0.5), 1024).collect():
        assert r.copies in (0, 1)
        taken[r.source_key] += r.words * r.copies
        target[r.source_key] = r.target
    assert len(target) == 40 and all(abs(taken[s] - target[s]) <= 0.005 * (sum(small) + large) for s in target)
