"""op4 and op10 against brute force."""

import hashlib
import random
import re

import numpy as np
import xxhash

from layerflow.llm import simhash, substring_dedup as sub

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _plain_fingerprint(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _roots(n, links):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def _components(fps, distance):
    f = np.array(fps, np.uint64)
    near = np.argwhere(np.bitwise_count(f[:, None] ^ f[None, :]) <= distance)
    return _roots(len(f), [(i, j) for i, j in near.tolist() if i < j])


def _check(docs, rows):
    got = {}
    for r in simhash.near_duplicates(docs).collect():
        got.setdefault((r.doc_id, r.fingerprint), []).append(r.component_id)
    fps = [_plain_fingerprint(t) for _, t in rows]
    roots = _components(fps, 4)
    least = {}
    for (i, _), root in zip(rows, roots):
        if i is not None:
            least[root] = min(least.get(root, i), i)
    want = {}
    for (i, _), fp, root in zip(rows, fps, roots):
        want.setdefault((i, f"{fp:016x}"), []).append(least.get(root))
    assert {k: sorted(map(repr, v)) for k, v in got.items()} == {k: sorted(map(repr, v)) for k, v in want.items()}


def test_simhash_on_documents_and_odd_rows(documents, odd, odd_rows, none):
    _check(documents, [(r.doc_id, r.text) for r in documents.collect()])
    _check(odd, [(r[0], r[1]) for r in odd_rows])
    assert simhash.near_duplicates(none).count() == 0


def test_anchors_cover(spark):
    """Every pair within the distance meets in a cell, at every split of the bits between the parts."""
    rnd = np.random.default_rng(1)
    words = rnd.integers(0, 1 << 31, 4000, dtype=np.uint64)
    assert (simhash.syndrome(simhash.home(words)) == 0).all()
    assert (np.bitwise_count(simhash.home(words) ^ words) <= 1).all()
    for distance in (1, 4, 5):
        base = rnd.integers(0, 1 << 63, 1500, dtype=np.uint64)
        flips = np.array([sum(1 << int(b) for b in rnd.choice(64, distance, replace=False)) for _ in base], np.uint64)
        both = np.concatenate([base, base ^ flips]).view(np.int64).tolist()
        df = spark.createDataFrame([(x,) for x in both], "fp long").repartition(4)
        found = {frozenset((r.a, r.b)) for r in simhash.links_in_cells(simhash.replicas(df, distance), distance).collect()}
        assert all(frozenset(p) in found for p in zip(both, both[1500:]))


def test_a_cell_of_many_near_copies_stays_a_forest():
    rnd = np.random.default_rng(2)
    one = np.uint64(1)
    fp = np.unique(np.concatenate([
        np.uint64(0x1234567890ABCDEF) ^ (one << rnd.integers(0, 64, 3000, dtype=np.uint64)) ^ (one << rnd.integers(0, 64, 3000, dtype=np.uint64)),
        rnd.integers(0, 1 << 63, 40, dtype=np.uint64)]))
    links = simhash.cell_links(fp, 4)
    assert len(links) < len(fp)
    assert _roots(len(fp), links) == _components(fp, 4)


def test_one_of_each_stays(odd, odd_rows, none):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and simhash.one_of_each(none).count() == 0
    found = [(r.doc_id, r.text) for r in kept.collect()]
    fps = [_plain_fingerprint(t) for _, t in found]
    roots = _components(fps, 4)
    assert len(set(roots)) == len(roots)
    every = _components([_plain_fingerprint(r[1]) for r in odd_rows], 4)
    assert len(found) == len(set(every))
    assert 6 in {i for i, _ in found} and 7 not in {i for i, _ in found} and 14 not in {i for i, _ in found}


# ---------------------------------------------------------------- substrings

def _plain_removal(rows, length):
    """{(id, text): (kept words, removed)} of distinct rows in order, by sets of windows."""
    seen, out = set(), {}
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for a in range(len(words) - length + 1):
            window = tuple(words[a:a + length])
            if window in seen:
                gone[a:a + length] = [True] * length
            seen.add(window)
        out[i, text] = [w for w, g in zip(words, gone) if not g], sum(gone)
    return out


def _order(rows, spark):
    """Distinct (id, text), in the operator's order."""
    keyed = sub.identified(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", "doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in sorted({(r.d, r.t, r.doc_id, r.text): r for r in keyed}.values(), key=lambda r: (r.d, r.t))]


def _check_substrings(spark, docs, rows, length, k):
    want = _plain_removal(_order(rows, spark), length)
    got = sorted(map(repr, map(tuple, sub.substring_digest(docs, length, k).collect())))
    exp = [(i, len(WORD.findall(t or "")), want[i, t][1], hashlib.sha256(" ".join(want[i, t][0]).encode()).hexdigest()) for i, t in rows]
    assert got == sorted(map(repr, exp))


def test_substrings_of_odd_rows(spark, odd, odd_rows, none):
    _check_substrings(spark, odd, [(r[0], r[1]) for r in odd_rows], 20, 8)
    assert sub.substring_digest(none).count() == 0


def test_substrings_of_few_words_and_many_repeats(spark):
    """Texts over a tiny vocabulary: anchors of many contexts, repeats inside a document, overlaps of all kinds."""
    rnd = random.Random(4)
    phrase = [rnd.choice("abc") for _ in range(40)]
    rows = []
    for i in range(220):
        words = [rnd.choice("abcdefghij") for _ in range(rnd.randint(0, 60))]
        if i % 3 == 0:
            a = rnd.randint(0, 25)
            words[10:10] = phrase[a:a + rnd.randint(5, 40)]
        rows.append((i // 2 if i < 20 else i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for length, k in ((6, 2), (20, 8), (5, 5), (12, 1)):
        _check_substrings(spark, docs, rows, length, k)


def test_anchors_of_many_contexts_are_dealt_by_context(spark):
    """One short line in changing surroundings: more contexts of an anchor than a task takes together."""
    rnd = random.Random(5)
    line = " ".join(f"common{i}" for i in range(9))
    word = lambda: "".join(rnd.choice("klmnopq") for _ in range(4))
    rows = []
    for i in range(120):
        before, after = [word() for _ in range(15)], [word() for _ in range(15)]
        rows.append((i, " ".join([*before, line, *after])))
        if i % 10 == 0:  # a copy of the line with its surroundings
            rows.append((1000 + i, " ".join([word(), *before, line, *after, word()])))
    assert len(rows) > 4 * sub._MANY
    _check_substrings(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(2), rows, 20, 8)


def test_without_repeats_keeps_columns(spark, odd, odd_rows, none):
    got = sub.without_repeats(odd, chars_col="n_chars")
    assert got.columns == odd.columns and sub.without_repeats(none).count() == 0
    want = _plain_removal(_order([(r[0], r[1]) for r in odd_rows], spark), 20)
    exp = []
    for i, t, *_ in odd_rows:
        kept, gone = want[i, t]
        if not gone:
            exp.append((i, t, None if t is None else len(t)))
        elif kept:
            exp.append((i, " ".join(kept), len(" ".join(kept))))
    assert sorted(map(repr, ((r.doc_id, r.text, r.n_chars) for r in got.collect()))) == sorted(map(repr, exp))


def test_run_hashes_and_winnowing():
    rnd = np.random.default_rng(1)
    words = rnd.integers(0, 3, 200).astype(np.uint64)
    for k in (1, 2, 5, 13, 20):
        by_run = {}
        for i, h in enumerate(sub.runs(words, k)):
            by_run.setdefault(tuple(words[i:i + k]), set()).add(int(h))
        assert all(len(v) == 1 for v in by_run.values()) and len(set.union(*by_run.values())) == len(by_run)
    for width in (1, 2, 3, 13, 16):
        plain = [max(j for j in range(i, i + width) if words[j] == words[i:i + width].min()) for i in range(len(words) - width + 1)]
        assert sub.anchors(words, width).tolist() == plain
