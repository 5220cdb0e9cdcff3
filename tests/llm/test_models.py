"""op5, op6 and op8: statistics against plain Python, models by held-out accuracy and odd rows."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerflow.llm import language_id, quality_gam, quality_rules
from layerflow.llm.common import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.01"


def _base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def _check_rules(rows, got):
    want = collections.Counter()
    for i, text in rows:
        b = _base(text)
        want[i, *b, b[0] < 50 or 100 * b[4] > 50 * b[0]] += 1
    assert collections.Counter((r.doc_id, *(r[c] for c in quality_rules.COUNTS), r.base_failed) for r in got) == want
    assert all(not r.kept or not r.base_failed for r in got)


def test_rules_on_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.quality_rules(docs, labels).collect()
    _check_rules([(r.doc_id, r.text) for r in docs.collect()], got)
    known = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(known[r.doc_id], r.kept) for r in got if r.doc_id in known and not r.base_failed]
    assert sum(kept for q, kept in judged if q) / sum(q for q, _ in judged) > 0.99
    assert sum(not kept for q, kept in judged if not q) / sum(not q for q, _ in judged) > 0.9


def test_rules_on_odd_rows(odd, odd_rows, none, labels):
    _check_rules([(r[0], r[1]) for r in odd_rows], quality_rules.quality_rules(odd, labels).collect())
    assert quality_rules.quality_rules(none, labels).count() == 0
    no_labels = labels.filter("false")
    assert all(r.kept != r.base_failed for r in quality_rules.quality_rules(odd, no_labels).collect())


def test_rules_find_planted_conjunctions(spark):
    """Two kinds of bad rows, each a conjunction of two thresholds, and noise: the list finds both, in few conditions."""
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(3000):
        x = {f: rnd.random() for f in quality_rules.FEATURES}
        bad = (x["word_length"] > 0.7 and x["digit_share"] > 0.6) or (x["capital_share"] <= 0.2 and x["shout_share"] > 0.75)
        rows.append((i, 100, 0, *x.values()))
        labels.append((i, int(not bad)))
    known = spark.createDataFrame(rows, ["doc_id", "n_words", "n_repeat_words", *quality_rules.FEATURES])
    rules = quality_rules.learn_rules(known, spark.createDataFrame(labels, ["doc_id", "quality"]))
    found = known.withColumn("rule", quality_rules.verdict(rules)).collect()
    wrong = sum((r.rule is not None) != (labels[r.doc_id][1] == 0) for r in found)
    assert wrong / len(rows) < 0.05
    assert {"digit_share", "shout_share"} <= {c.feature for rule in rules for c in rule}


# ---------------------------------------------------------------- language

def test_phrases_are_the_longest_matches():
    rnd = random.Random(1)
    for _ in range(60):
        text = "".join(rnd.choice("ab ") for _ in range(80))
        own = language_id.SuffixAutomaton(text)
        s = "".join(rnd.choice("abc ") for _ in range(50))
        i = n = 0
        while i < len(s):
            k = 0
            while i + k < len(s) and s[i:i + k + 1] in text:
                k += 1
            i, n = i + max(1, k), n + 1
        assert own.phrases(s) == n


def test_languages_of_held_out_documents(documents):
    got = {r.doc_id: r for r in language_id.language_id(documents).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in held} == {i for i, g in got.items() if g.held_out}
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= g.score <= 1 for g in got.values())


def test_prediction_is_blind_to_other_columns(documents):
    learned = language_id.learn(documents)
    blind = documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    one = sorted(map(tuple, language_id.predict(documents, learned, "doc_id").collect()))
    assert one == sorted(map(tuple, language_id.predict(blind, learned, "doc_id").collect()))


def test_language_of_odd_rows(odd, odd_rows, none, documents):
    learned = language_id.learn(documents)
    got = language_id.predict(odd, learned, "doc_id", "text").collect()
    for r in got:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == has_letter and (has_letter or r.score == 0)
    kept = language_id.recognised(odd, learned)
    assert kept.columns == odd.columns
    assert all(any(c.isalpha() for c in r.text) for r in kept.collect())
    assert language_id.language_id(none).count() == 0
    assert {r.lang_pred for r in language_id.language_id(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert len(language_id.language_id(odd).collect()) == len(odd_rows)


def _phrases(sample, s):
    """Greedy longest-match parse by looking for substrings."""
    at = n = 0
    while at < len(s):
        k = 1
        while at + k < len(s) and s[at:at + k + 1] in sample:
            k += 1
        at, n = at + k, n + 1
    return n


def test_whole_documents_are_parsed_over_word_borders(documents, odd_rows):
    learned = language_id.learn(documents)
    own = language_id.Identifier(learned)
    texts = [r.text for r in documents.limit(60).collect()] + [r[1] for r in odd_rows]
    longer = 0
    for text in texts:
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        words = [w for t in words for w in "".join(c if c.isalpha() else " " for c in t).split()]
        s = f" {' '.join(words)} " if words else ""
        assert language_id.running(text or "") == s
        if s:
            want = [a.bits * _phrases(learned[lang], s[:3000]) for lang, a in zip(own.languages, own.automata)]
            assert own.costs(s[:3000]).tolist() == want
            longer += any(f" {x} {y} " in learned[lang] for lang in own.languages for x, y in zip(words, words[1:]))
    assert longer > 10  # phrases of several words do occur


def _invented(rnd, letters, n):
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 8))) for _ in range(120)]
    return lambda k: " ".join(rnd.choice(words) for _ in range(k))


@pytest.mark.parametrize("count", [1, 2, 4, 30])
def test_the_bound_does_not_depend_on_the_number_of_languages(spark, count):
    """Clean texts of every language stay, however many there are; letters in no order of any language go."""
    rnd = random.Random(count)
    makers = [_invented(rnd, rnd.sample("abcdefghijklmnopqrstuvwxyzäöüéèñ", 14), 0) for _ in range(count)]
    rows = [(i, makers[i % count](rnd.randint(30, 120)), f"l{i % count:02}") for i in range(60 * count)]
    junk = ["".join(rnd.choice("bcdfghjklmnpqrstvwxz") if rnd.random() < 0.85 else " " for _ in range(300)) for _ in range(30)]
    docs = spark.createDataFrame([*rows, *((-1 - i, t, None) for i, t in enumerate(junk))], "doc_id long, text string, lang string")
    learned = language_id.learn(docs)
    assert len(learned) == count
    kept = {r.doc_id for r in language_id.recognised(docs, learned).collect()}
    assert sum(i >= 0 for i in kept) >= 0.99 * len(rows)
    assert sum(i < 0 for i in kept) == 0


def test_every_labelled_row_counts(spark):
    """The learned text holds the most frequent words and pairs of all rows, though each row begins with other ones, and
    the bound is that of all rows kept apart, however many."""
    rnd = random.Random(5)
    letters = lambda k: "".join(rnd.choice("abcdefgh") for _ in range(k))
    rows = [(i, f"{letters(12)} {letters(12)} " + ("often together " if i % 3 == 0 else "") + " ".join(letters(9) for _ in range(40)), "aa")
            for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language_id.learn(docs, pieces=1, piece_chars=100, keep_apart=False)
    assert " often together " in learned["aa"] and len(learned["aa"]) <= 102
    known, _ = language_id._labelled(docs, "doc_id", "text", "lang", (4, 2))
    counts = collections.Counter(w for r in known.collect() for w in r.text.split())
    assert {r["first"] for r in language_id._most_frequent(known, 2, 250)} == {"often", "together"}
    assert counts["often"] > 1000
    own = language_id.Identifier(learned)
    rates = sorted(own.predict(r.text)[2] for r in known.filter("apart").collect())
    assert len(rates) > 1000
    bound = language_id.bounds(docs, learned, share=1.0, slack=1.0)
    assert bound == {"aa": rates[-1]}


@pytest.mark.parametrize("together,few", [(4_000_000, 64), (700, 2), (900, 10**6)])
def test_texts_parsed_together_cost_what_each_costs_alone(together, few, monkeypatch):
    """Texts of all lengths, longer ones than are parsed together too, under languages with tables and, of many
    characters, without."""
    monkeypatch.setattr(language_id, "TOGETHER", together)
    monkeypatch.setattr(language_id, "FEW", few)
    rnd = random.Random(3)
    text = lambda letters, n: " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 6))) for _ in range(n))
    learned = {"aa": f" {text('abcd', 200)} ", "bb": f" {text('cdeé', 90)} ", "cc": f" {text([chr(c) for c in range(0x4e00, 0x4f00)], 90)} "}
    own = language_id.Identifier(learned)
    assert [own.languages[i] for i in own.tabled] == ["aa", "bb"]
    texts = [text("abcdé", rnd.randint(0, 60)) for _ in range(150)] + [text("abxз一", 700), "", "q", text([chr(0x4e00 + i) for i in range(99)], 40)]
    want = [[a.bits * _phrases(learned[lang], s) for lang, a in zip(own.languages, own.automata)] for s in texts]
    assert own.all_costs(texts).tolist() == want
    assert own.predict_all([*texts, None]) == [own.predict(s) for s in [*texts, None]]
    assert language_id.Identifier({}).predict_all(["a", None]) == [("und", 0.0, None)] * 2


@pytest.mark.parametrize("held", [10, 10**6])
def test_pairs_are_handed_on_as_numbers_and_ranked_in_shares(spark, held, monkeypatch):
    """Counts are those of all texts, however few a task holds; a pair takes two numbers on its way; no task ranks all of a
    language's pairs."""
    for limit in ("HELD", "HELD_PAIRS"):
        monkeypatch.setattr(language_id, limit, held)
    rnd = random.Random(9)
    rows = [(rnd.choice(["aa", "aa", "aa", "bb"]), " ".join(rnd.choice("abcdefghij") * rnd.randint(1, 4) for _ in range(rnd.randint(0, 12))))
            for _ in range(3000)]
    known = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    words, pairs = collections.Counter(), collections.Counter()
    for lang, text in rows:
        own = [w[:3] for w in text.split()]
        words.update((lang, w, "") for w in own)
        pairs.update((lang, x, y) for x, y in zip(own, own[1:]) if {x, y} <= {"a", "bb", "ccc", "d"})
    first = lambda counts: [
        key for lang in ("aa", "bb") for key in sorted((k for k in counts if k[0] == lang), key=lambda k: (-counts[k], k))[:7]]
    vocabulary = {"aa": {"a", "bb", "ccc", "d"}, "bb": {"d", "a", "ccc", "bb"}}
    assert list(map(tuple, language_id._most_frequent(known, 7, 3))) == first(words)
    assert list(map(tuple, language_id._most_frequent(known, 7, 3, vocabulary))) == first(pairs)
    counted = language_id._pairs_counted(known, 3, {lang: sorted(own) for lang, own in vocabulary.items()})
    assert dict(counted.dtypes) == {"lang": "string", "pair": "bigint", "n": "bigint"}
    assert sum(r.n for r in counted.collect()) == sum(pairs.values())
    plan = language_id._first(counted, "pair", 7)._jdf.queryExecution().toString()
    assert re.search(r"hashpartitioning\(lang#\d+, share#\d+", plan)


# ---------------------------------------------------------------- quality

def test_gam_learns_main_effects_and_interactions():
    rng = np.random.default_rng(1)
    x = rng.random((6000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no main effect at all
    gam = quality_gam.fit(x[:4000], y[:4000])
    assert (0, 1) in gam.pairs
    p = gam.scores(x[4000:])
    assert ((p > 0.5) == y[4000:]).mean() > 0.85
    y = (x[:, 2] ** 2 + 0.1 * rng.random(6000) > 0.4).astype(float)
    p = quality_gam.fit(x[:4000], y[:4000], pair_rounds=0).scores(x[4000:])
    assert ((p > 0.5) == y[4000:]).mean() > 0.93


def test_quality_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality_gam.quality_scores(docs, labels).collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    held = [(known[i], r.score) for i, r in got.items() if i in known and r.held_out]
    assert {i for i, r in got.items() if r.held_out} == {i for i in got if zlib.crc32(str(i).encode()) % 5 == 0}
    good, bad = ([s for q, s in held if q == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_quality_of_odd_rows(odd, odd_rows, none, labels):
    got = quality_gam.quality_scores(odd, labels).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in odd_rows)
    assert quality_gam.quality_scores(none, labels).count() == 0
    one_kind = quality_gam.quality_scores(odd, labels.filter("quality = 1")).collect()
    assert len({r.score for r in one_kind}) == 1 and one_kind[0].score > 0.5
    assert {r.score for r in quality_gam.quality_scores(odd, labels.filter("false")).collect()} == {0.5}


def test_a_frequent_id_does_not_widen_the_sample(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(quality_gam, "fit", lambda x, y, weight=None, **_: seen.update(x=x, y=y, weight=weight))
    width = len(quality_gam.FEATURES)
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)], "doc_id long, quality int")
    copies = [(1, [1.0] * width)] * 2000
    others = [(k, [float(k)] * width) for k in range(2, 50)]
    texts = [(3, [float(k), *[0.0] * (width - 1)]) for k in range(100, 2100)]
    for rows, most in ((copies + others, 49), (texts + others, 200)):
        quality_gam.learn(
            spark.createDataFrame(rows, "doc_id long, x array<double>"), labels, sample_rows=100, held_out=(5, 9))
        assert 0 < len(seen["x"]) <= most
    quality_gam.learn(spark.createDataFrame(copies + others, "doc_id long, x array<double>"), labels, held_out=(5, 9))
    assert seen["weight"].sum() == len(copies + others)


def test_weights_stand_for_copies():
    rnd = np.random.default_rng(3)
    x, weight = np.round(rnd.normal(size=(400, 3)), 1), rnd.integers(1, 6, 400).astype(float)
    y = (x[:, 0] + rnd.normal(size=400) > 0).astype(float)
    every = np.repeat(np.arange(400), weight.astype(int))
    a, b = quality_gam.fit(x, y, weight=weight), quality_gam.fit(x[every], y[every])
    assert all((p == q).all() for p, q in zip(a.borders + a.coarse, b.borders + b.coarse))
    assert np.allclose(a.scores(x), b.scores(x), atol=1e-6)


def _plain_features(body):
    """op8's features of a text, character by character."""
    words = body.split()
    n = len(words)
    if not n:
        return None
    chars = sum(map(len, words))
    lines = [x for x in body.split(b"\n") if x.split()]
    seen = collections.Counter(words)
    return {
        "n": math.log1p(n), "length": chars / n, "dup_lines": 1 - len(set(lines)) / len(lines), "distinct": len(seen) / n,
        "most": max(seen.values()) / n, "again": sum(a == b for a, b in zip(words, words[1:])) / n, "a_line": math.log1p(n / len(lines)),
        "long": sum(len(w) > 20 for w in words) / n, "capitals": sum(65 <= c <= 90 for c in body) / chars, "digits": sum(48 <= c <= 57 for c in body) / chars}


_PLACES = {"n": 0, "length": 1, "capitals": 4, "digits": 5, "dup_lines": 7, "distinct": 8, "most": 9, "again": 10, "a_line": 11, "long": 12}


def test_features_and_scores_row_by_row(documents, odd_rows):
    """Text features against plain counts, and scores against one sum of table entries for each row."""
    bodies = [(r.text or "").encode() for r in documents.collect()] + [(r[1] or "").encode() for r in odd_rows]
    x = np.array([quality_gam.text_features(b) for b in bodies])
    for body, row in zip(bodies, x):
        want = _plain_features(body)
        if want is not None:
            assert [row[_PLACES[k]] for k in want] == pytest.approx(list(want.values()), abs=1e-12)
    rnd = np.random.default_rng(2)
    model = quality_gam.fit(x, (x[:, 1] + x[:, 8] * x[:, 0] + rnd.normal(0, 0.3, len(x)) > np.median(x[:, 1]) + 2).astype(int), rounds=20, pair_rounds=10)
    assert model.pairs
    for row, score in zip(x, model.scores(x)):
        total = model.intercept
        for value, borders, table in zip(row, model.borders, model.tables):
            total += table[sum(b < value for b in borders)]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[sum(c < row[a] for c in model.coarse[a]), sum(c < row[b] for c in model.coarse[b])]
        assert score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)


def test_rules_judge_like_a_plain_list(spark):
    """The verdict of every document against the learned list, read rule by rule and condition by condition."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    statistics = written(quality_rules.text_statistics(docs), "test-statistics")
    rows = quality_rules.features(statistics)
    rules = quality_rules.learn_rules(rows, labels)
    assert rules

    def holds(c, r):
        above, below = quality_rules.FEATURES[c.feature]
        value = r[above] / r[below] if r[below] else 0.0
        return value > c.threshold if c.above else value <= c.threshold

    facts = {r.doc_id: r for r in statistics.collect()}
    for r in rows.withColumn("rule", quality_rules.verdict(rules)).collect():
        want = next((k for k, rule in enumerate(rules, 1) if all(holds(c, facts[r.doc_id]) for c in rule)), None)
        assert r.rule == want
    failed = lambda f: f.n_words < 50 or 100 * f.n_repeat_words > 50 * f.n_words
    for r in quality_rules.quality_rules(docs, labels).collect():
        assert r.base_failed == failed(facts[r.doc_id]) and r.kept == (not r.base_failed and r.rule is None)
