"""The pipeline's stages on documents and odd rows, and the registration of all queries."""

import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from oracle_check import check

from layerflow.llm import queries
from layerflow.llm.common import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_dedup", "substring_dedup", "mixing", "sentencepiece"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    r = check(spark, SF, name, entry.queries()[name], queries.ORACLE_SQL[name])
    assert r["match"], r


def _stages(spark, docs):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_stages_on_documents(spark, documents):
    docs, known, single, cut, mixed, coded = _stages(spark, documents)
    for stage in (known, single, cut, mixed):
        assert stage.columns == docs.columns
    assert known.count() == docs.count()  # every document is in a labelled language
    texts = {r.doc_id: r.text for r in single.collect()}
    assert len(texts) == single.count() and set(texts) <= {r.doc_id for r in known.collect()}
    seen = set()
    for r in cut.orderBy("doc_id").collect():
        words = WORD.findall(r.text)
        windows = {tuple(words[a:a + 20]) for a in range(len(words) - 19)}
        original = WORD.findall(texts[r.doc_id])
        assert words == original or r.text == " ".join(words) and r.n_chars == len(r.text)
        if words == original:  # nothing repeated here: neither inside nor earlier
            assert not windows & seen
        seen |= {tuple(original[a:a + 20]) for a in range(len(original) - 19)}
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= {r.doc_id for r in cut.collect()} and max(copies.values()) <= 2
    assert Counter(r.doc_id for r in coded.collect()) == copies


def test_stages_on_odd_rows(spark, odd, none):
    stages = _stages(spark, odd)
    assert all(s.columns == odd.columns for s in stages[:-1])
    assert stages[-1].count() == stages[-2].count() > 0
    assert _stages(spark, none)[-1].count() == 0


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    want = _stages(spark, spark.read.parquet(f"{SF}/documents.parquet"))[-1].collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
