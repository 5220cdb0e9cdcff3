"""op9 and op7 against brute force."""

import re

import numpy as np
import pytest

from layerflow.llm import embedding_dedup as emb
from layerflow.llm import license_scan as lic

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _plain(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    starts, labels = [], set()
    for phrase, label in lic.BASE_PHRASES.items():
        q = phrase.split()
        for i in range(len(words) - len(q) + 1):
            if words[i:i + len(q)] == q:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_base_places(documents, odd, odd_rows, none):
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    for docs, rows in ((documents, texts), (odd, [(r[0], r[1]) for r in odd_rows])):
        got = lic.license_scan(docs).collect()
        assert sorted(map(repr, ((r.doc_id, *r[1:6]) for r in got))) == sorted(map(repr, ((i, *_plain(t)) for i, t in rows)))
        for r in got:
            assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
            assert r.labels.split(",") == sorted(set(r.labels.split(","))) and 0 <= r.score <= 1
    assert lic.license_scan(none).count() == 0


def test_overlapping_and_edge_places():
    scan = lic.Scanner().scan
    assert scan(b"MIT license mit LICENSE")[:5] == (4, 2, 0, 2, "mit")
    assert scan(b"amit license; mit licensed; mit-license")[:4] == (6, 1, 4, 4)
    assert scan("ämit license".encode())[1] == 0
    assert scan(b"")[:6] == (0, 0, None, None, "", "")


@pytest.mark.parametrize("expression,labels,free", [
    (b"MIT", {"mit"}, True), (b"MIT OR GPL-3.0", {"mit", "gpl"}, True), (b"MIT AND GPL-3.0", {"mit", "gpl"}, False),
    (b"GPL-2.0-or-later WITH Classpath-exception-2.0", {"gpl"}, False), (b"MIT OR GPL-2.0 AND LGPL-2.1", {"mit", "gpl", "lgpl"}, True),
    (b"(MIT OR GPL-2.0) AND LGPL-2.1", {"mit", "gpl", "lgpl"}, False), (b"((mit))", {"mit"}, True), (b"BSD-3-Clause */", {"bsd"}, True),
    (b"MIT AND (GPL-3.0 OR", {"mit", "gpl"}, False), (b"AND MIT", set(), False), (b")", set(), False), (b"", set(), False),
    (b"MIT and then more words", {"mit"}, True), (b"MIT or any later choice", {"mit"}, True), (b"any MIT", set(), False), (b"MIT with more words", {"mit"}, True),
    (b"GPL-2.0 WITH Linux-syscall-note OR MIT", {"gpl", "mit"}, True), (b"GPLv2 AND 0BSD", {"gpl", "0bsd"}, False), (b"mitten", set(), False), (b"Apache2 OR Python-2.0", {"apache", "python"}, True),
    (b"LicenseRef-My.Own+ or CC-BY-NC-4.0", {"licenseref-my.own", "cc-by-nc"}, False), (b"(" * 2000 + b"MIT" + b")" * 2000, {"mit"}, True),
])
def test_expressions(expression, labels, free):
    assert lic.evaluate(expression) == (labels, free)


def test_notices_and_tags():
    scan = lic.Scanner().scan
    found = scan(b"licensed under cc by-nc 4.0.")
    assert found[5] == "cc-by-nc" and found[1] == 0
    tagged = scan(b"# SPDX-License-Identifier: Apache-2.0 OR MIT\nx")
    assert tagged[5] == "apache,mit" and tagged[7] == 1 and tagged[8] is True and tagged[6] > found[6]


# ---------------------------------------------------------------- embeddings

def _links(vectors, ids, threshold=0.95):
    usable = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    n, links, up = len(vectors), [0] * len(vectors), list(range(len(vectors)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for dim in {len(v) for v, ok in zip(vectors, usable) if ok}:
        own = [i for i in range(n) if usable[i] and len(vectors[i]) == dim]
        u = emb.unit(np.array([vectors[i] for i in own], float))
        for a, b in np.argwhere(u @ u.T >= threshold):
            if a != b:
                links[own[a]] += 1
                x, y = root(own[a]), root(own[b])
                up[max(x, y)] = min(x, y)
    least = {}
    for i in range(n):
        if ids[i] is not None:
            least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return [(ids[i], links[i], least.get(root(i))) for i in range(n)]


def _vectors():
    rng = np.random.default_rng(5)
    out = []
    for k in range(50):
        base = rng.normal(size=64)
        base /= np.linalg.norm(base)
        for _ in range(300 if k == 0 else int(rng.integers(1, 9))):  # one large group
            out.append(((base + rng.normal(size=64) * rng.choice([0, 0.005, 0.012])) * rng.choice([1, 2.5])).astype("float32").tolist())
    odd = [None, [0.0] * 64, [float("nan")] * 64, [None] + [1.0] * 63, [float("inf")] + [1.0] * 63, [], [1.0, 2.0], [2.0, 4.0], [1.0, 2.0],
           out[0], out[0], out[5], [1e30] * 64, [1e30] * 63 + [1.01e30]]
    return out + odd


@pytest.mark.parametrize("lattice", [emb.Lattice(), emb.Lattice(cell_work=2000)])
def test_links_and_components(spark, lattice):
    vectors = _vectors()
    ids = [*range(len(vectors) - 3), None, 2, 2]
    df = spark.createDataFrame(list(zip(ids, vectors, [9] * len(ids))), "vec_id long, embedding array<float>, n long").repartition(3)
    got = emb.near_duplicates(df, lattice=lattice).collect()
    want = _links(vectors, ids)
    assert sorted(map(repr, ((r.vec_id, r.n_links, r.component_id) for r in got))) == sorted(map(repr, want))
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_no_vectors(spark):
    assert emb.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_e8_decoding():
    z = np.random.default_rng(3).normal(0, 1, (1500, 8))
    p = emb.nearest_e8(z)
    own = ((z - p) ** 2).sum(axis=1)
    assert len(emb.NEIGHBOURS) == 240 and np.allclose((emb.NEIGHBOURS ** 2).sum(axis=1), 2)
    assert all((own <= ((z - p - v) ** 2).sum(axis=1) + 1e-9).all() for v in emb.NEIGHBOURS)


def test_recall_at_the_threshold():
    """Pairs at exactly cosine 0.95, where recall is lowest, meet in some table."""
    rng, lattice = np.random.default_rng(8), emb.Lattice()
    x = emb.unit(rng.normal(size=(3000, 64)))
    d = rng.normal(size=x.shape)
    d = emb.unit(d - (d * x).sum(axis=1, keepdims=True) * x)
    y = 0.95 * x + np.sqrt(1 - 0.95 ** 2) * d
    met = np.zeros(len(x), bool)
    for t in range(lattice.tables):
        a, b = emb.cells(x, lattice, t), emb.cells(y, lattice, t)
        met |= (b == a[:, :1]).any(axis=1) | (a == b[:, :1]).any(axis=1)
    assert met.mean() > 0.97
