"""op12 against exact integers and a dense eigenvalue solver."""

import math
from collections import defaultdict

import numpy as np
import pytest

from layerflow.llm import embedding_whitening as wh


def _plain(rows, most=16):
    """(vec_id, component) → row values, from the definition."""
    def x_of(v):
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            return None
        x = [math.floor(64 * float(c)) + 1_000_000 for c in v]
        return None if any(abs(c) >= 1 << 62 for c in x) else tuple(x)

    kept = [(i, x_of(v)) for i, v in rows]
    kept = [(i, x) for i, x in kept if x]
    out = defaultdict(list)
    for d in {len(x) for _, x in kept}:
        fit = sorted({x for _, x in kept if len(x) == d})
        n, s = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array([[(n * c - t) / n for c, t in zip(x, s)] for x in fit])
        v = centred.T @ centred / n
        e, q = np.linalg.eigh(v)
        order = [k for k in np.argsort(-e) if e[k] > e.max() * d * 2.0 ** -50][:most]
        for i, x in kept:
            if len(x) == d:
                own = np.array([(n * c - t) / n for c, t in zip(x, s)])
                dev = sum((n * c - t) ** 2 for c, t in zip(x, s))
                for place, k in enumerate(order, 1):
                    out[i].append((place, n, dev if dev < 1 << 63 else None, own @ q[:, k] / math.sqrt(e[k]), e[k] / np.trace(v)))
    return out


def _same(got, want, tolerance=1e-8):
    by_id = defaultdict(list)
    for r in got:
        by_id[r.vec_id].append(r)
        assert r.identity_error <= 1e-9
    assert set(by_id) == {i for i, rows in want.items() if rows}
    sign = {}
    for i, rows in by_id.items():
        key = lambda t: (t[0], t[1], -1 if t[2] is None else t[2])
        mine = sorted(((r.component, r.n, r.deviation, r.whitened, r.explained) for r in rows), key=key)
        for (c, n, dev, w, part), (c2, n2, dev2, w2, part2) in zip(mine, sorted(want[i], key=key), strict=True):
            assert (c, n, dev) == (c2, n2, dev2) and abs(part - part2) <= 1e-10
            if abs(w2) > 1e-6:
                own = sign.setdefault((n, c), math.copysign(1, w * w2))
                assert own == math.copysign(1, w * w2)
            assert abs(abs(w) - abs(w2)) < tolerance


def test_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    _same(wh.whitened(rows).collect(), _plain([(r.vec_id, r.embedding) for r in rows.collect()]), 1e-6)


def test_odd_rows(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, rnd.standard_normal(5).round(2).tolist()) for i in range(40)]
    rows += [(1, rows[0][1]), (40, rows[3][1]), (41, None), (42, []), (43, [1.0, None, 2.0, 3.0, 4.0]), (44, [float("nan")] * 5),
             (45, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (46, [1e300, 0.0, 0.0, 0.0, 0.0]), (47, [1.0, 2.0]), (48, [1.0, 2.0]),
             (49, [3.5, -1.0]), (50, [7.0, 7.0, 7.0]), (51, [-0.001, 100.0, 30.0, 0.5, 0.5]), (None, rows[5][1])]
    table = spark.createDataFrame([(i, v, 1, b"x", "n") for i, v in rows], "vec_id long, embedding array<double>, dim int, code binary, n string")
    want = _plain(rows)
    _same(wh.whitened(table.repartition(4)).collect(), want, 1e-7)
    assert {r.vec_id for r in wh.whitened(table).collect()}.isdisjoint({41, 42, 43, 44, 45, 46, 50})
    assert wh.whitened(table.limit(0)).count() == 0
    assert wh.whitened(table.filter("vec_id = 50")).count() == 0


def test_beyond_a_long(spark):
    """Exact where int64 is not: deviations beyond a long are null, the others right."""
    rows = [(i, [float(i), 2.0 ** 50 * (i % 3), -float(i * i)]) for i in range(12)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = wh.whitened(table).collect()
    want = _plain(rows)
    assert {(r.vec_id, r.deviation) for r in got} == {(i, v[0][2]) for i, v in want.items()}


@pytest.mark.parametrize("spectrum", [
    [5, 5, 5, 1, 1, 1, 0.1, 0, 0], [3] * 20, [1 + 1e-9 * k for k in range(24)], [10.0 ** -k for k in range(12)], [2.0], [0.0, 0.0]])
def test_clusters_of_eigenvalues(spectrum):
    rnd = np.random.default_rng(len(spectrum))
    q, _ = np.linalg.qr(rnd.standard_normal((len(spectrum), len(spectrum))))
    v = q @ np.diag(spectrum) @ q.T
    v = (v + v.T) / 2
    e, x = wh.leading_components(v, 16)
    top = sorted(spectrum, reverse=True)[:16]
    assert np.allclose(e, top[:len(e)], atol=1e-13 * max(top[0], 1e-300)) and all(t <= 1e-12 for t in top[len(e):])
    assert np.allclose(x @ x.T, np.eye(len(e)), atol=1e-13)
    assert np.allclose(v @ x.T, x.T * e, atol=1e-13 * max(top[0], 1e-300))


def test_sturm_counts():
    d, e = np.array([2.0, -1.0, 0.0, 4.0]), np.array([1.0, 0.0, 3.0])
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    shifts = np.linspace(-6.03, 8.01, 57)
    assert wh.sturm_counts(d, e, shifts).tolist() == [(values < s).sum() for s in shifts]
