"""Quality classifier: a generalised additive model with pairwise interactions, of lookup tables.

Text features are cut into bins at quantiles. Cyclic boosting visits the features in turn, many times over: each
visit fits one shallow tree (three leaves) to the gradients of that feature's bins and adds a small step of it to the
feature's table. Then the pairs of features that explain most of what is left (best cut of a coarse grid) get
tables of their own, boosted in the same way. A score is a sum of table entries, looked up for a whole
batch at once.

Learning sees a bounded sample: about ``sample_rows`` distinct labelled rows at most, chosen by a hash of id and features,
each with the number of its copies as weight; counts of bins and gradients are over these. Features come from whole texts of all rows, and from the text alone.

Results for special input: null and empty texts have all features 0 and are scored like any other; rows whose
labels are null, other than 0 and 1 or contradict each other are not learned from; with labels of one kind
only, or none, every score is the smoothed share of label 1; repeated rows give repeated results; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, id_and_bytes, map_batches, map_rows, written

FEATURES = (
    "log_words", "word_length", "symbol_share", "shout_share", "capital_share", "digit_share", "other_mark_share",
    "dup_line_share", "distinct_share", "top_word_share", "twin_share", "words_a_line", "long_word_share", "stop_share",
)
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>@^~=+\\/{}[]_")] = True
_SHOUTS = np.zeros(256, bool)
_SHOUTS[list(b"!?")] = True
_STOPS = np.zeros(256, bool)
_STOPS[list(b".,;:")] = True
_OTHER = np.zeros(256, bool)
_OTHER[list(b"\"'()-`")] = True
_CAPITALS, _DIGITS = np.zeros(256, bool), np.zeros(256, bool)
_CAPITALS[0x41:0x5B], _DIGITS[0x30:0x3A] = True, True


def text_features(body: bytes) -> list[float]:
    """The features of one whole text, in the order of ``FEATURES``."""
    words = body.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.zeros(256, np.int64)
    every = np.frombuffer(body, np.uint8)
    for at in range(0, len(every), 1 << 20):
        counts += np.bincount(every[at:at + (1 << 20)], minlength=256)
    chars = sum(map(len, words))
    lines = [x for x in body.split(b"\n") if x.strip()]
    seen = Counter(words)
    share = lambda kind: float(counts[kind].sum()) / chars
    return [
        math.log1p(n), chars / n, share(_SYMBOLS), share(_SHOUTS), share(_CAPITALS), share(_DIGITS), share(_OTHER),
        1 - len(set(lines)) / len(lines), len(seen) / n, max(seen.values()) / n, sum(map(eq, words, words[1:])) / n,
        math.log1p(n / len(lines)), sum(len(w) > 20 for w in words) / n, share(_STOPS),
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``x``, the features of its whole text."""

    def rows(batch: pa.RecordBatch) -> dict:
        found = np.array([text_features(body.as_py()) for body in batch.column("body")])
        return {"doc_id": batch.column("doc_id"), "x": pa.array(list(found), pa.list_(pa.float64()))}

    return map_rows(id_and_bytes(docs, id_col, text_col), rows, "doc_id long, x array<double>")


# ---------------------------------------------------------------- the model

@dataclass
class Gam:
    """Bin borders and table of each feature, coarse borders and table of each chosen pair, and the intercept."""

    intercept: float
    borders: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 of rows of features: vectorised bin lookups, added up."""
        total = np.full(len(x), self.intercept)
        for j, (borders, table) in enumerate(zip(self.borders, self.tables)):
            total += table[np.searchsorted(borders, x[:, j])]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.coarse[a], x[:, a]), np.searchsorted(self.coarse[b], x[:, b])]
        return 1 / (1 + np.exp(-total))


def _quantiles(x: np.ndarray, n: int, weight: np.ndarray) -> np.ndarray:
    """Borders of at most n bins of about equal weight; a bin holds values above one border up to the next. As
    ``np.quantile(..., method="lower")`` of every value repeated ``weight`` times."""
    order, q = np.argsort(x, kind="stable"), np.arange(1, n) / n
    until = np.cumsum(weight[order])
    return np.unique(x[order][np.searchsorted(until, np.floor(until[-1] * q + (1 - q) - 1), side="right")])


def _leaf_gain(g, h):
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """A tree over ordered bins: splits where the gain is largest; the value of every bin's leaf. ``least`` is the
    smallest weight of a leaf."""
    cuts = [0, len(g)]
    sum_g, sum_h = np.r_[0.0, np.cumsum(g)], np.r_[0.0, np.cumsum(h)]
    while len(cuts) <= leaves:
        best, at = 1e-9, None
        for s, e in zip(cuts, cuts[1:]):
            m = np.arange(s + 1, e)
            gl, hl = sum_g[m] - sum_g[s], sum_h[m] - sum_h[s]
            gr, hr = sum_g[e] - sum_g[m], sum_h[e] - sum_h[m]
            gain = np.where((hl >= least) & (hr >= least), _leaf_gain(gl, hl) + _leaf_gain(gr, hr) - _leaf_gain(gl + gr, hl + hr), 0)
            if len(m) and gain.max() > best:
                best, at = float(gain.max()), int(m[gain.argmax()])
        if at is None:
            break
        cuts = sorted([*cuts, at])
    out = np.zeros(len(g))
    for s, e in zip(cuts, cuts[1:]):
        out[s:e] = (sum_g[e] - sum_g[s]) / (sum_h[e] - sum_h[s] + 1.0)
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray, least: float) -> tuple[np.ndarray, float]:
    """A tree over a grid: the best cut of one side, then of the other side in each half; its values and its gain."""
    best, table = 0.0, np.zeros(g.shape)
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        for cut in range(1, gg.shape[0]):
            gain, out = 0.0, np.zeros(gg.shape)
            for part in (slice(0, cut), slice(cut, None)):
                pg, ph = gg[part].sum(axis=0), hh[part].sum(axis=0)
                values = _tree(pg, ph, 2, least)
                gain += float(np.sum(values * pg - values ** 2 * (ph + 0.5) / 2))
                out[part] = values
            if gain > best:
                best, table = gain, out.T if flip else out
    return table, best


def fit(
    x: np.ndarray, y: np.ndarray, bins: int = 32, coarse: int = 8, rounds: int = 150, pair_rounds: int = 60, n_pairs: int = 4,
    rate: float = 0.1, least: float = 2.0, weight: np.ndarray | None = None,
) -> Gam:
    """Learn a model from rows of features and labels (0 and 1); ``weight``: how many rows each stands for, else one."""
    weight = np.ones(len(y)) if weight is None else weight
    good = float(((weight * y).sum() + 1) / (weight.sum() + 2))
    gam = Gam(math.log(good / (1 - good)))
    if not 0 < y.sum() < len(y):
        return gam
    gam.borders = [_quantiles(x[:, j], bins, weight) for j in range(x.shape[1])]
    gam.coarse = [_quantiles(x[:, j], coarse, weight) for j in range(x.shape[1])]
    gam.tables = [np.zeros(len(b) + 1) for b in gam.borders]
    binned = [np.searchsorted(b, x[:, j]) for j, b in enumerate(gam.borders)]
    total = np.full(len(y), gam.intercept)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return weight * (y - p), weight * (p * (1 - p))

    for _ in range(rounds):
        for j, b in enumerate(binned):
            if len(gam.borders[j]):
                g, h = gradients()
                size = len(gam.tables[j])
                step = rate * _tree(np.bincount(b, g, size), np.bincount(b, h, size), 3, least)
                gam.tables[j] += step
                total += step[b]

    coarse_bins = [np.searchsorted(b, x[:, j]) for j, b in enumerate(gam.coarse)]

    def grid(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = len(gam.coarse[a]) + 1, len(gam.coarse[b]) + 1
        cell = coarse_bins[a] * shape[1] + coarse_bins[b]
        return tuple(np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (g, h))

    g, h = gradients()
    ranked = sorted(
        ((_grid_tree(*grid(a, b, g, h), least)[1], (a, b)) for a in range(x.shape[1]) for b in range(a + 1, x.shape[1])
         if len(gam.coarse[a]) and len(gam.coarse[b])), key=lambda r: (-r[0], r[1]))
    gam.pairs = [pair for gain, pair in ranked[:n_pairs] if gain > 0]
    gam.pair_tables = [np.zeros((len(gam.coarse[a]) + 1, len(gam.coarse[b]) + 1)) for a, b in gam.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(gam.pairs):
            step = rate * _grid_tree(*grid(a, b, *gradients()), least)[0]
            gam.pair_tables[k] += step
            total += step[coarse_bins[a], coarse_bins[b]]
    return gam


def learn(
    rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample_rows: int = 50_000,
    held_out: tuple[int, int] = (5, 0), **fitting,
) -> Gam:
    """The model of the labelled rows of ``features`` that are not held out. Rows equal in id and features count as one
    with their number as weight; about ``sample_rows`` of these at most reach the driver, however often an id occurs."""
    fold = F.coalesce(crc_mod("doc_id", held_out[0]), F.lit(-1))
    known = (
        labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("doc_id"))
        .agg(F.min(label_col).alias("low"), F.max(label_col).alias("high")).filter("low = high")
        .select("doc_id", F.col("low").cast("int").alias("y"))
    )
    labelled = rows.filter(fold != held_out[1]).join(known, "doc_id")
    classes = written(labelled.groupBy("doc_id", "x", "y").agg(F.count("*").alias("n")), "quality-labelled")
    step = max(1, math.ceil(classes.count() / sample_rows))
    sample = classes.filter(F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "x"), F.lit(step)) == 0).collect()
    sample.sort(key=lambda r: (r.doc_id, r.x))  # sums of the fit do not depend on the order of tasks
    x = np.array([r.x for r in sample], dtype=float).reshape(len(sample), len(FEATURES))
    y, weight = (np.array([r[c] for r in sample], dtype=float) for c in ("y", "n"))
    return fit(x, y, weight=weight, **fitting)


def quality_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **learning,
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    rows = written(features(docs, id_col, text_col), "quality-features")
    gam = learn(rows, labels, id_col, **learning)

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
                p = gam.scores(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    fold = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return map_batches(
        rows.select("doc_id", fold, "x"), score, "doc_id long, held_out boolean, score double, predicted int")
