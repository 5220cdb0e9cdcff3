"""Quality rules: text statistics in Spark expressions and a learned decision list over them.

``text_statistics`` computes every statistic with built-in expressions of one row (no shuffle).
``learn_rules`` learns an ordered list of interpretable rules by sequential covering: a rule that marks low
quality grows one threshold condition at a time (best information gain on the growing rows that no earlier
rule covers), is pruned to its best beginning on held-back rows, and joins the list if it is precise
enough there. Every step is one Spark aggregation over all labelled rows; only counts for each feature and
threshold (features x thresholds numbers) reach the driver. ``verdict`` turns the list into one ordered
conditional expression. No Python code runs on executors.

Results for special input: null and empty texts have no words (all statistics 0) and fail the base rules;
documents without a label, and labels that are null, other than 0 and 1 or contradict each other, are not
learned from; without labels of both kinds no rule is learned and the verdict keeps; repeated rows give
repeated results; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of each whole text; one row per row of ``docs``."""
    white = F.lit(" \t\n\x0b\x0c\r")
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"),
    ).withColumn("trimmed", F.btrim("body", white))
    words = base.withColumn(
        "words", F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", f"[{WHITE}]+")),
    ).withColumn("lines", F.filter(F.split("body", "\n"), lambda x: F.btrim(x, white) != ""))
    # 3-word windows with their places, sorted, so that equal windows are neighbours.
    windows = words.withColumn(
        "windows",
        F.when(F.size("words") >= 3, F.expr(
            "sort_array(transform(sequence(0, size(words) - 3), "
            "i -> named_struct('w', concat_ws(' ', words[i], words[i + 1], words[i + 2]), 'i', i)))")),
    ).withColumn(
        "repeats",
        F.expr("sort_array(transform(filter(windows, (x, k) -> "
               "get(windows, k - 1).w <=> x.w or get(windows, k + 1).w <=> x.w), x -> x.i))"),
    )
    size = lambda c: F.size(c).cast("long")
    without = lambda pattern: F.length(F.regexp_replace("body", pattern, "")).cast("long")
    return windows.select(
        "doc_id",
        size("words").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("body") - without("[#*$%&|<>]+")).cast("long").alias("n_symbols"),
        (size("lines") - size(F.array_distinct("lines"))).alias("n_dup_lines"),
        # A repeated window covers 3 words, or those up to the next repeated window.
        F.coalesce(F.expr(
            "aggregate(transform(repeats, (v, k) -> least(3, coalesce(get(repeats, k + 1) - v, 3))), 0L, (a, v) -> a + v)"
        ), F.lit(0)).cast("long").alias("n_repeat_words"),
        size("lines").alias("n_lines"),
        size(F.array_distinct("words")).alias("n_distinct_words"),
        without("[^A-Z]+").alias("n_capitals"),
        without("[^!?]+").alias("n_shouts"),
        without("[^0-9]+").alias("n_digits"),
    )


# What the rules may test: ratios of the statistics, 0 where there is nothing to divide by.
FEATURES = {
    "word_length": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "capital_share": ("n_capitals", "word_chars"),
    "shout_share": ("n_shouts", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "words_a_line": ("n_words", "n_lines"),
}


def features(statistics: DataFrame) -> DataFrame:
    return statistics.select("*", *[
        F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(F.lit(0.0)).alias(name)
        for name, (above, below) in FEATURES.items()
    ])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


# ---------------------------------------------------------------- learning

def _labelled(rows: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """The feature rows of documents with one known label; ``bad`` is 1 for label 0."""
    known = (
        labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("doc_id"))
        .agg(F.min(label_col).alias("low"), F.max(label_col).alias("high")).filter("low = high")
        .select("doc_id", (F.lit(1) - F.col("low")).cast("long").alias("bad"))
    )
    return rows.filter(~base_failed()).join(known, "doc_id").select("doc_id", "bad", *FEATURES)


def _thresholds(rows: DataFrame, n: int) -> dict[str, list[float]]:
    """Up to ``n`` quantiles of each feature over all and over the bad rows, with the smallest and largest values, and the
    middles between them: the thresholds of conditions."""
    share = [i / (n + 1) for i in range(n + 2)]
    found = rows.agg(*[
        F.percentile_approx(F.when(F.col("bad") >= least, F.col(f)), share, 2000).alias(f"{f}{least}") for f in FEATURES for least in (0, 1)
    ]).first()
    out = {}
    for f in FEATURES:
        values = sorted({*(found[f"{f}0"] or []), *(found[f"{f}1"] or [])})
        out[f] = sorted({*values, *((a + b) / 2 for a, b in zip(values, values[1:]))})
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gain of a condition that leaves p bad and n good rows of p0 and n0."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _conjunction(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def _bin(feature: str, cuts: list[float]) -> Column:
    """How many of the thresholds a feature exceeds."""
    value = F.col(feature)
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda t: value > t))


def _grow(rows: DataFrame, cuts: dict[str, list[float]], most: int, least_rows: int) -> Rule:
    """Add the best condition until only bad rows are left, nothing is gained or ``most`` are there."""
    names = list(cuts)
    bins = F.explode(F.array(*[
        F.struct(F.lit(k).alias("f"), _bin(f, cuts[f]).alias("b")) for k, f in enumerate(names) if cuts[f]
    ])).alias("x")
    rule: Rule = ()
    while len(rule) < most:
        counted = rows.filter(_conjunction(rule)).select("bad", bins).groupBy("x.f", "x.b").agg(
            F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
        table = {(r.f, r.b): (r.p, r.n) for r in counted}
        k0 = next((k for k, f in enumerate(names) if cuts[f]), 0)
        p0, n0 = (sum(v[i] for (f, _), v in table.items() if f == k0) for i in (0, 1))
        if not p0 or not n0:
            break
        best, chosen = 1e-9, None
        for k, f in enumerate(names):
            below_p = below_n = 0
            for j, t in enumerate(cuts[f]):
                p, n = table.get((k, j), (0, 0))
                below_p, below_n = below_p + p, below_n + n
                for above, (p, n) in ((False, (below_p, below_n)), (True, (p0 - below_p, n0 - below_n))):
                    gain = _gain(p, n, p0, n0) if p >= least_rows else 0.0
                    # Of thresholds that part the rows alike, the one that covers least: the highest to be above.
                    alike = gain == best and chosen is not None and above and chosen.above and chosen.feature == f
                    if gain > best or alike:
                        best, chosen = gain, Condition(f, above, t)
        if chosen is None:
            break
        rule += (chosen,)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The beginning of a rule that separates held-back rows best, and the bad and good rows it covers there."""
    counted = rows.agg(*[
        F.coalesce(F.sum(F.when(_conjunction(rule[:k]), F.col("bad") if bad else 1 - F.col("bad"))), F.lit(0)).alias(f"{kind}{k}")
        for k in range(1, len(rule) + 1) for kind, bad in (("p", True), ("n", False))
    ]).first()
    scored = [(k, counted[f"p{k}"], counted[f"n{k}"]) for k in range(1, len(rule) + 1)]
    k, p, n = max(scored, key=lambda x: ((x[1] - x[2]) / max(1, x[1] + x[2]), x[1], -x[0]))
    return rule[:k], p, n


def learn_rules(
    rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", thresholds: int = 32,
    most_rules: int = 8, most_conditions: int = 3, least_rows: int = 3, precision: float = 0.9,
) -> list[Rule]:
    """The decision list: rules that mark a document as bad, in order. ``rows`` are ``features``."""
    known = written(_labelled(rows, labels, id_col, label_col), "quality-labelled")
    held = F.pmod(F.xxhash64("doc_id", F.lit("held back")), F.lit(3)) == 0
    grow_rows, prune_rows = known.filter(~held), known.filter(held)
    cuts = _thresholds(grow_rows, thresholds)
    rules: list[Rule] = []
    while any(cuts.values()) and len(rules) < most_rules:
        free = F.lit(True)
        for rule in rules:
            free = free & ~_conjunction(rule)
        rule = _grow(grow_rows.filter(free), cuts, most_conditions, least_rows)
        if not rule:
            break
        rule, p, n = _prune(prune_rows.filter(free), rule)
        if p < 1 or p < precision * (p + n):
            break
        rules.append(rule)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that a row meets, from 1; null if it meets none."""
    out = None
    for k, rule in enumerate(rules, 1):
        out = F.when(_conjunction(rule), F.lit(k)) if out is None else out.when(_conjunction(rule), F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **learning) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the number of the rule that dropped the document."""
    rows = features(written(text_statistics(docs, id_col, text_col), "quality-statistics"))
    rules = learn_rules(rows, labels, id_col, **learning)
    return rows.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules)).select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule",
    )
