"""Language identification by cross-parsing entropy.

Of each language a text is indexed by its suffix automaton, which holds every substring of it. That text is learned from
all labelled rows: their words are counted, then the pairs in which the most frequent words follow each other, and the
text runs along the most frequent pairs, so it reads as the language's rows do. A document, its letters in lower case with one space for everything between words, is parsed as a whole
against each language: from left to right, always the longest phrase that occurs in the language's text (a character
that does not occur is a phrase of its own). Phrases run over word borders, so word order and endings count. A phrase of
a text of n characters costs log2(n + 1) bits, so texts of different length compare; the language needing the
fewest normalised phrases wins.

Bounded is the learned text alone, to ``pieces * piece_chars`` characters, fewer where there are many languages
(``total_pieces``); counts and bounds read every labelled row. Predictions read whole texts of all rows, and only the text.

``recognised`` keeps what reads like one of the languages, whatever their number: the best language's bits a letter must
stay within the bound learned for it on the labelled rows that the counts leave out (``bounds``).

Results for special input: null texts, texts without a letter, and all texts if no language was learned get
``und`` with score 0; equal costs go to the first language in code point order; repeated rows give repeated
results; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import math
import re
from array import array
from collections import Counter, defaultdict, deque
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import crc_mod, map_batches, map_column, worker_model

UNKNOWN = "und"
#: How sharply the score answers to the ratio of two languages' costs.
SHARPNESS = 12.0
#: Phrases that a text may need beyond its bound: the first and the last one are cut off by its ends.
SPARE_PHRASES = 3
#: Of languages with so many labelled rows one text in ``APART`` is kept from the counts, for the bound.
LEAST_ROWS, APART = 20, 4
#: Counts of words and of pairs that a task holds before it hands them on, and rows it hands on at a time. A pair takes 16
#: bytes, a word about 100.
HELD, HELD_PAIRS, HANDED = 300_000, 2_000_000, 65_536
#: Groups of the words or pairs of a language that are ranked apart, before the first of each are ranked together.
SHARES = 64
#: Table cells for a character of its text that an automaton may take; with more it stays a set of dictionaries.
CELLS = 100
#: Characters, times languages, that are parsed together, and parses that are too few for that.
TOGETHER, FEW = 4_000_000, 64
#: Characters that a word of the learned text takes, about: so many words and pairs are ranked.
WORD_CHARS = 8
_BETWEEN = re.compile(r"[\W\d_]+")
#: Bytes of UTF-8, with a space for ASCII characters that are no letters.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


class SuffixAutomaton:
    """All substrings of a text: states joined by single characters, about two states a character at most. Over an
    alphabet that is not too large it is a table: the cell of a state and a character (0: one that does not occur) holds
    four times the first cell of the state that follows, plus the phrases that end with the step. Otherwise a state is the
    dictionary of the states that follow it."""

    def __init__(self, text: str):
        states: list[dict] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            here = len(states)
            states.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in states[p]:
                states[p][c] = here
                p = link[p]
            if p >= 0:
                q = states[p][c]
                if length[p] + 1 == length[q]:
                    link[here] = q
                else:
                    copy = len(states)
                    states.append(dict(states[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and states[p].get(c) == q:
                        states[p][c] = copy
                        p = link[p]
                    link[q] = link[here] = copy
            last = here
        self.bits = math.log2(len(text) + 1)
        self.codes = {c: i for i, c in enumerate(sorted(states[0]), 1)}
        self.table = self.start = None
        if len(states) * (len(self.codes) + 1) <= min(CELLS * len(text), 1 << 28):
            self.table = self._cells(states)
            return
        for state in states:
            for c, target in state.items():
                state[c] = states[target]
        self.start = states[0]

    def _cells(self, states: list[dict]) -> np.ndarray:
        width = len(self.codes) + 1
        again = np.array([1, *(4 * width * states[0][c] for c in self.codes)], np.int32)  # a phrase begins, at the first state
        table = np.repeat(again[None, :] + np.int32(1), len(states), axis=0)
        table[0] = again
        for own, state in zip(table, states):
            for c, target in state.items():
                own[self.codes[c]] = 4 * width * target
        return table.ravel()

    def phrases(self, s: str) -> int:
        """Number of phrases of the greedy longest-match parse of ``s``."""
        if self.table is None:
            return self._phrases(s)
        found, state, cells, code = 0, 0, memoryview(self.table), self.codes.get
        for c in s:
            cell = cells[state + code(c, 0)]
            found += cell & 3
            state = cell >> 2
        return found + (state != 0)

    def _phrases(self, s: str) -> int:
        start = state = self.start
        found = 0
        for c in s:
            target = state.get(c)
            if target is None:  # the phrase ends before c, and c begins the next
                if state is not start:
                    found += 1
                target = start.get(c)
                if target is None:  # c is a phrase of its own
                    found += 1
                    target = start
            state = target
        return found + (state is not start)


def running(text: str) -> str:
    """The words of a text, letters in lower case, with a space around each; empty if there is no letter."""
    words = " ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).decode("utf-8", "surrogatepass").split())
    if words and not words.replace(" ", "").isalpha():  # others than letters beyond ASCII
        words = _BETWEEN.sub(" ", words).strip()
        if words and not words.replace(" ", "").isalpha():  # word characters that are no letters
            words = " ".join("".join(c if c.isalpha() else " " for c in words).split())
    return f" {words} " if words else ""


class Identifier:
    """Costs of texts under all languages. Those with tables parse many texts at a time, a character of each in a step."""

    def __init__(self, learned: dict[str, str]):
        self.languages = sorted(learned)
        self.automata = [SuffixAutomaton(learned[lang]) for lang in self.languages]
        self.bits = np.array([a.bits for a in self.automata])
        self.tabled = [i for i, a in enumerate(self.automata) if a.table is not None]
        tables = [self.automata[i].table for i in self.tabled]
        self.cells = np.concatenate(tables) if tables else np.zeros(0, np.int32)
        ends = np.cumsum([0, *map(len, tables)])
        letters = sorted({c for i in self.tabled for c in self.automata[i].codes})
        self.letter = np.zeros(0x110000, np.int32)  # 0: in no table
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.places = np.zeros((len(letters) + 1, len(tables)), np.int32)  # of a letter in the cells, from a state's first on
        for own, i, begin, end in zip(self.places.T, self.tabled, ends, ends[1:]):
            self.automata[i].table = self.cells[begin:end]
            own[:] = [begin, *(begin + self.automata[i].codes.get(c, 0) for c in letters)]
        gc.freeze()  # the automata stay; no collection needs to walk them again

    def _parsed(self, texts: list[str], state: np.ndarray) -> np.ndarray:
        """Phrases that end in texts, the longest first, under the languages with tables: those of a text side by side.
        ``state`` holds what the parses begin with and end in."""
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        places = self.places.take(self.letter.take(points), axis=0).ravel()  # the languages of a character side by side
        count, n = len(self.tabled), len(texts)
        lengths = np.fromiter(map(len, texts), np.int64, n)
        begins = (np.repeat((np.cumsum(lengths) - lengths) * count, count).reshape(n, count) + np.arange(count)).ravel()
        going = np.searchsorted(-lengths, -np.arange(lengths[0]), "left") * count  # parses that have a character at a step
        steps = int(np.sum(going >= FEW))
        found, at, cell = np.zeros(n * count, np.int64), np.zeros(n * count, np.int64), np.zeros(n * count, np.int32)
        for step, go in enumerate(going[:steps].tolist()):
            own_at, own_cell, own_state = at[:go], cell[:go], state[:go]
            np.add(own_state, places[step * count:].take(begins[:go], mode="clip"), out=own_at)
            self.cells.take(own_at, out=own_cell, mode="clip")
            np.right_shift(own_cell, 2, out=own_state)
            own_cell &= 3
            found[:go] += own_cell
        cells = memoryview(self.cells)
        for i in range(int(going[steps]) if steps < len(going) else 0):  # the few that are left go on alone
            begin, end = int(begins[i]), int(begins[i] + lengths[i // count] * count)
            own = int(state[i]) << 2
            for j in range(begin + steps * count, end, HANDED * count):
                passed = [own := cells[(own >> 2) + place] for place in places[j:min(end, j + HANDED * count):count].tolist()]
                found[i] += np.sum(np.array(passed) & 3)
            state[i] = own >> 2
        return found

    def all_costs(self, texts: list[str]) -> np.ndarray:
        """Costs of every text, a row of each, under all languages."""
        found = np.zeros((len(texts), len(self.automata)), np.int64)
        order = sorted((i for i in range(len(texts) if self.tabled else 0) if texts[i]), key=lambda i: -len(texts[i]))
        chars, at = max(1, TOGETHER // max(1, len(self.tabled))), 0
        while at < len(order):  # longest first: those parsed together are of like length
            some, room = [order[at]], chars - len(texts[order[at]])
            while at + len(some) < len(order) and (room := room - len(texts[order[at + len(some)]])) >= 0:
                some.append(order[at + len(some)])
            state = np.zeros(len(some) * len(self.tabled), np.int64)
            ended = 0
            for i in range(0, len(texts[some[0]]), chars):  # one step, but for a longer text, which is alone
                ended = ended + self._parsed([texts[k][i:i + chars] for k in some], state)
            found[np.ix_(some, self.tabled)] = (ended + (state != 0)).reshape(len(some), -1)
            at += len(some)
        for k, own in enumerate(self.automata):
            if own.table is None:
                found[:, k] = [own.phrases(s) for s in texts]
        return self.bits * found

    def costs(self, words: str) -> np.ndarray:
        return self.all_costs([words])[0]

    def predict(self, text: str | None) -> tuple[str, float, float | None]:
        """(language, score, bits a letter beyond the spare phrases)."""
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float, float | None]]:
        """``predict`` of every text."""
        words = [running(t) if t and self.languages else "" for t in texts]
        return [self._verdict(w, costs) if w else (UNKNOWN, 0.0, None) for w, costs in zip(words, self.all_costs(words))]

    def _verdict(self, words: str, costs: np.ndarray) -> tuple[str, float, float]:
        best = int(np.argmin(costs))
        letters = len(words) - words.count(" ")
        rate = max(0.0, costs[best] - SPARE_PHRASES * self.automata[best].bits) / letters
        return self.languages[best], float(1 / np.sum((costs[best] / costs) ** SHARPNESS)), float(rate)


def _labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str, held_out: tuple[int, int]) -> tuple[DataFrame, dict[str, int]]:
    """(lang, text, apart) of the labelled rows to learn from, and how many a language has. Copies of a text are on one
    side."""
    fold = F.coalesce(crc_mod(id_col, held_out[0]), F.lit(-1))
    known = docs.filter((fold != held_out[1]) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    many = F.col("lang").isin([lang for lang, n in counts.items() if n >= LEAST_ROWS])
    return known.withColumn("apart", many & (F.pmod(F.xxhash64(F.lit("apart"), "text"), F.lit(APART)) == 0)), counts


def _words_counted(known: DataFrame, longest: int) -> DataFrame:
    """(lang, first, n): words in all texts, n summed for as many as a task holds at a time."""

    def handed(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            words, found = list(own), list(own.values())
            for i in range(0, len(words), HANDED):
                cut = pa.array([w[:longest] for w in words[i:i + HANDED]], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(cut)), cut, pa.array(found[i:i + HANDED], pa.int64())], names=["lang", "first", "n"])
        counts.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_model("counts", dict)  # the model of an operator before this one goes
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for i, (lang, text) in enumerate(zip(batch.column("lang"), batch.column("text"))):
                counts[lang.as_py()].update(running(text.as_py()).split())
                if i % 256 == 0 and sum(map(len, counts.values())) > HELD:
                    yield from handed(counts)
        yield from handed(counts)

    return map_batches(known.select("lang", "text"), run, "lang string, first string, n long")


def _pairs_counted(known: DataFrame, longest: int, vocabulary: dict[str, list[str]]) -> DataFrame:
    """(lang, pair, n): pairs of words of the vocabulary that follow each other in all texts, n summed for as many as a task
    holds at a time. The pair is the first word's place times the number of the language's words, plus the second's place."""
    places = {lang: {w: i for i, w in enumerate(own)} for lang, own in vocabulary.items()}
    broadcast = known.sparkSession.sparkContext.broadcast(places)  # bounded by total_pieces

    def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[begins], np.add.reduceat(counts[order], begins)

    def handed(counts: dict[str, list]) -> Iterator[pa.RecordBatch]:
        for lang, runs in counts.items():
            for keys, found in runs:
                for i in range(0, len(keys), HANDED):
                    pairs, n = pa.array(keys[i:i + HANDED]), pa.array(found[i:i + HANDED])
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(pairs)), pairs, n], names=["lang", "pair", "n"])
        counts.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_model("counts", dict)  # the model of an operator before this one goes
        cut = {lang: any(len(w) == longest for w in own) for lang, own in broadcast.value.items()}
        read: dict[str, array] = defaultdict(lambda: array("i"))
        counts: dict[str, list] = defaultdict(list)

        def counted() -> None:
            for lang, own in read.items():
                ids = np.frombuffer(own, np.int32).astype(np.int64)
                both = (ids[:-1] >= 0) & (ids[1:] >= 0)
                keys, n = np.unique(ids[:-1][both] * len(broadcast.value[lang]) + ids[1:][both], return_counts=True)
                if len(keys):
                    counts[lang].append((keys, n.astype(np.int64)))
            read.clear()

        def merged() -> int:
            for lang, runs in counts.items():
                if len(runs) > 1:
                    counts[lang] = [summed(*map(np.concatenate, zip(*runs)))]
            return sum(len(keys) for runs in counts.values() for keys, _ in runs)

        for batch in batches:
            for i, (lang, text) in enumerate(zip(batch.column("lang"), batch.column("text"))):
                lang = lang.as_py()
                own = broadcast.value.get(lang)
                if own:
                    words = running(text.as_py()).split()
                    if cut[lang]:
                        words = [w[:longest] for w in words]
                    read[lang].extend(map(own.get, words, repeat(-1)))
                    read[lang].append(-1)
                if i % 256 == 0 and sum(map(len, read.values())) > HELD_PAIRS // 2:
                    counted()
                    if sum(len(keys) for runs in counts.values() for keys, _ in runs) > HELD_PAIRS and merged() > HELD_PAIRS // 2:
                        yield from handed(counts)
        counted()
        merged()
        yield from handed(counts)

    return map_batches(known.select("lang", "text"), run, "lang string, pair long, n long")


def _first(counted: DataFrame, what: str, most: int) -> DataFrame:
    """(lang, ``what``, rank) of each language's ``most`` most frequent, then by ``what``. Shares of a language are summed and
    ranked apart, so that a language is no single task's; only the first of each share, ``SHARES * most`` at most, are
    ranked together."""
    summed = counted.withColumn("share", F.pmod(F.xxhash64(what), F.lit(SHARES)).cast("int")).repartition("lang", "share").groupBy(
        "lang", "share", what).agg(F.sum("n").alias("n"))
    for apart in (["lang", "share"], ["lang"]):
        by_count = Window.partitionBy(*apart).orderBy(F.desc("n"), what)
        summed = summed.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= most)
    return summed.select("lang", what, "rank")


def _most_frequent(known: DataFrame, most: int, longest: int, vocabulary: dict[str, set[str]] | None = None) -> list:
    """(lang, first, second) of each language's ``most`` most frequent words (second empty) in all texts of ``known``, or
    with a vocabulary pairs of its words that follow each other; the most frequent first, then by code point."""
    by_rank = lambda df: sorted(df.collect(), key=lambda r: (r.lang, r["rank"]))
    if vocabulary is None:
        return [Row(lang=r.lang, first=r["first"], second="") for r in by_rank(_first(_words_counted(known, longest), "first", most))]
    words = {lang: sorted(own) for lang, own in vocabulary.items()}
    found = []
    for r in by_rank(_first(_pairs_counted(known, longest, words), "pair", most)):
        own = words[r.lang]
        first, second = divmod(r.pair, len(own))
        found.append(Row(lang=r.lang, first=own[first], second=own[second]))
    return found


def _fitting(parts: Iterable, room: int, taken) -> list:
    """The first parts that ``taken`` says find room together."""
    out = []
    for part in parts:
        room -= taken(part)
        if room < 0:
            break
        out.append(part)
    return out


def _along(pairs: list[tuple[str, str]]) -> list[str]:
    """Words that follow each other in every one of the pairs, from each on along its most frequent pair left."""
    after: dict[str, deque] = defaultdict(deque)
    for first, second in pairs:
        after[first].append(second)
    out: list[str] = []
    for word, _ in pairs:
        if after[word]:
            out.append(word)
        while after[word]:
            word = after[word].popleft()
            out.append(word)
    return out


def learn(
    docs: DataFrame, pieces: int = 150, piece_chars: int = 250, total_pieces: int = 800, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang", held_out: tuple[int, int] = (4, 2), keep_apart: bool = True,
) -> dict[str, str]:
    """Of each language a running text of its most frequent pairs of words, and behind it of its most frequent other words,
    half of the room for either, counted in all labelled rows whose crc32(id) is not ``held_out[1]`` modulo ``held_out[0]``
    (with ``keep_apart`` without those that ``bounds`` reads). Words count up to ``piece_chars`` characters. The catalogue of languages
    and words and pairs for ``total_pieces`` pieces of that length (one of each language at least) reach the driver."""
    known, counts = _labelled(docs, id_col, text_col, lang_col, held_out)
    if not counts:
        return {}
    if keep_apart:
        known = known.filter("not apart")
    room = max(1, min(pieces, total_pieces // len(counts))) * piece_chars
    most = max(1, room // WORD_CHARS)
    words: dict[str, list[str]] = defaultdict(list)
    for r in _most_frequent(known, most, piece_chars):
        words[r.lang].append(r["first"])
    pairs: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for r in _most_frequent(known, most, piece_chars, {lang: set(own) for lang, own in words.items()}):
        pairs[r.lang].append((r["first"], r["second"]))
    out = {}
    for lang, own in words.items():
        text = _along(_fitting(pairs[lang], room // 2, lambda pair: len(pair[1]) + 1))
        there = set(text)
        others = _fitting((w for w in own if w not in there), room - sum(len(w) + 1 for w in text), lambda w: len(w) + 1)
        out[lang] = f" {' '.join(text + others)} "
    return out


def prediction(docs: DataFrame, learned: dict[str, str], text: Column) -> Column:
    """struct(lang, score, rate) of a text column, rate as in ``Identifier.predict``."""
    key = hashlib.sha256(repr(sorted(learned.items())).encode()).hexdigest()
    broadcast = docs.sparkSession.sparkContext.broadcast(learned)  # bounded by total_pieces

    def values(texts: pa.Array) -> pa.Array:
        own = worker_model(f"languages {key}", lambda: Identifier(broadcast.value))
        found = own.predict_all(texts.to_pylist())
        lang, score, rate = zip(*found) if found else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())], names=["lang", "score", "rate"])

    return map_column(docs, text.cast("string"), values, "lang string, score double, rate double")


def bounds(
    docs: DataFrame, learned: dict[str, str], share: float = 0.995, slack: float = 1.5, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang", held_out: tuple[int, int] = (4, 2),
) -> dict[str, float]:
    """Bits a letter that texts of each language need: ``slack`` times what ``share`` of all its labelled texts that the
    counts leave out stay within. Languages of fewer than ``LEAST_ROWS`` labelled rows have no bound."""
    known, counts = _labelled(docs, id_col, text_col, lang_col, held_out)
    if not counts:
        return {}
    apart = known.filter(F.col("apart") & F.col("lang").isin(sorted(learned)))
    rated = apart.withColumn("p", prediction(apart, learned, F.col("text"))).filter("p.lang = lang")
    found = rated.groupBy("lang").agg(F.percentile_approx("p.rate", share, 10_000).alias("rate")).collect()
    return {r.lang: slack * r.rate for r in found}


def predict(docs: DataFrame, learned: dict[str, str], *keep: str, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, and lang_pred and score."""
    found = docs.select(*[F.col(f"`{c}`") for c in keep], prediction(docs, learned, F.col(f"`{text_col}`")).alias("__found"))
    return found.select(*[F.col(f"`{c}`") for c in keep], F.col("__found.lang").alias("lang_pred"), F.col("__found.score").alias("score"))


def recognised(
    docs: DataFrame, learned: dict[str, str], rates: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is in one of the learned languages: its predicted language is not
    ``und``, and its bits a letter are within that language's bound (languages without a bound have none). Bounds are
    those of ``docs`` unless given."""
    if rates is None:
        rates = bounds(docs, learned, id_col=id_col, text_col=text_col, lang_col=lang_col)
    found = F.col("__found")
    limit = F.create_map(*[F.lit(x) for pair in sorted(rates.items()) for x in pair])[found["lang"]] if rates else F.lit(None)
    return docs.withColumn("__found", prediction(docs, learned, F.col(f"`{text_col}`"))).filter(
        (found["lang"] != UNKNOWN) & F.coalesce(found["rate"] <= limit, F.lit(True))).select(*[F.col(f"`{c}`") for c in docs.columns])


def language_id(
    docs: DataFrame, pieces: int = 150, piece_chars: int = 250, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``, learned from all labelled rows that are not held out."""
    learned = learn(docs, pieces, piece_chars, id_col=id_col, text_col=text_col, lang_col=lang_col, keep_apart=False)
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(crc_mod(id_col, 4) == 2, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"))
    return predict(source, learned, "doc_id", "held_out")
