"""Substring dedup by seed and extend: every word inside a window of ``length`` consecutive words whose
sequence also starts earlier (smaller doc_id, or earlier in the same document) is removed.

1. *Seeds.* Of each window's k-grams (k = ``seed_words``) the one of smallest hash, the last among equals, is the
   window's anchor (winnowing): equal windows have equal anchors at equal places, so only places that share an
   anchor are joined, and windows whose anchor occurs once in the corpus are finished.
2. *Extension.* A seed is extended both ways over all windows that it anchors, to its context. Where the same
   context occurs earlier, all its windows do. Of every distinct context only the earliest occurrence goes on, and
   only at anchors with several contexts (the edges of copied passages); its windows are compared one by one.
3. *Maximal repeats.* The repeated windows of a document are merged to maximal runs of at least ``length``
   words, which are removed.

Nothing is expanded into pairs. A task resolves the repeats among its own rows before the shuffle, so a
passage in a third of all documents crosses it once per task and context. Anchors with more than ``_MANY`` contexts in
one task (a common short line in changing surroundings) are spread over tasks by context. Words, anchors and contexts are
compared by 64-bit hashes, a window by those of its words and its anchor.

Results for special input: null and empty texts have no words; texts shorter than a window keep all words; rows
that share id and text are one document and get the same result; rows that share an id only come in the order of
a hash of their text; null ids come after all others; an empty table gives an empty table; other columns are
ignored (``without_repeats`` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_batches, map_rows, written

LENGTH = 20
SEED_WORDS = 8
#: Odd multipliers of the rolling hash over words, and the number whose multiples mix its bits.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of each number spread over all 64."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words: built from runs of half the length."""
    n = len(words)
    if n < k:
        return np.zeros(0, np.uint64)
    out, have, unit, size = None, 0, words, 1
    while True:
        if k & size:
            if out is None:
                out, have = unit[:n - size + 1], size
            else:  # what is there, followed by a unit
                m = n - have - size + 1
                out, have = _mixed(out[:m] * _STEP + unit[have:have + m] + np.uint64(have)), have + size
        if have == k:
            return out[:n - k + 1]
        m = n - 2 * size + 1
        unit, size = _mixed(unit[:m] * _STEP + unit[size:size + m] + np.uint64(size)), size * 2


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` k-grams the place of its smallest, the last among equals (winnowing)."""
    n = len(grams) - width + 1
    best, place, size = grams, np.arange(len(grams)), 1
    levels = []
    while True:  # minima over runs of 1, 2, 4, ...; two that overlap make any width
        levels.append((best, place))
        if 2 * size > width:
            break
        m = len(best) - size
        later = best[size:] <= best[:m]
        best, place = np.where(later, best[size:], best[:m]), np.where(later, place[size:], place[:m])
        size *= 2
    best, place = levels[-1]
    shift = width - size
    later = best[shift:shift + n] <= best[:n]
    return np.where(later, place[shift:shift + n], place[:n])


def seeds(words: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Of a document's word hashes: each anchor's place and hash, first and last window that it anchors, and the
    hash of its context, which says what all those windows hold and how far they reach to either side."""
    width = length - k + 1
    grams = runs(words, k)
    at = anchors(grams, width)  # window start -> place of its anchor; never falls
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:] - 1, len(at) - 1]
    place = at[first]
    # The context: the words of all windows, first[i] to last[i] + length - 1, as its first and last window and the
    # distances; windows between are covered by these two, which overlap, since there are at most ``width``.
    window = runs(words, length)
    context = _mixed(window[first] * _STEP + window[last])
    context = _mixed(context * _STEP + (place - first).astype(np.uint64) * np.uint64(length + 1) + (last - first).astype(np.uint64))
    return place, grams[place], first, last, context


#: More contexts of an anchor than these in one task: its rows are dealt by context.
_MANY = 16
_WITNESS = np.uint64(0)
_MARK = ("kind", "anchor", "context", "d", "pack")
_FLUSH_SEEDS = 500_000
_LAST_ID = 9223372036854775807


def identified(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """(d, t, body): the id, null as the largest, and 27 bits of the text's hash, which tell rows of one id apart."""
    body = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("d"),
        F.shiftrightunsigned(F.xxhash64(body), 37).alias("t"), body.alias("body"), *more,
    )


def _packed(t: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Text bits, first window and number of windows (32 at most) in one number that sorts like them."""
    return (t.astype(np.uint64) << np.uint64(37)) | (start.astype(np.uint64) << np.uint64(5)) | (count - 1).astype(np.uint64)


def _runs_of(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before it in some of the columns."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _marks(kind, anchor, context, d, pack) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(np.broadcast_to(kind, anchor.shape).astype(np.int8)), pa.array(anchor.view(np.int64)),
        pa.array(context.view(np.int64)), pa.array(d), pa.array(pack.view(np.int64)),
    ], names=list(_MARK))


def _collapse(anchor: np.ndarray, context: np.ndarray, d: np.ndarray, pack: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Marks of one task's seeds. Kind 0: repeated, as the context occurs earlier in the task. Kind 1: the task's
    earliest of its context. Kind 2: the same at an anchor of many contexts, of which a witness of kind 1 tells."""
    order = np.lexsort((pack, d, context, anchor))
    anchor, context, d, pack = anchor[order], context[order], d[order], pack[order]
    new = _runs_of(anchor, context)
    again = ~new & _runs_of(d, pack)  # not the same place of a repeated row
    if again.any():
        n = int(again.sum())
        yield _marks(0, np.zeros(n, np.uint64), np.zeros(n, np.uint64), d[again], pack[again])
    anchor, context, d, pack = anchor[new], context[new], d[new], pack[new]
    starts = np.flatnonzero(_runs_of(anchor))
    many = np.repeat(np.diff(np.r_[starts, len(anchor)]) > _MANY, np.diff(np.r_[starts, len(anchor)]))
    yield _marks(np.where(many, 2, 1), anchor, context, d, pack)
    if many.any():
        hot = np.unique(anchor[many])
        zero = np.zeros(len(hot), np.uint64)
        yield _marks(1, hot, zero + _WITNESS, zero.view(np.int64), zero)


def _resolve(kind, anchor, context, d, pack) -> pa.RecordBatch | None:
    """Marks of whole anchors: kind 0 for places whose context occurs earlier, kind 1 for the earliest of each
    context of an anchor that has several."""
    found = []
    done = kind == 0
    if done.any():
        found.append((np.zeros(int(done.sum()), np.int8), anchor[done], context[done], d[done], pack[done]))
    open_ = ~done
    if open_.any():
        kind, anchor, context, d, pack = (x[open_] for x in (kind, anchor, context, d, pack))
        starts = np.flatnonzero(_runs_of(kind, anchor))
        sizes = np.diff(np.r_[starts, len(anchor)])
        some = np.repeat(sizes > 1, sizes) | (kind == 2)
        kind, anchor, context, d, pack = (x[some] for x in (kind, anchor, context, d, pack))
        if len(kind):
            order = np.lexsort((pack, d, context, anchor, kind))
            kind, anchor, context, d, pack = (x[order] for x in (kind, anchor, context, d, pack))
            new = _runs_of(kind, anchor, context)
            again = ~new & _runs_of(d, pack)
            starts = np.flatnonzero(_runs_of(kind, anchor))
            contexts = np.add.reduceat(new.astype(np.int64), starts)
            several = np.repeat(contexts > 1, np.diff(np.r_[starts, len(kind)])) | (kind == 2)
            edge = new & several & (context != _WITNESS)
            for k, rows in ((0, again & (context != _WITNESS)), (1, edge)):
                if rows.any():
                    found.append((np.full(int(rows.sum()), k, np.int8), anchor[rows], context[rows], d[rows], pack[rows]))
    if not found:
        return None
    return _marks(*(np.concatenate([f[i] for f in found]) for i in range(5)))


def _resolved(marks: DataFrame, name: str) -> DataFrame:
    """The shuffle: rows of an anchor meet, or those of a context where an anchor has many; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in _MARK)
            now = now[0], now[1].view(np.uint64), now[2].view(np.uint64), now[3], now[4].view(np.uint64)
            same = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            last = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0  # where the last anchor begins
            if last or (waiting and (waiting[0][0][0], waiting[0][1][0]) != (now[0][0], now[1][0])):
                whole = [np.concatenate([*(w[i] for w in waiting), now[i][:last]]) for i in range(5)]
                waiting = []
                out = _resolve(*whole)
                if out is not None:
                    yield out
            waiting.append(tuple(x[last:] for x in now))
        if waiting:
            out = _resolve(*(np.concatenate([w[i] for w in waiting]) for i in range(5)))
            if out is not None:
                yield out

    route = F.when(F.col("kind") == 0, F.xxhash64("d", "pack")).when(F.col("kind") == 1, F.xxhash64("anchor")).otherwise(
        F.xxhash64("anchor", "context"))
    dealt = marks.repartition(route).sortWithinPartitions("kind", "anchor")
    return written(map_batches(dealt, run, _SCHEMA), name)


_SCHEMA = "kind byte, anchor long, context long, d long, pack long"


def _flushed(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Collapsed marks of (anchor, context, d, pack) parts, so many at a time as memory is meant to hold."""
    waiting: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for part in parts:
        waiting.append(part)
        rows += len(part[0])
        if rows >= _FLUSH_SEEDS:
            yield from _collapse(*(np.concatenate([w[i] for w in waiting]) for i in range(4)))
            waiting, rows = [], 0
    if rows:
        yield from _collapse(*(np.concatenate([w[i] for w in waiting]) for i in range(4)))


def seed_marks(keyed: DataFrame, length: int, k: int) -> DataFrame:
    """Marks of all anchors of all documents."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            ids, bits = batch.column("d").to_numpy(), batch.column("t").to_numpy()
            for i, body in enumerate(batch.column("body")):
                words = body.as_py().split()
                if len(words) >= length:
                    place, gram, first, last, context = seeds(word_hashes(words), length, k)
                    n = len(place)
                    yield gram, np.maximum(context, np.uint64(1)), np.full(n, ids[i]), _packed(np.full(n, bits[i]), first, last - first + 1)

    return map_batches(keyed, lambda batches: _flushed(parts(batches)), _SCHEMA)


def edge_marks(keyed: DataFrame, edges: DataFrame, length: int) -> DataFrame:
    """Marks of the single windows at the edges: a window is its own anchor, its context the seed's anchor."""
    t = F.shiftrightunsigned("pack", 37).alias("t")
    of_doc = edges.groupBy("d", t).agg(F.collect_list(F.struct("anchor", "pack")).alias("edges"))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            ids, bits = batch.column("d").to_numpy(), batch.column("t").to_numpy()
            for i, (body, own) in enumerate(zip(batch.column("body"), batch.column("edges"))):
                anchor = own.values.field("anchor").to_numpy(zero_copy_only=False).view(np.uint64)
                pack = own.values.field("pack").to_numpy(zero_copy_only=False).view(np.uint64)
                windows = runs(word_hashes(body.as_py().split()), length)
                count = (pack & np.uint64(31)).astype(np.int64) + 1
                first = ((pack >> np.uint64(5)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
                start = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                n = len(start)
                yield (windows[start], np.maximum(np.repeat(anchor, count), np.uint64(1)), np.full(n, ids[i]),
                       _packed(np.full(n, bits[i]), start, np.ones(n, np.int64)))

    return map_batches(keyed.join(of_doc, ["d", "t"]), lambda batches: _flushed(parts(batches)), _SCHEMA)


def repeats(keyed: DataFrame, length: int = LENGTH, k: int = SEED_WORDS) -> DataFrame:
    """(d, t, packs): of every document with repeated windows, these as (first window, number) packs."""
    if not 1 <= k <= length or length - k + 1 > 32:
        raise ValueError("a window must hold a seed, and no more than 32 of them")
    marks = _resolved(seed_marks(keyed, length, k), "substring-seeds")
    edges = _resolved(edge_marks(keyed, marks.filter("kind = 1"), length), "substring-edges")
    covered = marks.unionByName(edges).filter("kind = 0").select("d", "pack").distinct()
    return covered.groupBy("d", F.shiftrightunsigned("pack", 37).alias("t")).agg(F.collect_list("pack").alias("packs"))


def removed_words(n_words: int, packs: np.ndarray, length: int) -> np.ndarray:
    """Which words the maximal repeats cover: the windows' starts and ends, summed up."""
    pack = packs.view(np.uint64)
    first = ((pack >> np.uint64(5)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = first + (pack & np.uint64(31)).astype(np.int64) + length  # behind the last window's last word
    change = np.bincount(first, minlength=n_words + 1) - np.bincount(ends, minlength=n_words + 1)
    return np.cumsum(change)[:n_words] > 0


def _kept(body: bytes, packs, length: int) -> tuple[list[bytes], int]:
    """The words that stay, and the number of all."""
    words = body.split()
    if packs is None or not len(packs):
        return words, len(words)
    gone = removed_words(len(words), packs, length)
    return [words[i] for i in np.flatnonzero(~gone)], len(words)


def _packs(value) -> np.ndarray | None:
    return value.values.to_numpy(zero_copy_only=False) if value.is_valid else None


def substring_digest(
    docs: DataFrame, length: int = LENGTH, k: int = SEED_WORDS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by a space) for every row of ``docs``."""
    keyed = identified(docs, id_col, text_col)
    joined = identified(docs, id_col, text_col, F.col(id_col).cast("long").alias("doc_id")).join(
        repeats(keyed, length, k), ["d", "t"], "left").select("doc_id", "body", "packs")

    def rows(batch: pa.RecordBatch) -> dict:
        n_words, n_removed, sha = [], [], []
        for body, packs in zip(batch.column("body"), batch.column("packs")):
            kept, n = _kept(body.as_py(), _packs(packs), length)
            n_words.append(n)
            n_removed.append(n - len(kept))
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return {
            "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string()),
        }

    return map_rows(joined, rows, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(
    docs: DataFrame, length: int = LENGTH, k: int = SEED_WORDS, id_col: str = "doc_id", text_col: str = "text",
    chars_col: str | None = None,
) -> DataFrame:
    """The rows of ``docs``, all columns. Texts that lose words are their kept words, joined by a space, and
    ``chars_col``, if named, their new length; documents that lose all words go; all others stay as they are."""
    d, t, packs = (free_name(docs, c) for c in ("own_d", "own_t", "own_packs"))
    body = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    tagged = docs.withColumn(d, F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID))).withColumn(
        t, F.shiftrightunsigned(F.xxhash64(body), 37))
    found = repeats(identified(docs, id_col, text_col), length, k).toDF(d, t, packs)
    joined = tagged.join(found, [d, t], "left").select(*[F.col(f"`{c}`") for c in docs.columns], packs)
    names = docs.columns
    text_at, chars_at = names.index(text_col), names.index(chars_col) if chars_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns[:-1])
            own = batch.column(len(names))
            touched = np.flatnonzero(own.is_valid().to_numpy(zero_copy_only=False))
            if len(touched):
                texts = columns[text_at].to_pylist()
                chars = columns[chars_at].to_pylist() if chars_col else []
                stays = np.ones(batch.num_rows, bool)
                for i in touched.tolist():
                    kept, _ = _kept(texts[i].encode(), _packs(own[i]), length)
                    texts[i] = b" ".join(kept).decode()
                    stays[i] = bool(kept)
                    if chars_col:
                        chars[i] = len(texts[i])
                columns[text_at] = pa.array(texts, columns[text_at].type)
                if chars_col:
                    columns[chars_at] = pa.array(chars, columns[chars_at].type)
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(stays))
            elif batch.num_rows:
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(joined, run, docs.schema)
