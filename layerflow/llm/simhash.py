"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64 bits of whole texts. Equal ones are one node. Two that differ in at most ``distance`` bits
must be found without comparing all pairs: the bits are cut into two parts of 31 bits (two bits are left
over), and by pigeonhole such a pair differs in at most t1 bits of the first or t2 of the second part, with
t1 + t2 + 1 = distance. On 31 bits the Hamming code is a perfect covering code of radius 1: its words are the
anchors. Every fingerprint has one home anchor within radius 1, and is replicated to every anchor within radius
1 + t; a pair within t bits then meets at the home of either, so only anchors from the own home upward are
used (half of them). Fingerprints are compared per anchor, all 64 bits, against those that are at home there.

A cell of an anchor may hold many near copies. It is never expanded into pairs: fingerprints of a cell fall to
leaders (first not within ``distance`` of an earlier leader), which links each to its leader; then only leaders'
groups that are not yet connected and whose leaders are within 3 x ``distance`` are compared, in blocks, up to
their first link. What leaves a cell is a spanning forest: fewer links than fingerprints, and the same
components. Components are joined over all cells by star contraction on written tables.

Results for special input: texts with fewer words than a shingle are one shingle of all their words; texts
without words, null and empty ones have fingerprint zero, which links like any other; repeated rows share
fingerprint and component; a null id gets its component's smallest id that is not null (null if there is none); an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, id_and_bytes, map_batches, map_rows, written
from .components import component_labels

SHINGLE_WORDS = 4
SEED = 42
#: Bits of a part and the code's check bits: a Hamming code of 2**5 - 1 bits.
PART_BITS, CHECK_BITS = 31, 5
PART_MASK = np.uint64((1 << PART_BITS) - 1)


# ---------------------------------------------------------------- fingerprints

def fingerprint(body: bytes, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Majority bits of the shingles' XXH64. ``bytes.lower`` changes A-Z only; ``bytes.split`` knows the same white space."""
    from xxhash import xxh64_intdigest

    words = body.lower().split()
    n = len(words)
    if not n:
        return 0
    if n <= shingle:
        return xxh64_intdigest(b" ".join(words), seed)
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1  # the place behind each word
    starts = np.concatenate(([0], ends[:-1] + 1))
    counts = np.zeros(64, np.int64)
    total = n - shingle + 1
    step = 1 << 16  # a very long text is counted in blocks
    for at in range(0, total, step):
        stop = min(total, at + step)
        hashes = np.fromiter(
            (xxh64_intdigest(text[a:b], seed) for a, b in zip(starts[at:stop].tolist(), ends[at + shingle - 1:stop + shingle - 1].tolist())),
            np.uint64, stop - at,
        )
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in range(64) if 2 * counts[i] > total))


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, fp): ``fp`` holds the 64 bits as a signed long."""

    def rows(batch: pa.RecordBatch) -> dict:
        found = [fingerprint(body.as_py(), shingle, seed) for body in batch.column("body")]
        return {"doc_id": batch.column("doc_id"), "fp": pa.array(np.array(found, np.uint64).view(np.int64))}

    return map_rows(id_and_bytes(docs, id_col, text_col), rows, "doc_id long, fp long")


# ---------------------------------------------------------------- anchors

def syndrome(words: np.ndarray) -> np.ndarray:
    """Of 31-bit words: the exclusive or of the places (1 to 31) of their bits; 0 for a code word."""
    out = np.zeros(words.shape, np.uint64)
    for place in range(1, PART_BITS + 1):
        out ^= np.uint64(place) * ((words >> np.uint64(place - 1)) & np.uint64(1))
    return out


def home(words: np.ndarray) -> np.ndarray:
    """The code word within distance 1; there is exactly one."""
    s = syndrome(words)
    return words ^ np.where(s > 0, np.uint64(1) << (np.maximum(s, np.uint64(1)) - np.uint64(1)), np.uint64(0))


def code_words(weight: int) -> np.ndarray:
    """All words of the Hamming code up to a weight (4 at most)."""
    bit = lambda place: 1 << (place - 1)
    out = [0]
    for a in range(1, PART_BITS + 1):
        for b in range(a + 1, PART_BITS + 1):
            if weight >= 3 and (c := a ^ b) > b:
                out.append(bit(a) | bit(b) | bit(c))
            if weight >= 4:
                for c in range(b + 1, PART_BITS + 1):
                    if (d := a ^ b ^ c) > c:
                        out.append(bit(a) | bit(b) | bit(c) | bit(d))
    return np.array(out, np.uint64)


def anchor_steps(radius: int) -> list[np.ndarray]:
    """For each syndrome: the code words to add to a word's home to get all anchors within ``radius`` of the word."""
    words = code_words(radius + 1)
    error = [np.uint64(0)] + [np.uint64(1 << (s - 1)) for s in range(1, PART_BITS + 1)]
    return [words[np.bitwise_count(words ^ e) <= radius] for e in error]


def thresholds(distance: int) -> tuple[int, int]:
    """Bits that the first and the second part may differ in: t1 + t2 + 1 = distance."""
    if not 1 <= distance <= 5:
        raise ValueError("the covering of two 31-bit parts serves distances from 1 to 5")
    return (distance - 1) - (distance - 1) // 2, (distance - 1) // 2


def replicas(fps: DataFrame, distance: int) -> DataFrame:
    """(cell, fp, own): every fingerprint at its home anchors (own) and at those within radius + threshold from
    the home upward. A cell is the anchor with the part's number above its bits."""
    parts = [(shift, k, anchor_steps(1 + t)) for k, (shift, t) in enumerate(zip((0, PART_BITS), thresholds(distance)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(every), 4096):
                fp = every[at:at + 4096]
                for shift, k, steps in parts:
                    words = (fp >> np.uint64(shift)) & PART_MASK
                    at_home, s = home(words), syndrome(words)
                    for value in np.unique(s):
                        of = s == value
                        anchors = at_home[of][:, None] ^ steps[int(value)][None, :]
                        upward = anchors >= at_home[of][:, None]
                        rows, _ = np.nonzero(upward)
                        cells = anchors[upward] | np.uint64(k << PART_BITS)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(cells.view(np.int64)), pa.array(fp[of][rows].view(np.int64)),
                            pa.array(anchors[upward] == at_home[of][rows]),
                        ], names=["cell", "fp", "own"])

    return map_batches(fps, run, "cell long, fp long, own boolean")


# ---------------------------------------------------------------- comparison in cells

class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def cell_links(fp: np.ndarray, distance: int, block: int = 2048) -> list[tuple[int, int]]:
    """Links (places in ``fp``) of a spanning forest of the fingerprints within ``distance`` of each other."""
    n, links = len(fp), []
    forest = _Forest(n)
    left = np.arange(n)
    leaders: list[int] = []
    groups: list[np.ndarray] = []
    while len(left):
        lead = int(left[0])
        near = np.bitwise_count(fp[left] ^ fp[lead]) <= distance
        own = left[near]
        for i in own[1:].tolist():
            forest.join(lead, i)
            links.append((lead, i))
        leaders.append(lead)
        groups.append(own)
        left = left[~near]
    lead_fp = fp[leaders]
    for i in range(len(leaders) - 1):
        later = np.nonzero(np.bitwise_count(lead_fp[i + 1:] ^ lead_fp[i]) <= 3 * distance)[0] + i + 1
        for j in later.tolist():
            if forest.root(leaders[i]) == forest.root(leaders[j]):
                continue
            for a in range(0, len(groups[i]), block):
                rows = groups[i][a:a + block]
                found = None
                for b in range(0, len(groups[j]), block):
                    cols = groups[j][b:b + block]
                    hit = np.argwhere(np.bitwise_count(fp[rows][:, None] ^ fp[cols][None, :]) <= distance)
                    if len(hit):
                        found = int(rows[hit[0][0]]), int(cols[hit[0][1]])
                        break
                if found:
                    forest.join(*found)
                    links.append(found)
                    break
    return links


def links_in_cells(placed: DataFrame, distance: int) -> DataFrame:
    """(a, b): links of all cells. Rows come sorted by cell, and cells without a fingerprint at home, or with one
    only, are passed over at once; what is left of a partition's last cell waits for the next batch."""

    def emit(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = (np.concatenate([x[i] for x in found]).view(np.int64) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def cells(cell: np.ndarray, fp: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links of whole cells. Small cells compare neighbours at home with all others of the cell, vectorised."""
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        sizes = np.diff(np.r_[starts, len(cell)])
        at_home = np.add.reduceat(own.astype(np.int64), starts)
        for k in np.flatnonzero((sizes > 1) & (at_home > 0)):
            s, e = starts[k], starts[k] + sizes[k]
            rows = fp[s:e]
            if sizes[k] == 2:
                if np.bitwise_count(rows[0] ^ rows[1]) <= distance:
                    yield rows[:1], rows[1:]
            elif at_home[k] <= 4:
                for x in rows[own[s:e]]:
                    near = rows[(np.bitwise_count(rows ^ x) <= distance) & (rows != x)]
                    if len(near):
                        yield np.full(len(near), x), near
            elif links := cell_links(rows, distance):
                i = np.array(links)
                yield rows[i[:, 0]], rows[i[:, 1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "fp", "own"))
            now = now[0], now[1].view(np.uint64), now[2].astype(bool)
            last = int(np.searchsorted(now[0], now[0][-1], "left"))  # where the batch's last cell begins
            if waiting and (last or waiting[0][0][0] != now[0][0]):
                whole = [np.concatenate([*(w[i] for w in waiting), now[i][:last]]) for i in range(3)]
                waiting = []
            else:
                whole = [x[:last] for x in now] if not waiting else None
            if whole is not None and len(whole[0]) and (found := list(cells(*whole))):
                yield emit(found)
            waiting.append(tuple(x[last:] for x in now))
        if waiting and (found := list(cells(*(np.concatenate([w[i] for w in waiting]) for i in range(3))))):
            yield emit(found)

    return map_batches(placed.repartition("cell").sortWithinPartitions("cell"), run, "a long, b long")


def _per_fingerprint(found: DataFrame, distance: int) -> DataFrame:
    """(fp, label): the component of every fingerprint, by its smallest fingerprint."""
    classes = found.select("fp").distinct()
    labels = component_labels(links_in_cells(replicas(classes, distance), distance))
    return classes.join(labels, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("label", "fp").alias("label"))


def near_duplicates(
    docs: DataFrame, distance: int = 4, shingle: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of ``docs``."""
    found = written(fingerprints(docs, shingle, SEED, id_col, text_col), "simhash-fingerprints")
    labels = written(_per_fingerprint(found, distance), "simhash-labels")
    own = found.groupBy("fp").agg(F.min("doc_id").alias("least")).join(labels, "fp")
    least = own.groupBy("label").agg(F.min("least").alias("component_id"))
    per_fp = labels.join(least, "label").select("fp", "component_id")
    return found.join(per_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, distance: int = 4, shingle: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each component stays: that of the smallest id (null last),
    among rows of one id that of the smallest hash of its text, and of equal rows any one."""
    text_hash = F.xxhash64(F.col(text_col).cast("string"))
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), text_hash.alias("th"))

    def rows(batch: pa.RecordBatch) -> dict:
        found = [fingerprint(text or b"", shingle, SEED) for text in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "th": batch.column("th"), "fp": pa.array(np.array(found, np.uint64).view(np.int64))}

    found = written(map_rows(
        keyed.withColumn("text", F.col("text").cast("binary")), rows, "doc_id long, th long, fp long"), "simhash-fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th")
    kept = found.groupBy("fp").agg(F.min(first).alias("first")).join(_per_fingerprint(found, distance), "fp").groupBy("label").agg(
        F.min("first").alias("first"))
    kept = written(kept.select("first.doc_id", "first.th"), "simhash-kept")
    own_id, own_hash = free_name(docs, "own_id"), free_name(docs, "own_hash")
    keys = kept.select(F.coalesce("doc_id", F.lit(-1)).alias(own_id), F.struct(F.col("doc_id").isNull(), "th").alias(own_hash))
    tagged = docs.withColumn(own_id, F.coalesce(F.col(id_col).cast("long"), F.lit(-1))).withColumn(
        own_hash, F.struct(F.col(id_col).isNull(), text_hash))
    out = tagged.join(keys, [own_id, own_hash], "left_semi")
    repeated = found.groupBy("doc_id", "th").count().filter("count > 1")
    if not repeated.isEmpty():  # equal rows have all passed; the first is aggregated before the shuffle
        out = out.dropDuplicates([own_id, own_hash])
    return out.drop(own_id, own_hash)
