"""Embedding near-duplicates by lattice hashing.

Every table projects the unit vectors at random to ``blocks`` blocks of 8 dimensions, scales them and decodes
each block to its nearest point of the E8 lattice: the points together are the vector's home cell. A vector also
probes the ``probes`` neighbouring cells that lie closest. In each cell the vectors at home are compared with all
that are at home or probe there, by cosine in double precision. A pair may meet more than once; it is counted at
its first meeting only, which both sides can tell from the two vectors (earlier tables first, and in one table the
smaller key's home), so no list of pairs is ever written or made distinct. What leaves a cell is one row for each
linked vector: the links it got there and a link to a representative of its group.

Equal vectors are one class from the start (copies count as links of each other). A cell with more
comparisons than ``cell_work`` is split: its homes are dealt over chunks, and those they are compared with go to all.

The tables are random, so a pair close to the threshold can be missed; ``tests/llm`` measure recall against brute
force (0.9 is asked for, and the default parameters are held to more). No pair below the threshold is linked.

Results for special input: null and zero vectors, and those that hold null or non-finite components, link with
nothing; vectors of different length never link; rows that repeat a vector are copies, whatever their ids; a null
id counts as a copy and a link and is never the smallest; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, written
from .components import component_labels

_LAST_ID = 9223372036854775807


@dataclass(frozen=True)
class Lattice:
    """Tables, blocks of 8 dimensions in each, size of the lattice's unit, neighbouring cells to probe."""

    tables: int = 6
    blocks: int = 2
    unit: float = 0.25
    probes: int = 4
    seed: int = 7
    cell_work: int = 1 << 26


# ---------------------------------------------------------------- the lattice

def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or all of +-1/2 with an even number of minus signs."""
    out = []
    for a, b in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = [0.0] * 8
            v[a], v[b] = s, t
            out.append(v)
    out += [list(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


NEIGHBOURS = _minimal_vectors()


def _nearest_d8(z: np.ndarray) -> np.ndarray:
    """Nearest points with whole entries of even sum: round, and where the sum is odd, the worst entry the other way."""
    p = np.rint(z)
    off = z - p
    worst = np.abs(off).argmax(axis=1)
    rows = np.arange(len(z))
    odd = (p.sum(axis=1) % 2 != 0).astype(float)
    p[rows, worst] += odd * np.where(off[rows, worst] >= 0, 1.0, -1.0)
    return p


def nearest_e8(z: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the union of D8 and D8 moved by 1/2 in all entries."""
    a, b = _nearest_d8(z), _nearest_d8(z - 0.5) + 0.5
    return np.where((((z - a) ** 2).sum(axis=1) <= ((z - b) ** 2).sum(axis=1))[:, None], a, b)


def _projection(dim: int, lattice: Lattice, t: int) -> np.ndarray:
    """Rows of a random orthogonal matrix (as many as the dimension allows), divided by the unit."""
    rng = np.random.default_rng([lattice.seed, t, dim])
    want = 8 * lattice.blocks
    parts = []
    while sum(map(len, parts)) < want:
        parts.append(np.linalg.qr(rng.standard_normal((dim, dim)))[0].T[:want])
    return np.concatenate(parts)[:want] / lattice.unit


def _key(t: int, dim: int, points: np.ndarray) -> np.ndarray:
    """One number for each row of lattice points (whole or half entries), table and dimension."""
    out = np.full(points.shape[0], np.uint64((t + 1) * 1_000_003 + dim), np.uint64)
    twice = np.rint(points * 2).astype(np.int64).view(np.uint64)
    for column in twice.T:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def cells(unit_vectors: np.ndarray, lattice: Lattice, t: int) -> np.ndarray:
    """Of each vector the home cell of table t, and the neighbouring cells that it probes: 1 + probes columns."""
    n, dim = unit_vectors.shape
    z = unit_vectors @ _projection(dim, lattice, t).T
    points = np.concatenate([nearest_e8(z[:, 8 * b:8 * b + 8]) for b in range(lattice.blocks)], axis=1)
    # Squared distance to a neighbour, less that to home, is 2 - 2 r.v; the lowest over all blocks are probed.
    extra = np.concatenate([
        2 - 2 * (z[:, 8 * b:8 * b + 8] - points[:, 8 * b:8 * b + 8]) @ NEIGHBOURS.T for b in range(lattice.blocks)], axis=1)
    out = np.empty((n, 1 + lattice.probes), np.int64)
    out[:, 0] = _key(t, dim, points)
    best = np.argsort(extra, axis=1, kind="stable")[:, :lattice.probes]
    for k in range(lattice.probes):
        block, which = np.divmod(best[:, k], len(NEIGHBOURS))
        near = points.copy()
        for b in range(lattice.blocks):
            rows = block == b
            near[rows, 8 * b:8 * b + 8] += NEIGHBOURS[which[rows]]
        out[:, 1 + k] = _key(t, dim, near)
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by their length, in double precision and safe from overflow."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


# ---------------------------------------------------------------- Spark stages

def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) of a column of arrays, for each length of vector."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else lengths
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield rows, flat[starts[rows][:, None] + np.arange(dim)]


def placed(classes: DataFrame, lattice: Lattice, with_vectors: bool) -> DataFrame:
    """(cell, own, table[, id, h, n, v]): every class at its home cells (own) and at those that it probes."""
    kind = classes.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for every, vectors in _by_length(batch.column("v")):
                for at in range(0, len(every), 2048):
                    rows, u = every[at:at + 2048], unit(vectors[at:at + 2048])
                    for t in range(lattice.tables):
                        found = cells(u, lattice, t)
                        own = np.zeros(found.shape, bool)
                        own[:, 0] = True
                        cols = {"cell": pa.array(found.ravel()), "own": pa.array(own.ravel())}
                        if with_vectors:
                            take = pa.array(np.repeat(rows, found.shape[1]))
                            cols["t"] = pa.array(np.full(found.size, t, np.int32))
                            cols |= {c: batch.column(c).take(take) for c in ("id", "h", "n", "v")}
                        yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    more = f", t int, id long, h long, n long, v {kind}" if with_vectors else ""
    return map_batches(classes, run, f"cell long, own boolean{more}")


def _groups(pairs_i: np.ndarray, pairs_j: np.ndarray, n: int) -> np.ndarray:
    """Smallest row of the connected group of each of n rows."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, pairs_i, label[pairs_j])
        np.minimum.at(label, pairs_j, label[pairs_i])
        label = label[label]
        if (label == before).all():
            return label


def _first_meeting(u, i, j, t, id_, h, lattice: Lattice) -> np.ndarray:
    """Of pairs (i at home in a cell of table t, j at home or probing there) those that meet here first."""
    used, inverse = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b = inverse[:len(i)], inverse[len(i):]
    ok = np.ones(len(i), bool)
    smaller = (id_[i] < id_[j]) | ((id_[i] == id_[j]) & (h[i] < h[j]))
    for s in range(t + 1):
        found = cells(u[used], lattice, s)
        home = found[:, 0]
        reached = lambda x, y: (found[y] == home[x][:, None]).any(axis=1)  # noqa: E731  x's home by y
        if s < t:
            ok &= ~(reached(a, b) | reached(b, a))
        else:
            ok &= smaller | ~reached(b, a)  # else it meets at j's home too, or again in this cell, the other way
    return ok


def _links_of(batch_cols: dict[str, np.ndarray], u: np.ndarray, threshold: float, lattice: Lattice) -> pa.RecordBatch | None:
    """Counts and group links of whole cells of sorted rows of one length and table."""
    cell, chunk, own, id_, h, n = (batch_cols[c] for c in ("cell", "chunk", "own", "id", "h", "n"))
    new = np.r_[True, (cell[1:] != cell[:-1]) | (chunk[1:] != chunk[:-1])]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, len(cell)])
    which = np.cumsum(new) - 1
    table = int(batch_cols["t"][0])
    links = np.zeros(len(cell), np.int64)
    found_i, found_j = [], []

    def keep(i: np.ndarray, j: np.ndarray) -> None:
        differ = (id_[i] != id_[j]) | (h[i] != h[j])
        i, j = i[differ], j[differ]
        if len(i):
            first = _first_meeting(u, i, j, table, id_, h, lattice)
            i, j = i[first], j[first]
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            found_i.append(i)
            found_j.append(j)

    homes = np.flatnonzero(own & (sizes[which] > 1) & (sizes[which] <= 256))
    per = sizes[which[homes]]
    cuts = np.searchsorted(np.cumsum(per), np.arange(0, int(per.sum()) + 1, 100_000)[1:]) if len(per) else []
    for part in np.split(np.arange(len(homes)), cuts):
        if len(part):
            i = np.repeat(homes[part], per[part])
            j = starts[which[i]] + np.arange(len(i)) - np.repeat(np.cumsum(per[part]) - per[part], per[part])
            near = np.einsum("ij,ij->i", u[i], u[j]) >= threshold
            keep(i[near], j[near])
    for k in np.flatnonzero(sizes > 256):
        rows = np.arange(starts[k], starts[k] + sizes[k])
        at_home = rows[own[rows]]
        for a in range(0, len(at_home), 512):
            for b in range(0, len(rows), 2048):
                near = np.argwhere(u[at_home[a:a + 512]] @ u[rows[b:b + 2048]].T >= threshold)
                keep(at_home[a:a + 512][near[:, 0]], rows[b:b + 2048][near[:, 1]])
    if not found_i:
        return None
    group = _groups(np.concatenate(found_i), np.concatenate(found_j), len(cell))
    out = np.flatnonzero((links > 0) | (group != np.arange(len(cell))))
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (id_[out], h[out], links[out], id_[group[out]], h[group[out]])],
        names=["id", "h", "links", "to_id", "to_h"])


def _compared(rows: DataFrame, threshold: float, lattice: Lattice) -> DataFrame:
    def emit(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        cols = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "chunk", "own", "id", "h", "n", "t")}
        for part, vectors in _by_length(table.column("v")):  # a cell's vectors have one length and table
            own = {c: x[part] for c, x in cols.items()}
            u = unit(vectors)
            for t in np.unique(own["t"]):
                of = own["t"] == t
                out = _links_of({c: x[of] for c, x in own.items()}, u[of], threshold, lattice)
                if out is not None:
                    yield out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, chunk = batch.column("cell").to_numpy(), batch.column("chunk").to_numpy()
            same = (cell == cell[-1]) & (chunk == chunk[-1])
            last = 0 if same.all() else len(same) - int(np.argmin(same[::-1]))
            first = (cell[0], chunk[0])
            if last or (waiting and (waiting[0].column("cell")[0].as_py(), waiting[0].column("chunk")[0].as_py()) != first):
                whole = [*waiting, batch.slice(0, last)] if last else waiting
                waiting = []
                yield from emit(whole)
            waiting.append(batch.slice(last))
        if waiting:
            yield from emit(waiting)

    dealt = rows.repartition("cell", "chunk").sortWithinPartitions("cell", "chunk")
    return map_batches(dealt, run, "id long, h long, links long, to_id long, to_h long")


def near_duplicates(
    embeddings: DataFrame, threshold: float = 0.95, lattice: Lattice = Lattice(), id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``embeddings``."""
    usable = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        "v", lambda x: x != 0)
    source = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).withColumn(
        "h", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("v")))
    # Rows of one class have the same vector; the hash stands for it beside the class's smallest id.
    classes = written(
        source.filter("h is not null").groupBy("v", "h").agg(
            F.coalesce(F.min("vec_id"), F.lit(_LAST_ID)).alias("id"), F.count("*").alias("n")), "embedding-classes")
    work = placed(classes, lattice, False).groupBy("cell").agg(
        (F.sum(F.col("own").cast("long")) * F.count("*")).alias("work")).filter(F.col("work") > lattice.cell_work)
    large = written(work.select("cell", F.ceil(F.col("work") / lattice.cell_work).cast("long").alias("chunks")), "embedding-large")
    rows = placed(classes, lattice, True)
    if large.isEmpty():
        rows = rows.withColumn("chunk", F.lit(0).cast("long"))
    else:
        rows = rows.join(large, "cell", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn(
            "chunk", F.explode(F.expr("sequence(0L, chunks - 1)"))).withColumn(
            "own", F.col("own") & (F.pmod("h", "chunks") == F.col("chunk"))).drop("chunks")
    found = written(_compared(rows, threshold, lattice), "embedding-links")
    node, to = F.struct("id", "h"), F.struct(F.col("to_id").alias("id"), F.col("to_h").alias("h"))
    labels = component_labels(found.select(node.alias("a"), to.alias("b"))).select(
        F.col("node.id").alias("id"), F.col("node.h").alias("h"), "label.id")
    labels = labels.toDF("id", "h", "component")
    counts = found.groupBy("id", "h").agg(F.sum("links").alias("links"))
    per_class = classes.select("id", "h", "n", "v").join(counts, ["id", "h"], "left").join(labels, ["id", "h"], "left").select(
        "v", "h", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component"))
    joined = source.join(per_class.drop("v"), "h", "left")
    component = F.when(F.col("component") != _LAST_ID, F.col("component"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("h").isNull(), F.col("vec_id")).otherwise(component).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
