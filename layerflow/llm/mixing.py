"""Mixing sources to target weights, with DataFrame and SQL functions only.

1. *Targets.* Every source gets ``share`` of all words in proportion to its weight, but no more than
   ``cap`` times its own words; what exceeds that is shared again by weight among the others (water
   filling: one level per unit of weight, found with running sums over the source catalogue).
2. *Blocks.* Documents fall into blocks of their source by a hash. A source is taken whole as often as
   its target allows; for the rest, blocks are drawn without replacement in a permuted order up to the
   target, and then on, passing over blocks that do not fit; one more block fills the gap if some block comes nearer.
   Of these sums the nearest to the target counts. So all counts are exact block quotas.
3. *Splitting tree.* The quotas of all sources are divided among the output shards by a binary tree. At
   each node the left half's share of every source is a draw from the multivariate hypergeometric
   distribution (a chain of hypergeometric draws, inverted from their mode outward), so shards are exact
   random parts of the mix, of equal size. Quotas become ranges of each source's permuted blocks: the
   shards' blocks are disjoint.
4. *Local shuffle.* A document goes to its block's shards, and is ordered inside each by a hash.

All draws are hashes of a seed and the place in the tree, so reruns agree. ``takes`` counts what the tree deals, and
``mixed`` deals the rows by the same tree. What is shuffled is numbers; texts move, and are sorted, only in ``mixed``.
Windows run over the catalogue of sources, and over the blocks of one source, which hold ``block_words`` each beyond
the first ``least_blocks``; never over documents.

Results for special input: null and empty texts have size 0 and are taken with their block; the null source
is a source like any other, sorted last; repeated rows are documents of their own; an empty table gives an
empty table and a table without words targets 0; other columns are kept by ``mixed`` and ignored elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, written


#: Running sums of a draw of blocks: each but the first passes over all blocks that are larger than the gap.
DRAWS = 4


@dataclass(frozen=True)
class Mix:
    """What a mix is to be. ``weights`` repeat over the sources in code point order, null last."""

    weights: Sequence[float] = (3, 1, 2)
    share: float = 1.5
    cap: float = 2.0
    block_words: int = 1 << 24
    least_blocks: int = 1024
    shard_words: int = 1 << 23
    seed: int = 1


def word_count(text: Column) -> Column:
    """Number of words of a text, null as none."""
    trimmed = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, f"[{WHITE}]+"))).cast("long")


def _source_key(source: Column) -> Column:
    """The source as text that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _place(doc_id: Column, text: Column) -> Column:
    """Hash of a document, which decides its block."""
    return F.xxhash64(F.lit(1), doc_id.cast("long"), text.cast("string"))


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source_key, place (hash that decides the block) and size; written, as all else starts from it."""
    return written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _source_key(F.col(source_col)).alias("source_key"),
        _place(F.col(id_col), F.col(text_col)).alias("place"),
        word_count(F.col(text_col)).alias("size"),
    ), "mix-sizes")


def targets(sized: DataFrame, mix: Mix) -> DataFrame:
    """source_key, source_rank (from 0), source_size, target. One row for each source."""
    catalogue = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy((F.col("source_key") == "n").asc(), "source_key")
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    ranked = catalogue.withColumn("source_rank", F.row_number().over(in_order) - 1).withColumn(
        "weight", F.element_at(weights, (F.col("source_rank") % len(mix.weights) + 1).cast("int")),
    ).withColumn("most", F.col("source_size") * F.lit(float(mix.cap)))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), "source_rank").rowsBetween(Window.unboundedPreceding, -1)
    level = ranked.withColumn(
        # If all sources before this one, by most / weight, are full: what a unit of weight of the others gets.
        "level",
        (F.sum("source_size").over(everything) * F.lit(float(mix.share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    ).withColumn("level", F.max(F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level"))).over(everything))
    return level.select(
        "source_key", "source_rank", "source_size",
        F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most")).alias("target"),
    )


def blocks(sized: DataFrame, mix: Mix, n_blocks: int) -> DataFrame:
    """source_key, block, copies and the catalogue's columns: how often the mix takes each block."""
    own = sized.groupBy("source_key", F.pmod("place", F.lit(n_blocks)).alias("block")).agg(F.sum("size").alias("words"))
    own = own.join(targets(sized, mix), "source_key")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    own = own.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    source = Window.partitionBy("source_key")
    own = own.withColumn("at", F.xxhash64(F.lit(mix.seed), F.lit("draw"), "source_key", "block"))
    permuted = source.orderBy("at", "block").rowsBetween(Window.unboundedPreceding, 0)
    drawn, gap = F.col("drawn"), F.col("gap")
    own = own.withColumns({"drawn": F.lit(False), "gap": F.col("rest"), "taken": F.lit(False), "miss": F.lit(math.inf)})
    for k in range(DRAWS):
        # A running sum ends at a block that overflows; the next one goes on with the later blocks that fit the gap.
        fits = ~drawn & (F.col("words") > 0) & (F.col("words") <= gap) if k else F.lit(True)
        own = own.withColumn("fits", fits).withColumn("sum", F.sum(F.when(F.col("fits"), F.col("words")).otherwise(0)).over(permuted))
        own = own.withColumn("drawn", drawn | (F.col("fits") & (F.col("sum") <= gap)))
        own = own.withColumn("gap", F.col("rest") - F.sum(F.when(drawn, F.col("words")).otherwise(0)).over(source))
        # The block that comes nearest to the gap joins if that is better. Of all sums, the nearest to the target is taken.
        off = F.struct(F.abs(F.col("words") - gap).alias("off"), "block")
        own = own.withColumn("filler", F.min(F.when(~drawn, off)).over(source))
        fills = F.coalesce(F.col("filler.off") < gap, F.lit(False))
        own = own.withColumn("now", F.when(fills, F.col("filler.off")).otherwise(gap))
        better = F.col("now") < F.col("miss")
        own = own.withColumn("taken", F.when(better, drawn | (fills & (F.col("block") == F.col("filler.block")))).otherwise(F.col("taken")))
        own = own.withColumn("miss", F.least("miss", "now"))
    return own.select(
        "source_key", "block", "words", "source_rank", "source_size", "target",
        F.least(F.col("whole") + F.col("taken").cast("long"), F.lit(math.floor(mix.cap)).cast("long")).alias("copies"),
    )


def block_count(sized: DataFrame, mix: Mix) -> int:
    """Blocks of every source: from the number of all words, so blocks do not grow with the data."""
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return max(mix.least_blocks, math.ceil(total / mix.block_words))


# ---------------------------------------------------------------- the splitting tree

def _ln_factorial(n: str) -> str:
    """ln(n!) as SQL: Stirling's series eight places on, and back."""
    y = f"(({n}) + 9.0D)"
    back = " + ".join(f"ln(({n}) + {k}.0D)" for k in range(1, 9))
    return f"(({y} - 0.5D) * ln({y}) - {y} + 0.9189385332046727D + 1 / (12 * {y}) - 1 / (360 * power({y}, 3)) - ({back}))"


def _choose(n: str, k: str) -> str:
    return f"({_ln_factorial(n)} - {_ln_factorial(k)} - {_ln_factorial(f'({n}) - ({k})')})"


def hypergeometric(pop: str, good: str, taken: str, u: str) -> str:
    """SQL for the number of ``good`` among ``taken`` of ``pop``, from a uniform ``u``: probabilities are
    subtracted from ``u`` from the mode outward (its variables begin with _, so columns keep their names). 12 standard deviations hold all that doubles can tell."""
    low, high = f"greatest(0L, {taken} - ({pop} - {good}))", f"least({good}, {taken})"
    mode = f"least({high}, greatest({low}, cast(floor(({good} + 1D) * ({taken} + 1D) / ({pop} + 2D)) as bigint)))"
    steps = (f"cast(least({high} - {low}, 10 + ceil(12 * sqrt({taken} * 1D * {good} / greatest({pop}, 1L) "
             f"* ({pop} - {good}) / greatest({pop}, 1L)))) as bigint)")
    p0 = f"exp({_choose(good, '_m')} + {_choose(f'{pop} - {good}', f'{taken} - _m')} - {_choose(pop, taken)})"
    # State: what is left of u, next places and their probabilities above and below, the result (-1: none yet).
    up = f"(_a.pu * ({good} - _a.ku) * ({taken} - _a.ku) / ((_a.ku + 1D) * ({pop} - {good} - {taken} + _a.ku + 1D)))"
    down = f"(_a.pd * _a.kd * ({pop} - {good} - {taken} + _a.kd) / (({good} - _a.kd + 1D) * ({taken} - _a.kd + 1D)))"
    first = f"named_struct('u', {u} - _p, 'ku', _m, 'pu', _p, 'kd', _m, 'pd', _p, 'r', if({u} < _p, _m, -1L))"
    step = (
        "if(_a.r >= 0, _a, transform(array(named_struct("
        f"'x', if(_a.ku < {high}, {up}, 0D), 'y', if(_a.kd > {low}, {down}, 0D))), _w -> named_struct("
        "'u', _a.u - _w.x - _w.y, "
        f"'ku', if(_a.ku < {high}, _a.ku + 1, _a.ku), 'pu', _w.x, 'kd', if(_a.kd > {low}, _a.kd - 1, _a.kd), 'pd', _w.y, "
        "'r', case when _w.x > 0 and _a.u < _w.x then _a.ku + 1 when _w.y > 0 and _a.u < _w.x + _w.y then _a.kd - 1 else -1L end))[0])"
    )
    draw = f"aggregate(sequence(0L, {steps}), {first}, (_a, _i) -> {step}, _a -> if(_a.r >= 0, _a.r, _m))"
    return f"transform(array({mode}), _m -> transform(array({p0}), _p -> {draw})[0])[0]"


def split_quotas(quotas: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """(shard, source_rank, quota) of one row ``counts`` (array: blocks of each source), by the splitting tree."""
    draw = hypergeometric(
        "s.pop", "q", "s.want",
        f"((xxhash64({seed}, 'split', lo, hi, size(s.out)) & 9007199254740991L) / 9007199254740992D)",
    )
    shard_end = lambda k: f"cast(floor(({k}) * cast(total as decimal(38, 0)) / {n_shards}) as bigint)"
    nodes = quotas.selectExpr("0L as lo", f"{n_shards}L as hi", "counts", "aggregate(counts, 0L, (a, q) -> a + q) as total")
    for level in range(max(0, math.ceil(math.log2(n_shards)))):
        nodes = nodes.selectExpr("*", "(lo + hi) div 2 as mid").selectExpr(
            "*",
            "if(hi - lo < 2, counts, aggregate(counts, named_struct('pop', aggregate(counts, 0L, (a, q) -> a + q), "
            f"'want', {shard_end('mid')} - {shard_end('lo')}, 'out', cast(array() as array<bigint>)), "
            f"(s, q) -> transform(array({draw}), x -> named_struct('pop', s.pop - q, 'want', s.want - x, "
            "'out', concat(s.out, array(x))))[0], s -> s.out)) as taken",
        ).selectExpr(
            "total",
            "explode(if(hi - lo < 2, array(named_struct('lo', lo, 'hi', hi, 'counts', counts)), array("
            "named_struct('lo', lo, 'hi', mid, 'counts', taken), "
            "named_struct('lo', mid, 'hi', hi, 'counts', zip_with(counts, taken, (a, b) -> a - b))))) as node",
        ).selectExpr("node.lo as lo", "node.hi as hi", "node.counts as counts", "total")
        if level in (6, 12):  # deeper nodes are drawn by many tasks
            nodes = nodes.repartition("lo")
    return nodes.select(F.col("lo").alias("shard"), F.posexplode("counts").alias("source_rank", "quota"))


def block_shards(per_block: DataFrame, mix: Mix, n_shards: int) -> DataFrame:
    """source_key, block, shards: the shard of every copy of a block (no more copies than ``cap`` allows)."""
    items = per_block.select("source_key", "source_rank", "block", F.explode(F.expr(
        "if(copies > 0, sequence(1L, copies), cast(array() as array<bigint>))")).alias("pass"))
    in_source = Window.partitionBy("source_rank").orderBy(
        F.xxhash64(F.lit(mix.seed), F.lit("deal"), "source_key", "block", "pass"), "block", "pass")
    items = items.withColumn("place", F.row_number().over(in_source).cast("long"))
    per_source = per_block.groupBy("source_rank").agg(F.sum("copies").alias("n"))
    counts = per_source.agg(F.expr("transform(array_sort(collect_list(struct(source_rank, n))), x -> x.n)").alias("counts"))
    quotas = split_quotas(counts, n_shards, mix.seed)
    until = F.sum("quota").over(Window.partitionBy("source_rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
    ranges = quotas.withColumn("until", until).filter("quota > 0").select(
        "source_rank", "shard", F.explode(F.expr("sequence(until - quota + 1, until)")).alias("place"))
    dealt = items.join(ranges, ["source_rank", "place"])
    return dealt.groupBy("source_key", "block").agg(F.array_sort(F.collect_list("shard")).alias("shards"))


def shard_count(per_block: DataFrame, mix: Mix) -> int:
    words = per_block.agg(F.coalesce(F.sum(F.col("words") * F.col("copies")), F.lit(0))).first()[0]
    return max(1, math.ceil(words / mix.shard_words))


def _block(place: Column, n_blocks: int) -> Column:
    return F.pmod(place, F.lit(n_blocks)).alias("block")


def _order(mix: Mix, shard: Column, copy: Column, doc_id: Column, place: Column) -> Column:
    """What the local shuffle orders a copy of a document by, inside its shard."""
    return F.xxhash64(F.lit(mix.seed), F.lit("order"), shard, copy, doc_id, place)


def _dealt_blocks(sized: DataFrame, mix: Mix) -> tuple[int, int, DataFrame, DataFrame]:
    """Numbers of blocks and shards, what ``blocks`` says, and the shards that the tree deals the blocks to; both written."""
    n_blocks = block_count(sized, mix)
    per_block = written(blocks(sized, mix, n_blocks), "mix-blocks")
    n_shards = shard_count(per_block, mix)
    return n_blocks, n_shards, per_block, written(block_shards(per_block, mix, n_shards), "mix-shards")


def takes(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, dealt: how many words of every document the mix takes, as the
    tree deals its block, and for each copy its shard and what the local shuffle orders it by there."""
    sized = sizes(docs, id_col, text_col, source_col)
    n_blocks, _, per_block, shards = _dealt_blocks(sized, mix)
    of_block = per_block.select("source_key", "block", "source_size", "target").join(shards, ["source_key", "block"], "left")
    rows = sized.withColumn("block", _block(F.col("place"), n_blocks)).join(of_block, ["source_key", "block"])
    shards_of = F.coalesce("shards", F.array().cast("array<bigint>"))
    dealt = F.transform(shards_of, lambda shard, copy: F.struct(
        shard.alias("shard"), _order(mix, shard, copy, F.col("doc_id"), F.col("place")).alias("order")))
    copies = F.size(shards_of).cast("long")
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"),
        dealt.alias("dealt"),
    )


def mixed(
    docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    shard_col: str | None = None,
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, dealt to shards (one partition
    holds whole shards) and shuffled inside them. ``shard_col`` names a column for the shard, if wanted."""
    sized = sizes(docs, id_col, text_col, source_col)
    n_blocks, n_shards, _, shards = _dealt_blocks(sized, mix)
    place = _place(F.col(id_col), F.col(text_col))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _source_key(F.col(source_col)).alias("source_key"),
        place.alias("place"), _block(place, n_blocks),
    )
    dealt = rows.join(shards, ["source_key", "block"]).select("row", "place", F.posexplode("shards").alias("copy", "shard"))
    order = _order(mix, F.col("shard"), F.col("copy"), F.col(f"row.`{id_col}`").cast("long"), F.col("place"))
    dealt = dealt.repartition(max(1, n_shards), "shard").sortWithinPartitions("shard", order)
    extra = [F.col("shard").alias(shard_col)] if shard_col else []
    return dealt.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], *extra)
