"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents fall into a fixed number of blocks per source. From the blocks' word counts follow each
source's target, how many whole passes over its blocks the mix takes, and which blocks, in random
order, fill what is left. That gives exact block quotas per source. A binary tree then splits the
quotas: each node deals half of its blocks to the left child, their sources drawn without replacement
from a multivariate hypergeometric distribution, until the leaves, the output shards, are reached.
Each shard draws its quota from its sources' permuted blocks, disjoint from all others, and is
shuffled within itself. All draws come from hashes of a seed, so reruns agree.

The block table has at most sources x blocks rows, however large the documents are.

Defined results: NULL or empty texts have size 0 and are taken with their block. A NULL source is a source,
the last one. Repeated rows fall into the same block and each counts. Where all sizes are 0, nothing
is taken; an empty table gives no rows. Other columns are passed through, except for names this
operator adds, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendgrain.llm.common import cut, n_words

ADDED = ["size", "source_size", "target", "shards"]


def block_table(sized: DataFrame) -> DataFrame:
    return sized.groupBy("source", "block").agg(F.sum("size").alias("words"))


def targets(by_source: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """by_source: source, source_size. Adds source_index (by code point, NULL last), weight and target:
    a share of all words dealt by weight, none above `most` times its source's size."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = by_source.withColumn("source_index", F.row_number().over(by_name) - 1).withColumn(
        "weight", cycle[F.col("source_index") % len(weights)]
    )
    # Sources reach their limit in the order of limit over weight. One has reached it if dealing the
    # rest among those from here on would put it above.
    rows = rows.withColumn("limit", most * F.col("source_size"))
    filling = Window.orderBy(F.col("limit") / F.col("weight"), "source_index")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = (
        rows.withColumn("full_words", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("dealt", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("level", (F.col("dealt") - F.col("full_words")) / F.col("open_weight"))
    )
    # The level of the first open source holds for all; the ones after it only appear lower.
    level = F.max(F.when(F.col("level") * F.col("weight") < F.col("limit"), F.col("level"))).over(everything)
    target = F.least("limit", F.coalesce(level * F.col("weight"), F.col("limit")))
    return rows.select("source", "source_index", "source_size", target.alias("target"))


def quotas(blocks: DataFrame, goals: DataFrame, most: int, seed: int) -> DataFrame:
    """For each block, copies: how often the mix takes it. Whole passes first; then blocks in random
    order, each that still fits into what is left of the target. Where more than half of the source
    is left, the blocks to leave out are chosen that way."""
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    rows = goals.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)).withColumn("rest", rest)
    order = F.xxhash64(F.lit(seed), F.lit("fill"), "source_index", "block")
    rows = rows.withColumnRenamed("source", "goal_source").withColumn("leaves_out", F.col("rest") > F.col("source_size") / 2)
    rows = rows.withColumn("room", F.when(F.col("leaves_out"), F.col("source_size") - F.col("rest")).otherwise(F.col("rest")))
    packed = (
        blocks.join(rows, F.col("source").eqNullSafe(F.col("goal_source")))
        .groupBy("source", "source_index", "source_size", "target", "passes", "room", "leaves_out")
        .agg(F.sort_array(F.collect_list(F.struct(order.alias("rank"), "block", "words"))).alias("blocks"))
    )
    start = F.struct(F.lit(0).cast("bigint").alias("words"), F.array().cast("array<boolean>").alias("takes"))

    def fill(done, block):
        fits = (block["words"] > 0) & (done["words"] + block["words"] <= F.col("room"))
        return F.struct(
            (done["words"] + F.when(fits, block["words"]).otherwise(0)).cast("bigint").alias("words"),
            F.array_append(done["takes"], fits != F.col("leaves_out")).alias("takes"),
        )

    taken = F.arrays_zip(F.col("blocks"), F.aggregate("blocks", start, fill)["takes"].alias("takes"))
    copies = F.least(F.lit(most), F.col("passes") + F.col("taken.takes").cast("int")).cast("int")
    return packed.select("source", "source_index", "source_size", "target", "passes", F.explode(taken).alias("taken")).select(
        "source", "source_index", "source_size", "target", F.col("taken.blocks.block").alias("block"), copies.alias("copies")
    )


#: One hypergeometric draw: of {total} blocks {good} are of the source, {drawn} go left, {u} is uniform.
#: The distribution is walked from 12 deviations below the mean to 12 above; what lies beyond is less
#: than the rounding of a double. Twice: once for the sum of the weights, once to the uniform share.
_LOW = "greatest(0L, {drawn} - ({total} - {good}), cast(floor({mean} - 12 * {sd} - 12) as bigint))"
_HIGH = "least({drawn}, {good}, cast(ceil({mean} + 12 * {sd} + 12) as bigint))"
_NEXT = "(({good} - x) * 1D * ({drawn} - x) / ((x + 1D) * ({total} - {good} - {drawn} + x + 1D)))"
_DRAW = (
    "aggregate(sequence({low}, {high}),"
    " named_struct('w', 1D, 'sum', 0D, 'at', {low}, 'goal', {u} * aggregate(sequence({low}, {high}), named_struct('w', 1D, 'sum', 0D),"
    " (s, x) -> named_struct('w', s.w * {next}, 'sum', s.sum + s.w), s -> s.sum)),"
    " (s, x) -> named_struct('w', s.w * {next}, 'sum', s.sum + s.w, 'at', if(s.sum <= s.goal, x, s.at), 'goal', s.goal),"
    " s -> s.at)"
)


def hypergeometric(total: str, good: str, drawn: str, u: str) -> str:
    """SQL for how many of `drawn` blocks out of `total` are among the `good` ones."""
    part = {"total": total, "good": good, "drawn": drawn, "u": u}
    part["mean"] = f"({drawn} * 1D * {good} / greatest({total}, 1L))"
    part["sd"] = f"sqrt({part['mean']} * ({total} - {good}) / greatest({total}, 1L) * ({total} - {drawn}) / greatest({total} - 1L, 1L))"
    for name, text in (("low", _LOW), ("high", _HIGH), ("next", _NEXT)):
        part[name] = text.format(**part)
    return _DRAW.format(**part)


def split_tree(by_source: DataFrame, depth: int, seed: int) -> DataFrame:
    """by_source: source_index (0 and up, without gaps) and quota. Returns shard, source_index and n:
    the quotas of 2^depth shards, which add up to the sources' quotas."""
    root = by_source.agg(F.sort_array(F.collect_list(F.struct("source_index", "quota"))).alias("q")).selectExpr("1L AS node", "q.quota AS counts")
    draw = hypergeometric("acc.total", "counts[i]", "acc.half", "acc.u[i]")
    for _ in range(depth):
        u = f"transform(counts, (c, i) -> pmod(xxhash64({seed}, node, i), 9007199254740992L) / 9007199254740992D)"
        start = "aggregate(counts, 0L, (s, c) -> s + c)"
        left = (
            "aggregate(sequence(0, size(counts) - 1),"
            f" named_struct('left', cast(array() as array<bigint>), 'total', {start}, 'half', {start} div 2L, 'u', {u}),"
            f" (acc, i) -> transform(array({draw}), d -> named_struct('left', array_append(acc.left, d), 'total', acc.total - counts[i], 'half', acc.half - d, 'u', acc.u))[0],"
            " acc -> acc.left)"
        )
        # The draw is bound to a name, so that it is worked out once.
        root = root.where("size(counts) > 0").selectExpr("node", "counts", f"{left} AS lefts")
        root = root.selectExpr(
            "inline(array(named_struct('node', 2L * node, 'counts', lefts),"
            " named_struct('node', 2L * node + 1L, 'counts', zip_with(counts, lefts, (c, l) -> c - l))))"
        )
    return root.selectExpr(f"CAST(node - {1 << depth} AS INT) AS shard", "posexplode(counts) AS (source_index, n)")


def deal(copies: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """Each source's block copies, permuted, are cut into the shards' quotas: source, block, shards."""
    before = Window.partitionBy("source_index").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = leaves.withColumn("end", F.sum("n").over(before)).groupBy("source_index").agg(F.sort_array(F.collect_list("end")).alias("ends"))
    slots = copies.select("*", F.explode(F.expr("sequence(1, copies)")).alias("copy")).where("copies > 0")
    permuted = Window.partitionBy("source_index").orderBy(F.xxhash64(F.lit(seed), F.lit("deal"), "source_index", "block", "copy"), "block", "copy")
    slots = slots.withColumn("slot", F.row_number().over(permuted) - 1).join(ends, "source_index")
    shard = F.size(F.filter("ends", lambda e: e <= F.col("slot")))
    return slots.withColumn("shard", shard).groupBy("source_index", "block").agg(F.sort_array(F.collect_list("shard")).alias("shards"))


def mix(
    documents: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    blocks: int = 512,
    depth: int = 4,
    seed: int = 20,
) -> DataFrame:
    """documents with size (words), source_size, target (words of its source the mix aims at) and
    shards: one entry per copy of the document that the mix takes, of 2^depth shards. weights are
    dealt to the sources in the order of their names, again and again."""
    documents = documents.drop(*ADDED)
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(blocks)).cast("int")
    sized = documents.withColumn("size", n_words(F.col("text"))).withColumn("mix_block", place)
    table = cut(block_table(sized.select("source", "size", F.col("mix_block").alias("block"))))
    goals = targets(table.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    copies = cut(quotas(table, goals, most, seed))
    leaves = split_tree(copies.groupBy("source_index").agg(F.sum("copies").cast("bigint").alias("quota")), depth, seed)
    dealt = copies.join(deal(copies, leaves, seed), ["source_index", "block"], "left").select(
        F.col("source").alias("mix_source"), F.col("block").alias("mixed_block"), "source_size", "target",
        F.coalesce("shards", F.array().cast("array<int>")).alias("shards"),
    )
    same = F.col("source").eqNullSafe(F.col("mix_source")) & (F.col("mix_block") == F.col("mixed_block"))
    return sized.join(cut(dealt), same).drop("mix_block", "mix_source", "mixed_block")


def draw(mixed: DataFrame, seed: int = 20) -> DataFrame:
    """One row per copy: the documents with shard and place, the copy's place in its shuffled shard
    (random and unique for different documents; sort by it within the shard when writing)."""
    copies = mixed.select("*", F.posexplode("shards").alias("copy", "shard")).drop(*ADDED)
    return copies.withColumn("place", F.xxhash64(F.lit(seed), "shard", "doc_id", "text", "copy")).drop("copy")
