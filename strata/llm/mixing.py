"""Operator 6: mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. ``targets``: sources by code point (null last) weigh 5, 2, 1, repeating, and
   share ``SHARE`` of all words; a target stops at ``MAX_REPEATS`` times its
   source's size and the excess is shared anew by weight.
2. ``draw``: the documents of a source are dealt by hash into blocks, the blocks
   are permuted.  A pass takes all blocks, or those up to the target; the block
   on the edge is taken in part, document by document, in up to ``FILLS`` rounds
   that skip what no longer fits, and a last document if that comes nearer.
   What is missing to a target beyond one whole pass comes from a second pass.
3. ``split``: the drawn block quotas per source are split exactly among the
   output shards, by a binary tree whose nodes draw from the multivariate
   hypergeometric distribution; leaves take disjoint ranges of each source's
   permuted blocks, and every shard is shuffled locally by a hash.

Every random choice comes from hashes of the seed, source, document and pass,
so reruns agree.  Only sums per (source, block) are ever gathered: a source
with any share of the rows is summed map-side, and sorting happens within one
block of a source.  Tables per source (targets, quotas) are
handled in one task; their size is the number of distinct sources.

Defined results: a null text has size 0 and is taken 0 times, like any text
without words; a null source is a source of its own, the last; equal rows are
told apart by nothing and so are taken alike up to the edge, where the written
order decides; an empty table gives an empty table.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from strata.llm.common import WORD, again, cut, pack, unpack

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEATS = 2
BLOCKS = 4096     # most blocks of a source; smaller sources have blocks of about BLOCK_ROWS rows
BLOCK_ROWS = 32
FILLS = 4
LANE_WORDS = 2_000_000   # words that one task writes, about
SHARDS = 8
SEED = 20


def allot(sizes: np.ndarray, weights: np.ndarray, share: float = SHARE, repeats: int = MAX_REPEATS) -> np.ndarray:
    """Targets per source: shares by weight, stopped at ``repeats`` sizes, the excess shared anew until none is above."""
    total = share * float(sizes.sum())
    limit = repeats * sizes.astype(float)
    target, open_ = np.zeros(len(sizes)), limit > 0
    while open_.any():
        part = np.where(open_, weights, 0.0)
        offer = total * part / part.sum()
        above = open_ & (offer > limit)
        if not above.any():
            target[open_] = offer[open_]
            break
        target[above] = limit[above]
        total -= float(limit[above].sum())
        open_ &= ~above
    return target


def hypergeometric_split(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources) counts: a binary tree that splits exact quotas, each node by one multivariate draw."""
    if shards == 1:
        return quotas[None, :]
    left_shards = shards // 2
    left_total = int(quotas.sum()) * left_shards // shards
    left = rng.multivariate_hypergeometric(quotas, left_total, method="marginals") if quotas.sum() else quotas
    return np.vstack([hypergeometric_split(left, left_shards, rng), hypergeometric_split(quotas - left, shards - left_shards, rng)])


def targets(spark: SparkSession, sized: DataFrame) -> DataFrame:
    """(source, source_size, source_rows, target) from rows with __source and __size; one row per source."""
    sums = sized.groupBy("__source").agg(F.sum("__size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        order = sorted(range(len(pdf)), key=lambda i: (pdf["__source"].iloc[i] is None, pdf["__source"].iloc[i] or ""))
        pdf = pdf.iloc[order].reset_index(drop=True)
        weights = np.array([WEIGHTS[i % len(WEIGHTS)] for i in range(len(pdf))])
        pdf["target"] = allot(pdf["source_size"].to_numpy(dtype=np.int64), weights)
        return pdf[["__source", "source_size", "source_rows", "target"]]

    return sums.groupBy(F.lit(0).alias("__all")).applyInPandas(run, "__source string, source_size long, source_rows long, target double")


def _unit(*parts) -> F.Column:
    return F.xxhash64(F.lit(SEED), *parts)


def draw(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` packed (``__row``) with __key, __source, __size, source_size, target, block, pass and taken per pass > 0.

    ``docs`` has __row, __key (any stable hash of the row), __source and __size.
    """
    plan = cut(spark, targets(spark, docs), "mix-targets")
    same = F.col("d.__source").eqNullSafe(F.col("p.__source"))
    rows = docs.alias("d").join(plan.alias("p"), same).select("d.*", "p.source_size", "p.source_rows", "p.target")
    passes = F.array(*[F.struct(F.lit(k).alias("pass"), F.least(F.greatest(F.col("target") - F.col("source_size") * k, F.lit(0.0)),
                                                               F.col("source_size").cast("double")).alias("want")) for k in range(MAX_REPEATS)])
    rows = rows.withColumn("block", F.pmod(
        _unit(F.lit("block"), "__key"), F.least(F.lit(BLOCKS), F.ceil(F.col("source_rows") / BLOCK_ROWS)))).drop("source_rows")
    # blocks in permuted order, with the words before each
    blocks = rows.groupBy("__source", "source_size", "target", "block").agg(F.sum("__size").alias("words"))
    blocks = blocks.select("*", F.explode(passes).alias("part")).select("__source", "block", "words", "part.*").filter("want > 0")
    order = Window.partitionBy("__source", "pass").orderBy(_unit(F.lit("order"), "__source", "pass", "block"), "block")
    blocks = blocks.withColumn("before", F.sum("words").over(order) - F.col("words")).withColumn("place", F.row_number().over(order))
    blocks = cut(spark, blocks.filter(F.col("before") < F.col("want")).withColumn(
        "room", F.when(F.col("before") + F.col("words") > F.col("want"), F.col("want") - F.col("before"))), "mix-blocks")
    hit = rows.alias("r").join(blocks.alias("b"), F.col("r.__source").eqNullSafe(F.col("b.__source")) & (F.col("r.block") == F.col("b.block"))).select(
        "r.*", "b.pass", "b.place", "b.room")
    whole = hit.filter(F.col("room").isNull()).drop("room")
    edge = hit.filter(F.col("room").isNotNull())
    lane = Window.partitionBy("__source", "pass")
    line = lane.orderBy(_unit(F.lit("edge"), "__key", "pass"), "__key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("got", F.lit(False)).withColumn("left", F.col("room"))
    for _ in range(FILLS):  # take in order what still fits as a whole
        fits = ~F.col("got") & (F.col("__size") <= F.col("left"))
        edge = edge.withColumn("cum", F.sum(F.when(fits, F.col("__size")).otherwise(0)).over(line))
        edge = edge.withColumn("got", F.col("got") | (fits & (F.col("cum") <= F.col("left"))))
        edge = edge.withColumn("left", F.col("room") - F.sum(F.when(F.col("got"), F.col("__size")).otherwise(0)).over(lane))
    # a last document that comes nearer to the target than none
    near = F.min(F.when(~F.col("got") & (F.col("__size") > 0), F.struct(F.abs(F.col("left") - F.col("__size")).alias("off"), F.col("__key").alias("key")))).over(lane)
    edge = edge.withColumn("near", near).withColumn("one", F.row_number().over(lane.orderBy(F.col("got"), F.col("__key") != F.col("near.key"), "__size")))
    edge = edge.filter(F.col("got") | ((F.col("one") == 1) & (F.col("near.off") < F.col("left")) & (F.col("__key") == F.col("near.key"))))
    return whole.unionByName(edge.select(*whole.columns)).withColumn("taken", F.col("__size"))


def split(spark: SparkSession, drawn: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``drawn`` plus its output shard and its position key there; quotas are exact block counts per (source, pass)."""
    units = drawn.groupBy("__source", "pass").agg(F.count_distinct("place").alias("quota"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        order = sorted(range(len(pdf)), key=lambda i: (pdf["__source"].iloc[i] is None, pdf["__source"].iloc[i] or "", pdf["pass"].iloc[i]))
        pdf = pdf.iloc[order].reset_index(drop=True)
        counts = hypergeometric_split(pdf["quota"].to_numpy(dtype=np.int64), shards, np.random.default_rng(SEED))
        ends = counts.cumsum(axis=0)
        parts = [pd.DataFrame({"__source": pdf["__source"], "pass": pdf["pass"], "shard": s, "first": ends[s] - counts[s], "last": ends[s]})
                 for s in range(shards)]
        return pd.concat(parts)[lambda p: p["first"] < p["last"]]

    ranges = cut(spark, units.groupBy(F.lit(0).alias("__all")).applyInPandas(
        run, "__source string, pass int, shard int, first long, last long"), "mix-ranges")
    places = drawn.select("__source", "pass", "place").distinct()
    rank = F.row_number().over(Window.partitionBy("__source", "pass").orderBy("place")) - 1
    places = places.withColumn("rank", rank).alias("u").join(ranges.alias("q"), F.col("u.__source").eqNullSafe(F.col("q.__source")) & (
        F.col("u.pass") == F.col("q.pass")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))).select("u.__source", "u.pass", "u.place", "shard")
    places = cut(spark, places, "mix-places")
    out = drawn.alias("d").join(places.alias("s"), F.col("d.__source").eqNullSafe(F.col("s.__source")) & (F.col("d.pass") == F.col("s.pass"))
                                & (F.col("d.place") == F.col("s.place"))).select("d.*", "s.shard")
    return out.withColumn("shard_key", _unit(F.lit("shuffle"), "__key", "pass"))


def shuffled(spark: SparkSession, placed: DataFrame) -> DataFrame:
    """(__key, pass, shard, position) of the distinct documents of ``split``: places from 0 in each shard's shuffled order.

    Places come from a range partitioning and counts per partition, so no shard is sorted in one task.
    """
    order = ["shard_key", "__key", "pass"]
    dealt = placed.select("shard", *order).distinct().repartitionByRange("shard", *order).withColumn("part", F.spark_partition_id())
    dealt = cut(spark, dealt, "mix-order")  # partition numbers are now data and cannot change
    counts = again(spark, dealt).groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).drop("n")
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy(*order)) - 1
    return dealt.withColumn("inside", inside).join(before, ["shard", "part"]).select(
        "__key", "pass", "shard", (F.col("before") + F.col("inside")).cast("long").alias("position"))


def sized(df: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The packed rows that ``draw`` reads: __row, __key, __source, __size."""
    kind = F.col(f"`{source}`").cast("string")
    return pack(df, __key=F.xxhash64(f"`{id_col}`", F.col(f"`{id_col}`").isNull(), kind, f"`{text}`"), __source=kind,
                __size=F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD)).cast("long"))


def mix(spark: SparkSession, df: DataFrame, shards: int = SHARDS, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The mix itself: ``df``'s columns, a document once per time it is taken, in ``shards`` locally shuffled shards."""
    rows = sized(df, text, source, id_col)  # read twice: sizes first, whole rows for the output
    drawn = cut(spark, draw(spark, cut(spark, rows.drop("__row"), "mix-sizes")), "mix-drawn")
    placed = split(spark, drawn, shards).select("__key", "pass", "shard", "shard_key")
    placed = placed.groupBy("__key").agg(F.collect_set(F.struct("pass", "shard", "shard_key")).alias("copies"))
    out = rows.join(placed, "__key").select("__row", F.explode("copies").alias("copy")).select("__row", "copy.*")
    words_out = drawn.agg(F.sum("__size")).first()[0] or 0
    lanes = 1 + words_out // (shards * LANE_WORDS)  # tasks that write a shard, by its size
    # as many partitions as lanes in all, so that they grow with the output
    return unpack(out.repartition(shards * lanes, "shard", F.pmod("shard_key", F.lit(lanes))).sortWithinPartitions("shard", "shard_key"))
