"""Mixing sources to target weights by Sainte-Laguë apportionment.

Target words per source come from the weights (water filling under a cap), made
whole numbers that add up to the mix's size.  Documents are spread over shards by
a seeded hash.  A source's words are dealt to its shards in blocks of equal size,
one by one to the highest quotient (words of the source there / 1, 3, 5, ...);
what is less than a block, and what shards too small for a block can still give, is
dealt in the same way word by word, so a source's quotas add up to its target
whatever the number of shards.  Regions of ``REGION_SHARDS`` shards are dealt to
first and then their shards, so no task holds all shards of a large table.

In a shard a source's documents, in seeded order, form a row of words cut into
numbered blocks.  The quota takes blocks in a seeded order, the last one chosen up
to the quota's end; a quota beyond all words takes whole rounds first, so words
repeat at most ``cap`` times.

Only the sums per source and per (shard, source) are gathered.  Shards hold
``SHARD_DOCS`` documents on average whatever the sources' sizes, so neither a hot
source nor a large table makes a large group of documents.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starwright.llm.common import written

SHARD_DOCS = 1024
REGION_SHARDS = 1024
BLOCK_WORDS = 1024
SEED = 17


def apportion(votes: Sequence[float], seats: int, limits: Sequence[int]) -> list[int]:
    """Sainte-Laguë: ``seats`` go one by one to the highest votes / (2 * seats so
    far + 1), ties to the first, nobody above its limit.

    All seats that any divisor certainly gives are dealt at once, the rest from
    a heap of quotients, so the work depends on the parties and not the seats."""
    v, limit = np.asarray(votes, float), np.asarray(limits, np.int64)
    seats = min(seats, int(limit[v > 0].sum()))
    if seats <= 0:
        return [0] * len(v)
    divisor = v.sum() / seats
    while True:  # a larger divisor gives every party fewer seats
        got = np.minimum(np.floor(v / divisor + 0.5).astype(np.int64), limit)
        if got.sum() <= seats:
            break
        divisor *= 1 + max(1e-9, (got.sum() - seats) / seats)
    heap = [(-x / (2 * g + 1), i) for i, (x, g) in enumerate(zip(v, got, strict=True))
            if x > 0 and g < limit[i]]
    heapq.heapify(heap)
    for _ in range(seats - int(got.sum())):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < limit[i]:
            heapq.heappush(heap, (-v[i] / (2 * got[i] + 1), i))
    return got.tolist()


def deal(sizes: Sequence[int], words: int, cap: int, block: int) -> list[int]:
    """``words`` dealt over rows of ``sizes`` words, none above ``cap`` times its
    size: whole blocks to the highest quotients, then the rest word by word."""
    limits = np.asarray(sizes, np.int64) * cap
    blocks = np.asarray(apportion(limits, words // block, limits // block), np.int64) * block
    left = limits - blocks
    return (blocks + apportion(left, words - int(blocks.sum()), left)).tolist()


def cycled_weights(sized: DataFrame, weights: Sequence[float], source_col: str = "source"
                   ) -> DataFrame:
    """(source, weight): the sources by code point, null last, with ``weights`` in
    turn.  One row for each source passes one task."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    given = F.array(*(F.lit(float(w)) for w in weights))
    return (sized.select(F.col(source_col).alias("source")).distinct()
            .select("source", F.get(given, place % len(weights)).alias("weight")))


def targets(sized: DataFrame, weights: DataFrame, share: float, cap: float = 2.0,
            source_col: str = "source", size_col: str = "size") -> DataFrame:
    """(source, source_size, target): ``share`` of all words dealt by weight, none
    above ``cap`` times its source's size, the excess dealt again by weight.

    The sources that end at their cap are the first ones by cap / weight, so one
    ordered pass over the sources finds them.  A source without a weight gets 0."""
    sizes = (sized.groupBy(F.col(source_col).alias("source"))
             .agg(F.sum(size_col).cast("long").alias("source_size")))
    named = weights.select(F.col("source").alias("__source"), "weight")
    rows = (sizes.join(named, F.col("source").eqNullSafe(F.col("__source")), "left")
            .select("source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"),
                    (F.lit(float(cap)) * F.col("source_size")).alias("cap")))
    order = Window.orderBy(F.when(F.col("weight") > 0, F.col("cap") / F.col("weight"))
                           .asc_nulls_last(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) * F.lit(float(share))
             - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = rows.withColumn("level", F.when(F.col("weight") > 0, level))
    full = F.col("weight") * F.col("level") >= F.col("cap")
    # levels rise over the full sources and fall after the first that isn't full
    rows = rows.withColumn("rest", F.max(F.when(~full, F.col("level"))).over(whole))
    return rows.select(
        "source", "source_size",
        F.when(F.col("weight") <= 0, 0.0).when(full, F.col("cap"))
        .otherwise(F.least(F.col("weight") * F.col("rest"), F.col("cap"))).alias("target"))


def mix(sized: DataFrame, weights: DataFrame, share: float, cap: int = 2,
        id_col: str = "doc_id", source_col: str = "source", size_col: str = "size",
        carry: tuple[str, ...] = (), block_words: int = BLOCK_WORDS,
        shard_docs: int = SHARD_DOCS, seed: int = SEED) -> DataFrame:
    """For each row of ``sized``: ``id_col``, the ``carry`` columns, ``source``,
    ``size``, ``source_size``, ``target`` (its source's words), ``rounds``,
    ``pieces`` and ``taken``: the mix takes the document ``rounds`` times whole and
    its ``pieces`` (first word, number of words; one for each block that it reaches
    into) once more, ``taken`` words in all.

    A null size counts as 0; a null source is a source of its own; a document
    without words takes none; an empty table has no rows.  Rows that agree in
    id and size are alike to the order, which is otherwise total, so reruns
    agree.  The rows of a source are never gathered: only its sums."""
    rows = sized.select(F.col(id_col).alias("__id"), F.col(source_col).alias("source"),
                        F.coalesce(F.col(size_col).cast("long"), F.lit(0)).alias("size"),
                        F.struct(id_col, *carry).alias("__row"))
    n = max(1, -(-sized.count() // shard_docs))
    rows = rows.withColumn("__shard", F.pmod(F.xxhash64(F.lit(seed), "__id", "size"), F.lit(n)))
    quota = _quotas(rows, weights, share, cap, block_words)
    of_shard = Window.partitionBy("__s", "__source").orderBy(
        F.xxhash64(F.lit(seed + 2), "__s", "__source", "block"), "block")
    ring, block = F.col("ring"), F.lit(block_words)
    last = F.greatest(F.floor((ring - 1) / block), F.lit(0)).cast("long")
    numbered = (quota.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
                .withColumn("words_in", F.least(block, ring - F.col("block") * block))
                .withColumn("before", F.coalesce(F.sum("words_in").over(
                    of_shard.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                .withColumn("chosen", F.greatest(F.lit(0), F.least(
                    F.col("words_in"),
                    F.pmod(F.col("words"), F.greatest(ring, F.lit(1))) - F.col("before")))))
    # a row for each shard and source: the words it takes of its blocks, by number
    chosen = numbered.groupBy("__s", "__source", "ring", "words", "source_size", "target").agg(
        F.array_sort(F.collect_list(F.struct("block", "chosen"))).getField("chosen")
        .alias("chosen"))
    order = (Window.partitionBy("__shard", "source")
             .orderBy(F.xxhash64(F.lit(seed + 1), "__id", "size"), "__id", "size"))
    placed = rows.withColumn("at", F.coalesce(F.sum("size").over(
        order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = placed.join(chosen, (F.col("__shard") == F.col("__s"))
                         & F.col("source").eqNullSafe(F.col("__source")))
    at, size = F.col("at"), F.col("size")

    def piece(b):
        start = F.greatest(at, b * block)
        upto = F.least(at + size, b * block + F.get("chosen", b.cast("int")))
        return F.struct((start - at).alias("first"), (upto - start).alias("words"))

    reached = F.sequence(F.floor(at / block).cast("long"),
                         F.floor((at + F.greatest(size, F.lit(1)) - 1) / block).cast("long"))
    rounds = F.floor(F.col("words") / F.greatest(ring, F.lit(1))).cast("long")
    return (joined.withColumn("rounds", rounds)
            .withColumn("pieces", F.filter(F.transform(reached, piece),
                                           lambda p: p["words"] > 0))
            .select("__row.*", "source", "size", "source_size", "target", "rounds", "pieces",
                    F.aggregate("pieces", F.col("rounds") * size,
                                lambda total, p: total + p["words"]).alias("taken")))


def _quotas(rows: DataFrame, weights: DataFrame, share: float, cap: int, block: int
            ) -> DataFrame:
    """(__s, __source, ring, source_size, target, words): the words that each shard
    gives of each source; ``ring`` are its words there."""
    kind = rows.schema["source"].dataType.simpleString()

    def whole(sources: pd.DataFrame) -> pd.DataFrame:
        sources = sources.sort_values("source", na_position="last", kind="stable")
        sources["goal"] = apportion(sources["target"].tolist(), round(sources["target"].sum()),
                                    (sources["source_size"] * cap).tolist())
        return sources

    def dealt(place: str):
        def step(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values(place, kind="stable")
            part["words"] = deal(part["ring"].tolist(), int(part["goal"].iloc[0]), cap, block)
            return part.drop(columns="goal")
        return step

    goal = written(targets(rows, weights, share, float(cap)).groupBy().applyInPandas(
        whole, f"source {kind}, source_size long, target double, goal long"), "mix-goals")
    goal = goal.withColumnRenamed("source", "__source")
    shards = (rows.groupBy("__shard", "source").agg(F.sum("size").alias("ring"))
              .withColumn("region", F.floor(F.col("__shard") / REGION_SHARDS).cast("long")))
    regions = (shards.groupBy("source", "region").agg(F.sum("ring").cast("long").alias("ring"))
               .join(F.broadcast(goal) if _few(goal) else goal,
                     F.col("source").eqNullSafe(F.col("__source")))
               .select("source", "region", "ring", "source_size", "target", "goal")
               .groupBy("source").applyInPandas(
                   dealt("region"), f"source {kind}, region long, ring long, source_size long, "
                                    "target double, words long"))
    regions = regions.select(F.col("source").alias("__source"), F.col("region").alias("__region"),
                             "source_size", "target", F.col("words").alias("goal"))
    return written(
        shards.join(regions, F.col("source").eqNullSafe(F.col("__source"))
                    & (F.col("region") == F.col("__region")))
        .select(F.col("__shard").alias("__s"), "__source", "region", "ring", "source_size",
                "target", "goal")
        .groupBy("__source", "region").applyInPandas(
            dealt("__s"), f"__s long, __source {kind}, region long, ring long, "
                          "source_size long, target double, words long")
        .drop("region"), "mix-quotas")


#: Sources up to this many are broadcast; beyond it they are joined by shuffling.
MANY_SOURCES = 10_000


def _few(goal: DataFrame) -> bool:
    return goal.limit(MANY_SOURCES + 1).count() <= MANY_SOURCES
