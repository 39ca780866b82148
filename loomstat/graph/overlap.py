"""Pairs of items that occur together in contexts, without pairing up whole hubs.

A context with n items has n(n-1)/2 pairs. Contexts of at most ``HEAVY`` items are paired up directly, which costs at
most ``HEAVY`` / 2 pairs a row. The larger ones, hubs, are few: at most a ``HEAVY``-th of the rows. They become sets of
hubs per item, and what two items share of them is the size of an intersection, worked out where it is needed: for
pairs that share a smaller context, and for sets that can share ``min_shared`` hubs. Items with equal sets are one
there, so a pair that fails the threshold is never written. Counts are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loomstat.operators.skew import HEAVY_ROWS, heavy_keys
from loomstat.session import PARTITION_ROWS, durable, partitions_for

# Partitions that shuffled pairs are given at most.
MOST_PARTITIONS = 4096

# Items above which a context is a hub, items of one hub that a task pairs up, items that a top-k search begins with.
HEAVY, BLOCK, SEED = 512, 2048, 256


def hubs(rows: DataFrame, heavy: int) -> DataFrame:
    """``context, n`` of the contexts with more than ``heavy`` items, written so that their number is known."""
    return durable(rows.groupBy("context").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > heavy), "hubs")


def _small_pairs(rows: DataFrame) -> DataFrame:
    """``context, a, b`` for all items a < b of contexts with a bounded number of items."""
    lists = rows.groupBy("context").agg(F.sort_array(F.collect_list("item")).alias("items")).filter(F.size("items") > 1)
    first = lists.select("context", "items", F.posexplode("items").alias("at", "a"))
    return first.select("context", "a", F.explode(F.slice("items", F.col("at") + 2, F.size("items"))).alias("b"))


def _pair_counts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``a, b, shared`` for all items a < b of contexts with a bounded number of items.

    A context sends each of its items the list of those behind it, and pairs are made and counted where the first item
    is: a list moves in a fraction of the bytes of its pairs. Items of very many contexts would meet in one task each, so
    their pairs are made first and counted before they move.
    """
    size = sizes.agg(F.sum("n").alias("rows"), F.sum((F.col("n").cast("double") * (F.col("n") - 1) / 2)).alias("pairs")).first()
    hot = [key for key in heavy_keys(rows, "item") if key is not None] if (size["rows"] or 0) >= HEAVY_ROWS else []
    lists = rows.groupBy("context").agg(F.sort_array(F.collect_list("item")).alias("items")).filter(F.size("items") > 1)
    lists = lists.withColumn("last", F.size("items"))
    first = lists.select("items", F.posexplode("items").alias("at", "a"), "last").filter(F.col("at") + 1 < F.col("last"))
    behind = first.select("a", F.slice("items", F.col("at") + 2, F.col("last")).alias("behind"))
    parts = min(int(size["pairs"] or 0) // PARTITION_ROWS, MOST_PARTITIONS)
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cold = behind.filter(~F.col("a").isin(hot)) if hot else behind
    placed = cold.repartition(parts, "a") if parts > usual else cold.repartition("a")
    shared = F.count(F.lit(1)).alias("shared")
    counts = placed.select("a", F.explode("behind").alias("b")).groupBy("a", "b").agg(shared)
    if not hot:
        return counts
    spread = behind.filter(F.col("a").isin(hot)).select("a", F.explode("behind").alias("b"))
    return counts.unionByName(spread.groupBy("a", "b").agg(shared))


def _block_pairs(rows: DataFrame, sizes: DataFrame, block: int, *, carry: tuple[str, ...] = (), where: Column | None = None) -> DataFrame:
    """``context, a, b`` of hubs. A hub is cut into blocks and each pair of blocks is a key of its own, so many tasks
    make its pairs; ``where`` may refuse a pair by the columns ``carry`` of both, named with ``_a`` and ``_b``."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    placed = rows.join(sizes.select("context", blocks.alias("blocks")), "context").withColumn("side", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "context", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "item", *carry
    )
    both = [
        cells.select("context", "low", "high", F.col("side").alias(f"side_{s}"), F.col("item").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in carry])
        for s in "ab"
    ]
    across = (F.col("low") == F.col("high")) | (F.col("side_a") != F.col("side_b"))
    met = both[0].join(both[1], ["context", "low", "high"]).filter((F.col("a") < F.col("b")) & across)
    return (met if where is None else met.filter(where)).drop("low", "high", "side_a", "side_b")


def pairs_within(rows: DataFrame, sizes: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """``context, a, b`` for all items a < b of the hubs in ``sizes``; ``rows`` holds distinct ``context, item``."""
    return _block_pairs(rows, sizes, block)


def _shared_hubs(left: str, right: str) -> Column:
    none = F.array().cast("array<bigint>")
    return F.size(F.array_intersect(F.coalesce(left, none), F.coalesce(right, none))).cast("bigint")


def _hub_pairs(sets: DataFrame, min_shared: int, block: int) -> DataFrame:
    """``a, b, shared`` for items whose sets of hubs have ``min_shared`` or more in common; shared counts hubs only."""
    sets = sets.filter(F.size("hubs") >= min_shared)
    groups = durable(sets.groupBy("hubs").agg(F.count(F.lit(1)).alias("n")).withColumn("item", F.monotonically_increasing_id()), "hub-sets")
    members = durable(sets.join(groups.select("hubs", F.col("item").alias("set")), "hubs").select("set", "item"), "hub-members")
    # Two sets with t hubs in common still share one if each leaves its t-1 most frequent ones aside.
    spread = groups.select("item", "hubs", F.explode("hubs").alias("context"))
    often = spread.groupBy("context").agg(F.count(F.lit(1)).alias("often"))
    most = Window.partitionBy("item").orderBy(F.desc("often"), F.desc("context"))
    prefix = durable(
        spread.join(often, "context").withColumn("position", F.row_number().over(most)).filter(F.col("position") >= min_shared)
        .select("item", "hubs", "context"), "hub-prefix",
    )
    meet = prefix.groupBy("context").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    shared = _shared_hubs("hubs_a", "hubs_b")
    close = _block_pairs(prefix, meet, block, carry=("hubs",), where=shared >= min_shared).select("a", "b", shared.alias("shared")).distinct()
    left, right = (members.select(F.col("set").alias(s), F.col("item").alias(f"item_{s}")) for s in "ab")
    ends = [F.col("item_a"), F.col("item_b")]
    apart = close.join(left, "a").join(right, "b").select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b"), "shared")
    same = _block_pairs(
        members.withColumnRenamed("set", "context"), groups.filter("n > 1").select(F.col("item").alias("context"), "n"), block
    ).join(groups.select(F.col("item").alias("context"), F.size("hubs").cast("bigint").alias("shared")), "context")
    return apart.unionByName(same.select("a", "b", "shared"))


def shared_pairs(
    occurrences: DataFrame, *, item: str, context: str, min_shared: int = 2, heavy: int = HEAVY, block: int = BLOCK
) -> DataFrame:
    """``a, b, shared`` for all item pairs a < b with at least ``min_shared`` >= 2 common contexts.

    ``occurrences`` holds distinct (item, context) rows.
    """
    if min_shared < 2:
        raise ValueError("min_shared must be at least 2: pairs with one common context are all pairs of a context")
    rows = durable(occurrences.select(F.col(item).alias("item"), F.col(context).alias("context")), "overlap")
    if min_shared > 2:
        often = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_shared)
        rows = durable(rows.join(often.select("item"), "item", "left_semi"), "overlap")
    sizes = durable(rows.groupBy("context").agg(F.count(F.lit(1)).alias("n")), "context-sizes")
    large = sizes.filter(F.col("n") > heavy)
    plain = large.isEmpty()
    small = rows if plain else rows.join(large.select("context"), "context", "left_anti")
    near = _pair_counts(small, sizes.filter(F.col("n") <= heavy))
    if plain:
        return near.filter(F.col("shared") >= min_shared)
    numbered = durable(large.select("context", F.monotonically_increasing_id().alias("hub")), "hub-numbers")
    sets = durable(
        rows.join(numbered, "context").groupBy("item").agg(F.sort_array(F.collect_list("hub")).alias("hubs")), "hubs-of-items"
    )
    near = durable(near, "overlap-pairs")
    far = _hub_pairs(sets, min_shared, block).join(near.select("a", "b"), ["a", "b"], "left_anti")
    left, right = (sets.select(F.col("item").alias(s), F.col("hubs").alias(f"hubs_{s}")) for s in "ab")
    both = near.join(left, "a", "left").join(right, "b", "left").select(
        "a", "b", (F.col("shared") + _shared_hubs("hubs_a", "hubs_b")).alias("shared")
    )
    return both.filter(F.col("shared") >= min_shared).unionByName(far)


def top_shared_pairs(occurrences: DataFrame, *, item: str, context: str, k: int = 10, seed: int = SEED) -> DataFrame:
    """The k item pairs with the most common contexts; ties go to the smaller ids.

    Two items share no more contexts than the rarer one has. So the pairs of the ``seed`` most frequent items come first:
    their k-th best count bounds the rest from below, and only items at least as frequent are paired up, once, with that
    count as the threshold. If even two common contexts leave fewer than k pairs, the rest are the smallest pairs with
    one: each context's smallest pairs come from its first items, so again no context is paired up whole.
    """
    spark = occurrences.sparkSession
    rows = durable(occurrences.select(F.col(item).alias("item"), F.col(context).alias("context")), "top-pairs")
    n = F.count(F.lit(1)).cast("double")
    with partitions_for(spark, rows.count()):
        pairs = rows.groupBy("context").agg((n * (n - 1) / 2).alias("pairs")).agg(F.sum("pairs")).first()[0] or 0
    with partitions_for(spark, int(min(pairs, MOST_PARTITIONS * PARTITION_ROWS))):
        return _top_shared_pairs(rows, k, seed)


def _top_shared_pairs(rows: DataFrame, k: int, seed: int) -> DataFrame:
    spark = rows.sparkSession
    often = durable(rows.groupBy("item").agg(F.count(F.lit(1)).alias("n")), "top-degrees")
    first = F.broadcast(often.orderBy(F.desc("n"), "item").limit(seed).select("item"))  # ``seed`` rows
    order = [F.desc("shared"), "a", "b"]
    # At most ``seed`` items, so a context has at most so many here and all pairs together few groups.
    begun = _small_pairs(rows.join(first, "item", "left_semi")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    best = begun.orderBy(*order).limit(k).collect()
    floor = max(2, best[-1]["shared"] if len(best) == k else 0)
    found = shared_pairs(rows, item="item", context="context", min_shared=floor)
    best = found.orderBy(*order).limit(k).collect()
    top = spark.createDataFrame(best, found.schema)
    if len(best) == k:
        return top.orderBy(*order)
    # At most k-1 pairs are known, so 2k smallest pairs per context are enough, and these lie among its first 2k+1.
    position = Window.partitionBy("context").orderBy("item")
    few = durable(
        rows.withColumn("position", F.row_number().over(position)).filter(F.col("position") <= 2 * k + 1), "overlap-few"
    )
    single = (
        few.select("context", F.col("item").alias("a"))
        .join(few.select("context", F.col("item").alias("b")), "context")
        .filter(F.col("a") < F.col("b"))
        .select("a", "b")
        .distinct()
        .join(top, ["a", "b"], "left_anti")
        .select("a", "b", F.lit(1).cast("bigint").alias("shared"))
        .orderBy("a", "b")
        .limit(k - len(best))
    )
    return top.unionByName(single).orderBy(*order)
