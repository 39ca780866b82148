"""Row-level operators: de-duplication, sampling, splits, seeded order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loomstat.constants import SAMPLE_SEED
from loomstat.session import durable


def dedupe_rows(df: DataFrame, keys: list[str], *, order: list[Column] | None = None) -> DataFrame:
    """One row per key: the first by ``order``, then by the other columns; nulls sort first.

    A partial aggregate, so copies of one key collapse before the shuffle however many there are.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    sort = [column.alias(f"__o{i}") for i, column in enumerate(order or [])]
    best = F.min(F.struct(*sort, *rest))
    return df.groupBy(*keys).agg(best.alias("__best")).select(
        *[F.col(name) if name in keys else F.col(f"__best.{name}").alias(name) for name in df.columns]
    )


def drop_null_rows(df: DataFrame, text: str, label: str) -> DataFrame:
    """Rows with a label and non-blank text."""
    return df.dropna(subset=[text, label]).filter(F.trim(text) != "")


def sample_fraction(df: DataFrame, fraction: float = 0.40, *, seed: int = SAMPLE_SEED) -> DataFrame:
    """Bernoulli sample without replacement; depends on how the input is split into tasks."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def seeded_hash(key: Column, seed: int = SAMPLE_SEED) -> Column:
    """A 60-bit number from (seed, key) that any engine with MD5 can reproduce."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def hash_sample(df: DataFrame, key: str, fraction: float = 0.40, *, seed: int = SAMPLE_SEED) -> DataFrame:
    """A sample that is the same however the rows are distributed: no shuffle, decided per row."""
    return df.filter(seeded_hash(F.col(key), seed) < int(fraction * (1 << 60)))


def train_test_split(df: DataFrame, train_fraction: float = 0.8, *, seed: int = SAMPLE_SEED):
    """Two disjoint DataFrames that together hold every row."""
    if not 0.0 < train_fraction < 1.0:
        raise ValueError("train_fraction must lie between 0 and 1")
    train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return train, test


def shuffle_rows(df: DataFrame, key: str, *, seed: int = SAMPLE_SEED) -> DataFrame:
    """All rows in a random order that the seed fixes."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key)


# Rows of one class that are ranked to find a cut point, and cut points that are sent to all tasks.
CUT_ROWS = 10_000
CUT_POINTS = 100_000


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    *,
    val: float = 0.1,
    test: float = 0.1,
    seed: int = SAMPLE_SEED,
    bits: int = 12,
    cut_rows: int = CUT_ROWS,
) -> DataFrame:
    """Every row with a ``split`` of train, val or test, in exact shares per class.

    Within a class the rows are ordered by a seeded hash of their unique ``key``; the first ``floor(n * test)`` are
    test rows, the next ``floor(n * val)`` validation rows. The order is never materialised: a histogram of the first
    ``bits`` of the hash finds the stretch each cut falls in, a histogram of the next bits narrows it, until at most
    ``cut_rows`` rows are left to be ranked. The cut points, two per class, are then compared with every row in place:
    up to ``CUT_POINTS`` classes they are broadcast, so neither the rows nor a class are shuffled.
    """
    hashed = df.withColumn("__hash", seeded_hash(F.col(key), seed))
    slim = durable(hashed.select(F.col(label).alias("c"), F.col("__hash").alias("h"), F.col(key).alias("k")), "hashes")
    sizes = slim.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    first = F.floor(F.col("n") * F.lit(test))
    cuts = sizes.select("c", "n", F.explode(F.array(
        F.struct(F.lit("test").alias("cut"), first.alias("at")),
        F.struct(F.lit("val").alias("cut"), (first + F.floor(F.col("n") * F.lit(val))).alias("at")),
    )).alias("s")).select("c", "n", "s.cut", "s.at", F.lit(0).cast("bigint").alias("part")).filter("at > 0")
    state, known = durable(cuts, "cuts"), 0

    def within(state: DataFrame, known: int) -> DataFrame:
        """Rows of the stretch that each cut has been narrowed to."""
        part = F.shiftright("h", 60 - known) if known else F.lit(0).cast("bigint")
        near = slim.withColumn("p", part).withColumnRenamed("c", "sc")
        return near.join(state, F.col("sc").eqNullSafe(F.col("c")) & (F.col("p") == F.col("part"))).drop("sc", "p")

    while known < 60 and not state.filter(F.col("n") > cut_rows).isEmpty():
        step = min(bits, 60 - known)
        known += step
        piece = F.shiftright("h", 60 - known)
        counted = within(state.drop("n"), known - step).groupBy("c", "cut", "at", piece.alias("piece")).agg(F.count(F.lit(1)).alias("n"))
        # At most 2 ** bits rows per cut reach a window task.
        before = F.coalesce(F.sum("n").over(
            Window.partitionBy("c", "cut").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = counted.withColumn("before", before)
        holding = placed.filter((F.col("before") < F.col("at")) & (F.col("at") <= F.col("before") + F.col("n")))
        state = durable(
            holding.select("c", "n", "cut", (F.col("at") - F.col("before")).alias("at"), F.col("piece").alias("part")), "cuts"
        )
    rank = F.row_number().over(Window.partitionBy("c", "cut").orderBy("h", "k"))
    points = (
        within(state, known).withColumn("__rank", rank).filter(F.col("__rank") == F.col("at"))
        .groupBy(F.col("c").alias("__c"))
        .agg(*[
            F.max(F.when(F.col("cut") == cut, F.struct("h", "k"))).alias(f"__{cut}") for cut in ("test", "val")
        ])
    )
    points = durable(points, "cut-points")
    if points.count() <= CUT_POINTS:
        points = F.broadcast(points)
    here = F.struct(F.col("__hash").alias("h"), F.col(key).alias("k"))
    split = (
        F.when(here <= F.col("__test"), "test").when(here <= F.col("__val"), "val").otherwise("train")
    )
    return (
        hashed.join(points, F.col(label).eqNullSafe(F.col("__c")), "left")
        .withColumn("split", split)
        .select(*df.columns, "split")
    )
