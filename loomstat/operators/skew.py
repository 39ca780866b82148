"""Joins of a large table with a keyed lookup when a few keys hold much of the large table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_KEYS = 1024
HEAVY_ROWS = 1_000_000
SALTS = 256


def heavy_keys(df: DataFrame, key: str, *, min_rows: int = HEAVY_ROWS, limit: int = HEAVY_KEYS) -> list:
    """The at most ``limit`` most frequent keys that have ``min_rows`` rows or more.

    Counts are combined map-side and only ``limit`` values reach the driver, whatever the size of ``df``. Any key
    left out has fewer than 1/``limit`` of the rows, or fewer than ``min_rows``.
    """
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.filter(F.col("n") >= min_rows).orderBy(F.desc("n"), "key").limit(limit)
    return [row["key"] for row in top.collect()]


SALT = "__salt"


@dataclass(frozen=True)
class Salting:
    """How rows of hot keys are spread: ``keys`` get ``salts`` sub-keys, all others get one."""

    keys: tuple = ()
    salts: int = SALTS

    @classmethod
    def measure(cls, df: DataFrame, key: str, *, min_rows: int = HEAVY_ROWS, salts: int = SALTS) -> "Salting":
        return cls(tuple(heavy_keys(df, key, min_rows=min_rows)), salts)

    @classmethod
    def measure_counts(
        cls, counts: DataFrame, key: str, rows: str, *, min_rows: int = HEAVY_ROWS, salts: int = SALTS
    ) -> "Salting":
        """As :meth:`measure`, from counts per key that exist already; again at most ``HEAVY_KEYS`` rows move."""
        top = counts.filter(F.col(rows) >= min_rows).orderBy(F.desc(rows), key).limit(HEAVY_KEYS).select(key)
        return cls(tuple(row[key] for row in top.collect()), salts)

    def join_keys(self, key: str) -> list[str]:
        """Columns to join, partition or bucket by: the salt belongs to them only if there are hot keys."""
        return [key, SALT] if self.keys else [key]

    def big(self, df: DataFrame, key: str, spread: str) -> DataFrame:
        """The large side; ``spread`` is any column that varies within a key."""
        if not self.keys:
            return df
        salt = F.pmod(F.xxhash64(spread), F.lit(self.salts)).cast("int")
        return df.withColumn(SALT, F.when(F.col(key).isin(list(self.keys)), salt).otherwise(F.lit(0)))

    def lookup(self, df: DataFrame, key: str) -> DataFrame:
        """The lookup side, the rows of hot keys once per salt."""
        if not self.keys:
            return df
        every = F.sequence(F.lit(0), F.lit(self.salts - 1))
        salts = F.when(F.col(key).isin(list(self.keys)), every).otherwise(F.array(F.lit(0)))
        return df.withColumn(SALT, F.explode(salts))


def salted_lookup(
    big: DataFrame, lookup: DataFrame, key: str, *, spread: str, how: str = "left", salting: Salting | None = None
) -> DataFrame:
    """``big`` joined with ``lookup`` (one row per ``key``), the rows of hot keys spread over many tasks."""
    salting = salting if salting is not None else Salting.measure(big, key)
    joined = salting.big(big, key, spread).join(salting.lookup(lookup, key), salting.join_keys(key), how)
    return joined.drop(SALT)
