"""Column functions over arrays, maps and growth figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def primary_by_weight(entries: Column, *, name: str = "name", weight: str = "w") -> Column:
    """Name of the heaviest entry; the first listed wins a tie, unreadable weights come last, none gives null.

    Weights may arrive as quoted text, so they are cast leniently.
    """
    ranked = F.transform(
        entries,
        lambda entry, position: F.struct(
            entry[weight].try_cast("double").alias("weight"),
            (-position).alias("position"),
            entry[name].alias("name"),
        ),
    )
    return F.array_max(ranked)["name"]


def array_size_default(values: Column) -> Column:
    """Number of elements, 0 for a null array."""
    return F.coalesce(F.size(values), F.lit(0))


def label_map(labels: dict) -> Column:
    """A literal map column; looking up an absent key gives null."""
    return F.create_map(*[F.lit(part) for pair in labels.items() for part in pair])


def cagr(first: Column, last: Column, *, years: int) -> Column:
    """Compound annual growth in percent; null unless both figures are positive."""
    return F.when((first > 0) & (last > 0), (F.pow(last / first, F.lit(1.0 / years)) - 1) * 100)
