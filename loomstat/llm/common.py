"""Helpers of the operators in this folder: text in Arrow batches, row identity, the shared folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.session import durable, new_path

__all__ = ["durable", "new_path", "read_table", "slices", "utf8", "fold", "text_hash", "text_key", "shuffle_partitions"]

# Rows turned into Python objects at once; long texts make a batch large, so batches are walked in slices.
SLICE_ROWS = 256
FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# What Spark's xxhash64 gives for a null.
NULL_HASH = 42


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, None for nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def fold(text: bytes) -> bytes:
    """A-Z in lower case, all else as it is."""
    return text.translate(FOLD)


def text_hash(text: bytes | None) -> int:
    """Spark's ``xxhash64`` of a string column, in Python."""
    if text is None:
        return NULL_HASH
    value = xxhash.xxh64_intdigest(text, 42)
    return value - (1 << 64) if value >> 63 else value


def text_key(text: Column | str = "text") -> Column:
    """Together with the id it tells rows apart that share an id; rows equal in both are treated alike."""
    return F.xxhash64(text)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
