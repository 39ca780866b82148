"""What each message does to a keyed table, from state that a stream keeps per key."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loomstat.streaming.keyed import KeyedTable

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Keeps microseconds, which the default does not.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
INSERTED, MODIFIED, UNCHANGED = "inserted", "modified", "unchanged"


def digest(columns: list[str]) -> Column:
    """A digest of some columns' values that tells null from empty and one column from the next."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat(*parts).cast("binary"))


def _greater(left: tuple, right: tuple) -> bool:
    for (there, a), (known, b) in zip(left, right, strict=True):
        if there != known:
            return there
        if there and a != b:
            return a > b
    return False


class Changes(StatefulProcessor):
    """Per key the digest of the row stored last; of a batch's rows of the key only the newest counts.

    Newest is the greatest by the columns ``order``, compared as Spark compares structs: from left to right, nulls first.
    """

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stored = handle.getValueState("stored", "digest string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        newest, place, n = None, (), 0
        for row in rows:
            n += 1
            here = tuple((row[c] is not None, row[c]) for c in self.order)
            if newest is None or _greater(here, place):
                newest, place = row, here
        if newest is None:  # a key of the initial state only
            return
        known = self.stored.get()  # each call of the state is a message to the JVM and back
        before = None if known is None else known[0]
        if before != newest["digest"]:
            self.stored.update((newest["digest"],))
        change = INSERTED if before is None else UNCHANGED if before == newest["digest"] else MODIFIED
        yield Row(content=newest["content"], change=change, n_messages=n)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:  # noqa: N802, N803
        self.stored.update((initialState["digest"],))

    def close(self) -> None:
        pass


def tracked(rows: DataFrame, table: KeyedTable, *, initial: DataFrame | None = None) -> DataFrame:
    """A stream of rows for ``table`` as one row per key and micro-batch, with ``change`` and ``n_messages``.

    The state belongs to the stream's checkpoint: a batch that is done again finds the state as it was before, and a
    restart goes on from there. ``initial`` is the table's content when a stream begins on one that is not empty. State
    is as large as the number of keys and lives in the state store, a digest for each.
    """
    rest = [c for c in table.columns if c not in table.keys]
    order = {f"place {i}": F.col(c) for i, c in enumerate((*table.newest_first, *rest))}
    spread = rows.select(
        *table.keys, *[c.alias(name) for name, c in order.items()], digest(rest).alias("digest"),
        F.to_json(F.struct(*table.columns), JSON).alias("content"),
    )
    known = None if initial is None else initial.select(*table.keys, digest(rest).alias("digest")).groupBy(*table.keys)
    changed = spread.groupBy(*table.keys).transformWithState(
        Changes(list(order)), "content string, change string, n_messages bigint", "Append", "None", known
    )
    row = F.from_json("content", T.StructType.fromDDL(table.schema), JSON)
    return changed.select(row.alias("row"), "change", "n_messages").select("row.*", "change", "n_messages")


def counts(changed: DataFrame, table: KeyedTable) -> DataFrame:
    """One row on a batch of ``tracked``: keys matched, modified and inserted, and messages without an id."""
    known = F.col("change") != INSERTED
    return changed.agg(
        F.count_if(known).alias("matched"), F.count_if(F.col("change") == MODIFIED).alias("modified"),
        F.count_if(F.col("change") == INSERTED).alias("upserted"),
        F.coalesce(F.sum(F.when(F.col(table.keys[0]).isNull(), F.col("n_messages"))), F.lit(0)).alias("without_id"),
    )
