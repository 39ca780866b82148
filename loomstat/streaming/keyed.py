"""A keyed result table on plain Parquet: batches are appended and folded by levels, the newest row per key wins."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.sources import files

VERSION = "run string, batch bigint, commit bigint"
# Rows that one folded file holds at most.
FILE_ROWS = 2_000_000


@dataclass(frozen=True)
class Snapshot:
    """The folders that make up the table at one time, and the folded batches whose folders are still there."""

    folders: tuple[str, ...]
    folded: tuple[str, ...]
    version: int


@dataclass(frozen=True)
class KeyedTable:
    """Replace-or-insert by key without rewriting what is already stored.

    Each batch is one folder ``level=0/<commit time>-<run>-<number>``, complete once Spark's writer marked it so; of rows
    with one key the latest commit wins, whichever stream wrote it. A batch that is written again after a failure adds a
    folder of the same content, so it changes nothing. A write costs what the batch costs.

    ``fold`` puts every ``fan`` folders of a level into one of the next, sorted by key with Bloom filters, so a read opens
    some ``fan`` folders per level and there are as many levels as the logarithm of the batches. A manifest names the
    folders that count; it is replaced by a later one in one step, and what it no longer names stays until ``vacuum``, so
    a reader keeps the snapshot that it began with. Two streams may fold at a time: one manifest wins, the other's folder
    counts for nothing.
    """

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...] = ("comment_id", "video_id")
    newest_first: tuple[str, ...] = field(default=("fetched_at", "published_at"))
    fan: int = 8

    @staticmethod
    def run_for(checkpoint: str) -> str:
        """Name of the run that belongs to a checkpoint, the same after a restart."""
        return hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def latest(self, rows: DataFrame, order: list[Column], *, keep: tuple[str, ...] = ()) -> DataFrame:
        """One row per key, the greatest by ``order``; combined before the shuffle, so copies of a key are cheap."""
        columns = [*self.columns, *keep]
        rest = [c for c in columns if c not in self.keys]
        best = F.max(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], *rest)).alias("best")
        merged = rows.groupBy(*self.keys).agg(best)
        return merged.select(*[F.col(c) if c in self.keys else F.col(f"best.{c}").alias(c) for c in columns])

    @property
    def columns(self) -> list[str]:
        return T.StructType.fromDDL(self.schema).names

    @property
    def stored_schema(self) -> str:
        return f"{self.schema}, {VERSION}"

    @staticmethod
    def _newest() -> list[Column]:
        return [F.col("commit"), F.col("run"), F.col("batch")]

    def batch_folder(self, run: str, batch_id: int, commit: int) -> str:
        return f"level=0/{commit:020d}-{run}-{batch_id}"

    def snapshot(self) -> Snapshot:
        """What counts now: the folders of the newest manifest and the complete batches that none has folded."""
        versions = [n for n in files.names(self.spark, f"{self.path}/manifest") if n.endswith(".json")]
        manifest = json.loads(files.get(self.spark, f"{self.path}/manifest/{versions[-1]}")) if versions else {"folders": [], "folded": []}
        there = [f"level=0/{n}" for n in files.names(self.spark, f"{self.path}/level=0")]
        folded = set(manifest["folded"])
        fresh = [f for f in there if f not in folded and files.exists(self.spark, f"{self.path}/{f}/_SUCCESS")]
        return Snapshot((*manifest["folders"], *fresh), tuple(f for f in there if f in folded), int(versions[-1][:-5]) if versions else 0)

    def _rows(self, folders: list[str] | tuple[str, ...]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.stored_schema)
        return self.spark.read.schema(self.stored_schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self) -> DataFrame:
        return self.latest(self._rows(self.snapshot().folders), self._newest())

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys, few against the table; folded files without them are skipped by ranges and filters."""
        found = self._with_keys(self._rows(self.snapshot().folders), keys.select(*self.keys).distinct(), "left_semi")
        return self.latest(found, self._newest())

    def _with_keys(self, rows: DataFrame, others: DataFrame, how: str) -> DataFrame:
        """``rows`` joined by key with ``others``, a null key being a key like any other."""
        named = others.withColumnsRenamed({c: f"{c} of other" for c in self.keys})
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c} of other")) for c in self.keys])
        joined = rows.join(named, same, how)
        return joined if how == "left_semi" else joined.drop(*[f"{c} of other" for c in self.keys])

    def upsert(self, batch: DataFrame, *, run: str, batch_id: int, commit: int | None = None, keep: tuple[str, ...] = ()) -> int:
        """Store a batch; of several rows with one key the newest is kept. Returns the commit time, in microseconds.

        Columns in ``keep`` are written with the batch and are no part of the table.
        """
        commit = time.time_ns() // 1000 if commit is None else commit
        newest = self.latest(batch.select(*self.columns, *keep), [F.col(c) for c in self.newest_first], keep=keep)
        stamped = newest.select(
            "*", F.lit(run).alias("run"), F.lit(batch_id).cast("bigint").alias("batch"), F.lit(commit).cast("bigint").alias("commit")
        )
        stamped.write.mode("overwrite").parquet(f"{self.path}/{self.batch_folder(run, batch_id, commit)}")
        return commit

    def fold(self) -> int:
        """Fold every level that is due into the next one; returns how many times that was done."""
        done = 0
        while True:
            snapshot = self.snapshot()
            levels: dict[int, list[str]] = {}
            for folder in snapshot.folders:
                levels.setdefault(int(folder.split("/")[0].removeprefix("level=")), []).append(folder)
            due = [level for level, members in sorted(levels.items()) if len(members) >= self.fan]
            if not due:
                return done
            members = levels[due[0]]
            target = f"level={due[0] + 1}/{uuid.uuid4().hex}"
            self._write_folded(self.latest(self._rows(members), self._newest(), keep=("run", "batch", "commit")), target)
            kept = [f for level, names in levels.items() for f in names if level and f not in members]
            folded = [*snapshot.folded, *(f for f in members if f.startswith("level=0/"))]
            if not self._publish(snapshot.version + 1, [*kept, target], folded):
                return done
            done += 1

    def _write_folded(self, rows: DataFrame, folder: str) -> None:
        writer = rows.sortWithinPartitions(*self.keys).write.option("maxRecordsPerFile", FILE_ROWS)
        for key in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.parquet(f"{self.path}/{folder}")

    def _publish(self, version: int, folders: list[str], folded: list[str]) -> bool:
        text = json.dumps({"folders": sorted(folders), "folded": sorted(folded)})
        return files.put_new(self.spark, f"{self.path}/manifest/{version:010d}.json", text)

    def vacuum(self, *, older_than: float = 86_400.0) -> int:
        """Delete folders and manifests that no longer count and have not changed for ``older_than`` seconds.

        Readers that began before keep their files as long as that. Counts of deleted batches cannot be asked for again.
        """
        live, gone = set(self.snapshot().folders), 0
        for level in [n for n in files.names(self.spark, self.path) if n.startswith("level=")]:
            for name in files.names(self.spark, f"{self.path}/{level}", older_than=older_than):
                if f"{level}/{name}" not in live:
                    files.delete(self.spark, f"{self.path}/{level}/{name}")
                    gone += 1
        for name in files.names(self.spark, f"{self.path}/manifest", older_than=older_than)[:-1]:
            files.delete(self.spark, f"{self.path}/manifest/{name}")
        return gone

    def counters(self, *, run: str, batch_id: int) -> DataFrame:
        """One row on a stored batch against the table before it: rows matched, modified and inserted.

        A pass over all batches still stored, for any batch at any time; a stream that wants its counts as it goes keeps
        them in its state instead (``scoring.start_scoring``). A batch that was written again counts against what was
        there before its first commit.
        """
        stored = self._rows(self._history())
        own = stored.filter((F.col("run") == run) & (F.col("batch") == batch_id))
        began = own.agg(F.min("commit").alias("began"))
        batch = self.latest(own, [F.col("commit")])
        before = stored.filter((F.col("run") != run) | (F.col("batch") != batch_id))
        # One row, the time the batch was first stored.
        before = before.crossJoin(F.broadcast(began)).filter(F.col("commit") < F.col("began"))
        before = self._with_keys(before, batch.select(*self.keys), "left_semi")
        rest = [c for c in self.columns if c not in self.keys]
        old = self.latest(before, self._newest())
        old = old.select(*self.keys, F.struct(*rest).alias("old"))
        both = self._with_keys(batch.select(*self.keys, F.struct(*rest).alias("new")), old, "left")
        known = F.col("old").isNotNull()
        return both.agg(
            F.count_if(known).alias("matched"),
            F.count_if(known & ~F.col("old").eqNullSafe(F.col("new"))).alias("modified"),
            F.count_if(~known).alias("upserted"),
        )

    def _history(self) -> list[str]:
        """All batches, folded or not, and what a compacted table began with."""
        snapshot = self.snapshot()
        base = [f"level=1/{n}" for n in files.names(self.spark, f"{self.path}/level=1") if n == "compacted"]
        batches = [f for f in snapshot.folders if f.startswith("level=0/")]
        return [*base, *snapshot.folded, *batches]

    def compacted(self, target: str) -> "KeyedTable":
        """A new table at ``target`` that holds only the newest rows, as a batch older than all that follow."""
        table = KeyedTable(self.spark, target, self.schema, self.keys, self.newest_first, self.fan)
        zero = [F.lit("compacted").alias("run"), F.lit(0).cast("bigint").alias("batch"), F.lit(0).cast("bigint").alias("commit")]
        table._write_folded(self.read().select("*", *zero), "level=1/compacted")
        table._publish(1, ["level=1/compacted"], [])
        return table
