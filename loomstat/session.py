"""Session factory and the shared folder every durable intermediate goes to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.enabled": "false",
}

# Most bytes of files and of shuffles that one task reads, where the session has Spark's own values. Ids and short
# strings take some 60 times their size on disk in the hash table of an aggregate, so these bound a task's memory.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": ("134217728b", "8m"),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", "16m"),
}

# Rows of a shuffle that meet in one partition on average, where their number is known; ids of papers and the like.
PARTITION_ROWS = 250_000


def build_session(
    app_name: str = "loomstat",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with AQE, ANSI and UTC on; the cluster's own settings win where they are given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a private temporary folder: on a cluster such a folder is not visible
    to the other machines, so a missing setting is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="loomstat-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; no two calls return the same one."""
    return f"{shared_folder(spark)}/loomstat/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def bounded_tasks(spark: SparkSession) -> None:
    """Let a task read no more the larger the tables are; a value that the caller has set stays as it is."""
    for key, (usual, bound) in TASK_BYTES.items():
        if spark.conf.get(key).removesuffix("b") == usual.removesuffix("b"):
            spark.conf.set(key, bound)


def durable(df: DataFrame, label: str = "cut", *, file_rows: int | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder once and read it back.

    Unlike a block cache this survives the loss of any executor, and the files carry statistics, so the planner
    picks later join strategies by measured size. ``file_rows`` bounds the rows of a file, for rows that take far more
    memory than disk: a task reads a row group whole, however few bytes it may read, and with 8 MB a task two files.
    """
    spark = df.sparkSession
    bounded_tasks(spark)
    path = new_path(spark, label)
    writer = df.write if file_rows is None else df.write.option("maxRecordsPerFile", file_rows)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def partitions_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Shuffles within have a partition per ``PARTITION_ROWS`` rows, at least as many as the session asks for.

    Adaptive execution joins small partitions but never cuts a large one, and buckets are as many as partitions; with a
    fixed number of either a task would hold more the larger the tables are.
    """
    bounded_tasks(spark)  # or joined partitions would be as large as before
    key, first = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before, before_first = spark.conf.get(key), spark.conf.get(first, None)
    wanted = max(int(before), -(-rows // PARTITION_ROWS))
    spark.conf.set(key, wanted)
    if before_first is not None:
        spark.conf.set(first, max(int(before_first), wanted))
    try:
        yield
    finally:
        spark.conf.set(key, before)
        if before_first is not None:
            spark.conf.set(first, before_first)


def place(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with a task per shuffle partition and equal ``keys`` in one, so that groups and joins on them move it no more."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


@contextmanager
def bucketed(df: DataFrame, *keys: str, label: str = "bucketed", placed: bool = False) -> Iterator[DataFrame]:
    """``df`` as a durable table hash-bucketed on ``keys`` with one bucket per shuffle partition.

    ``placed`` rows come from :func:`place` on the same keys and are written where they are.

    Joins on ``keys`` read it without an exchange, which is what a loop that joins the same big side again and
    again needs. The catalog entry lives as long as the context, so what is built from it must be written inside.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, label)
    table = "loomstat_" + path.rsplit("-", 1)[1]
    (
        (df if placed else place(df, *keys))
        .write.format("parquet")
        .bucketBy(buckets, *keys)
        .option("path", path)
        .saveAsTable(table)
    )
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
