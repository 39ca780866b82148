"""High-water-mark ingest: per source only rows newer than the last ones taken."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.functions.text import parse_rfc3339, to_rfc3339, utc_now

STATE_SCHEMA = "video_id string, last_fetched_time string, first_run_completed boolean, updated_at string"


def new_rows(source: DataFrame, state: DataFrame, *, key: str = "video_id", time: str = "published_at") -> DataFrame:
    """Rows published after their source's mark; a source without a mark is taken whole."""
    marks = state.select(key, parse_rfc3339(F.col("last_fetched_time")).alias("__mark"))
    published = parse_rfc3339(F.col(time))
    fresh = source.join(marks, key, "left").filter(F.col("__mark").isNull() | (published > F.col("__mark")))
    return fresh.select(*source.columns)


def unreadable_rows(source: DataFrame, state: DataFrame, *, key: str = "video_id", time: str = "published_at") -> DataFrame:
    """Rows of known sources whose time cannot be read, so that no mark says whether they are new; kept apart."""
    known = state.filter(F.col("last_fetched_time").isNotNull()).select(key)
    return source.filter(parse_rfc3339(F.col(time)).isNull()).join(known, key, "left_semi")


def ingest(
    source: DataFrame, tracked: DataFrame, folder: str, *, key: str = "video_id", time: str = "published_at",
    order: str = "comment_id", now: Column | None = None,
) -> str:
    """One round against the state in ``folder``: write the batch, then the state after it. Returns the batch's path.

    Round n leaves ``batch/round=n``, rows in time order within each file, ``unreadable/round=n`` and then
    ``state/round=n``; the state is what makes the round count. A round that failed before is written again from the
    same state, so nothing is taken twice, and nothing that a reader may have open is replaced.
    """
    spark = source.sparkSession
    try:
        done = spark.read.schema(f"{STATE_SCHEMA}, round int").parquet(f"{folder}/state")
        last = done.agg(F.max("round")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        done, last = spark.createDataFrame([], f"{STATE_SCHEMA}, round int"), None
    number = 0 if last is None else last + 1
    state = done.filter(F.col("round") == (-1 if last is None else last)).drop("round")
    path = f"{folder}/batch/round={number}"
    rows = new_rows(source, state, key=key, time=time)
    rows.sortWithinPartitions(key, parse_rfc3339(F.col(time)), order).write.mode("overwrite").parquet(path)
    unreadable_rows(source, state, key=key, time=time).write.mode("overwrite").parquet(f"{folder}/unreadable/round={number}")
    batch = spark.read.schema(source.schema).parquet(path)
    after = next_state(batch, state, tracked, key=key, time=time, now=now)
    after.write.mode("overwrite").parquet(f"{folder}/state/round={number}")
    return path


def next_state(
    batch: DataFrame, state: DataFrame, tracked: DataFrame, *, key: str = "video_id", time: str = "published_at",
    now: Column | None = None,
) -> DataFrame:
    """Marks after ``batch`` was written: the newest row taken, else the old mark, else (an empty first run) now.

    ``tracked`` lists every source to follow. Newest times are combined map-side, so a busy source costs no more
    than a quiet one.
    """
    now = now if now is not None else utc_now()
    newest = batch.groupBy(key).agg(F.max(parse_rfc3339(F.col(time))).alias("__newest"))
    known = state.select(
        key, parse_rfc3339(F.col("last_fetched_time")).alias("__mark"), F.col("updated_at").alias("__updated")
    )
    joined = tracked.select(key).distinct().join(known, key, "left").join(newest, key, "left")
    changed = F.col("__newest").isNotNull() | F.col("__mark").isNull()
    return joined.select(
        key,
        to_rfc3339(F.coalesce("__newest", "__mark", now)).alias("last_fetched_time"),
        F.lit(True).alias("first_run_completed"),
        F.when(changed, to_rfc3339(now)).otherwise(F.col("__updated")).alias("updated_at"),
    )
