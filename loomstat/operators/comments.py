"""Comment tables: cleaning, profiles, shares, rankings, word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loomstat.constants import STOP_WORDS
from loomstat.functions import text as T
from loomstat.session import durable


def prepare_comments(raw: DataFrame, *, keep_empty: bool = False) -> DataFrame:
    """The raw table with numbers and country codes repaired and five derived columns appended.

    Unknown columns pass through. Rows without a word after cleaning are dropped unless ``keep_empty``.
    """
    kept = raw if keep_empty else raw.filter(T.has_words(F.col("CommentText")))
    cleaned = kept.withColumns(
        {
            "Likes": T.safe_integer(F.col("Likes")),
            "Replies": T.safe_integer(F.col("Replies")),
            "CountryCode": T.clean_country_code(F.col("CountryCode")),
            "clean_text": T.clean_text(F.col("CommentText")),
        }
    )
    total = F.col("Likes") + F.col("Replies")
    return cleaned.withColumns(
        {
            "comment_word_count": T.word_count(F.col("clean_text")),
            "comment_char_count": F.length("clean_text"),
            "engagement_total": total,
            "engagement_level": T.classify_engagement(total),
        }
    )


def clean_text_column(df: DataFrame, input_col: str = "text", output_col: str = "clean_text") -> DataFrame:
    """``df`` with a cleaned copy of a text column; rows left without text are dropped."""
    kept = df.filter(T.has_words_strict(F.col(input_col)))
    return kept.withColumn(output_col, T.clean_text_strict(F.col(input_col)))


def group_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *keys)


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(part * F.lit(100.0).cast("double") / whole, digits)


def class_share(df: DataFrame, key: str) -> DataFrame:
    """Rows and percentage per class. The total is summed from the class counts, so the data is read once."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(key, "n", percent(F.col("n"), F.col("total"), 2).alias("pct"))


def engagement_by_class(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("Likes"), 2).alias("avg_likes"),
        F.round(F.avg("Replies"), 2).alias("avg_replies"),
        F.max("Likes").alias("max_likes"),
        F.max("Replies").alias("max_replies"),
    )


def summary_with_share(df: DataFrame, key: str) -> DataFrame:
    """Per class: rows, average and largest likes, share of all rows against a one-row total."""
    summary = engagement_by_class(df, key).select(
        key, F.col("n").alias("total_comments"), "avg_likes", "avg_replies", "max_likes"
    )
    summary = durable(summary, "summary")  # a row per class, read twice; the data is read once
    total = summary.agg(F.sum("total_comments").alias("grand_total"))
    share = percent(F.col("total_comments"), F.col("grand_total"), 2).alias("pct_of_total")
    return summary.crossJoin(F.broadcast(total)).select(*summary.columns, share)


def missing_values_by_column(df: DataFrame) -> DataFrame:
    """Null or blank values per column, fewest first, from one pass over the data."""
    counts = df.agg(
        *[
            F.count(F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), 1)).alias(c)
            for c in df.columns
        ]
    )
    return counts.unpivot([], df.columns, "column_name", "missing").orderBy("missing", "column_name")


def kept_removed_counts(before: DataFrame, keep: Column) -> DataFrame:
    """Rows before and after a filter and the rows it removes, in one pass."""
    return before.agg(
        F.count(F.lit(1)).alias("before"),
        F.count(F.when(keep, 1)).alias("after"),
        F.count(F.when(F.coalesce(keep, F.lit(False)), None).otherwise(1)).alias("removed"),
    )


def share_within(df: DataFrame, group: str, member: str, *, digits: int = 1) -> DataFrame:
    """Rows per (group, member) and their share within the group; windows see aggregated rows only."""
    counts = df.groupBy(group, member).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy(group))
    return counts.withColumn("pct_within", percent(F.col("n"), whole, digits))


def rank_within(df: DataFrame, group: str, member: str) -> DataFrame:
    """As :func:`share_within`, with the rank of the member by rows; equal counts share a rank."""
    by_size = Window.partitionBy(group).orderBy(F.desc("n"))
    return share_within(df, group, member).withColumn("rank_within", F.rank().over(by_size))


def top_per_group(df: DataFrame, group: str, *order: Column, k: int) -> DataFrame:
    """The first k rows of every group with their ``position``.

    The filter on row_number is applied per task before the shuffle, so a group costs k rows per task.
    """
    position = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("position", position).filter(F.col("position") <= k)


def top_liked(df: DataFrame, group: str, *, k: int = 3) -> DataFrame:
    liked = df.filter(F.col("Likes") > 0)
    return top_per_group(liked, group, F.desc("Likes"), F.col("CommentID"), k=k)


def topn_group_shares(df: DataFrame, group: str, member: str, *, n: int = 5, unknown: str = "Unknown") -> DataFrame:
    """Class shares inside the n largest groups.

    Both the ranking and the shares come from one aggregate per (group, member).
    """
    counts = df.filter(F.col(group) != unknown).groupBy(group, member).agg(F.count(F.lit(1)).alias("n"))
    largest = (
        counts.groupBy(group).agg(F.sum("n").alias("group_rows")).orderBy(F.desc("group_rows"), group).limit(n)
    )
    return counts.join(F.broadcast(largest), group).select(
        group, member, "n", percent(F.col("n"), F.col("group_rows"), 1).alias("pct_within")
    )


def word_counts(df: DataFrame, *keys: str, text: str = "clean_text", stop_words=STOP_WORDS, min_length: int = 3):
    """Occurrences of every word of at least ``min_length`` letters outside the stop list, per ``keys``."""
    words = df.select(*keys, F.explode(F.split(F.col(text), " ")).alias("word"))
    kept = words.filter((F.length("word") >= min_length) & ~F.col("word").isin(list(stop_words)))
    return kept.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))


def top_words(df: DataFrame, *, k: int = 20, **options) -> DataFrame:
    return word_counts(df, **options).orderBy(F.desc("n"), "word").limit(k)


def top_words_per_class(df: DataFrame, key: str, *, k: int = 10, **options) -> DataFrame:
    return top_per_group(word_counts(df, key, **options), key, F.desc("n"), F.col("word"), k=k)
