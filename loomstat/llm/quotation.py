"""Quotation linking: conversations in reply order, without the quotes.

Lines that begin with ``>`` are quoted, once per sign. Their normalised text is hashed and joined to the own lines of
earlier messages of the conversation; the message that most of the least quoted lines come from is what is replied to,
the latest of several. A message that quotes nothing known replies to the one before it. Messages that follow each
other in this way are a strand; a strand begins where a message replies to an earlier one than the last, and sorting by
``path`` and turn puts every message behind what it replies to, depth first.

All of it is DataFrame functions. "The latest earlier row" is looked up in stretches of turns, so a conversation or a
line that holds a third of all rows is spread over many tasks.

Defined cases: a null or empty text has one empty own line and no quote. Rows that share conversation and turn are one
message as far as links go; each of them is returned. Rows without conversation or turn reply to nothing. Columns with
clashing names are carried in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstat.llm.common import durable

MARKS = r"^(?:[ \t]*>)+"
# Turns that are looked through together.
STRETCH = 1024
# Turns up to 10**WIDTH - 1 sort as text.
WIDTH = 12


def quote_level(line: Column) -> Column:
    """Number of quote signs at the beginning of a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, f"({MARKS})", 1), "[^>]", ""))


def normalised(line: Column) -> Column:
    """A line without quote signs, in lower case, runs of blanks as one."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, MARKS, "")), r"\s+", " "))


def unquoted(text: Column) -> Column:
    """The own lines of a message."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.array_join(F.filter(lines, lambda line: ~line.rlike(MARKS)), "\n")


def latest_before(rows: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """``rows`` with ``name``: ``value`` (nulls aside) of the latest row of the same keys with a smaller ``order``."""
    marked = rows.withColumn("stretch", F.floor(F.col(order) / STRETCH))
    within = Window.partitionBy(*keys, "stretch").orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    marked = marked.withColumn("near", F.last(value, ignorenulls=True).over(within))
    known = F.col(value).isNotNull()
    ends = marked.groupBy(*keys, "stretch").agg(
        F.max_by(F.when(known, F.col(value)), F.when(known, F.col(order))).alias("end")
    )
    before = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    earlier = ends.select(*keys, "stretch", F.last("end", ignorenulls=True).over(before).alias("far"))
    found = marked.join(earlier, [*keys, "stretch"], "left")
    return found.select(*rows.columns, F.coalesce("near", "far").alias(name))


def reply_links(messages: DataFrame) -> DataFrame:
    """``conv, turn, n_quoted, n_linked, quotes``: quoted lines, those found in earlier messages, what is replied to.

    ``messages`` has ``conv, turn, text``; only messages with quoted lines have a row.
    """
    lines = messages.select("conv", "turn", F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
    lines = lines.select("conv", "turn", quote_level(F.col("line")).alias("level"), normalised(F.col("line")).alias("body"))
    quoted = lines.filter((F.col("level") > 0) & (F.col("body") != ""))
    # Own lines matter only where the conversation quotes at all.
    quoting = quoted.select("conv").distinct()
    own = lines.filter((F.col("level") == 0) & (F.col("body") != "")).join(quoting, "conv", "left_semi")
    hashed = F.sha2("body", 256).alias("hash")
    own = own.select("conv", "turn", hashed).distinct().withColumn("source", F.col("turn")).withColumn("level", F.lit(None).cast("int"))
    both = own.select("conv", "turn", "hash", "level", "source").union(
        quoted.select("conv", "turn", hashed, "level", F.lit(None).cast("bigint"))
    )
    found = latest_before(both, ["conv", "hash"], "turn", "source", "origin").filter(F.col("level").isNotNull())
    counts = found.groupBy("conv", "turn", "level", "origin").agg(F.count(F.lit(1)).alias("n"))
    # Few quote signs stand for a direct reply; then the number of lines counts, then the later message.
    best = F.max_by(F.col("origin"), F.when(F.col("origin").isNotNull(), F.struct(-F.col("level"), "n", "origin")))
    return counts.groupBy("conv", "turn").agg(
        F.sum("n").alias("n_quoted"), F.sum(F.when(F.col("origin").isNotNull(), F.col("n")).otherwise(0)).alias("n_linked"),
        best.alias("quotes"),
    )


def _paths(strands: DataFrame) -> DataFrame:
    """``conv, start, path`` of strands ``conv, start, up, at``: the strand and turn that the first message replies to.

    Each round joins a strand to what its ancestor knows, so rounds grow with the logarithm of the nesting.
    """
    piece = F.concat(
        F.lit("/"), F.lpad((F.lit(10**WIDTH - 1) - F.col("at")).cast("string"), WIDTH, "0"),
        F.lit("."), F.lpad(F.col("start").cast("string"), WIDTH, "0"),
    )
    known = durable(strands.select("conv", "start", "up", F.when(F.col("up").isNull(), "").otherwise(piece).alias("path")), "strands")
    while not known.filter(F.col("up").isNotNull()).isEmpty():
        above = known.select("conv", F.col("start").alias("up"), F.col("up").alias("next"), F.col("path").alias("head"))
        known = durable(
            known.join(above, ["conv", "up"], "left").select(
                "conv", "start", F.col("next").alias("up"), F.concat(F.coalesce("head", F.lit("")), "path").alias("path")
            ), "strands",
        )
    return known.select("conv", "start", "path")


def link_conversations(
    messages: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text"
) -> DataFrame:
    """``row`` (all columns of ``messages`` as a struct), ``own`` (the text without quotes), ``n_quoted``, ``n_linked``,
    ``reply_to`` (a turn), ``strand`` (its first turn) and ``path``; sort by conversation, path and turn."""
    rows = messages.select(
        F.struct("*").alias("row"), F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
        F.col(text_col).alias("text"),
    )
    placed = rows.filter(F.col("conv").isNotNull() & F.col("turn").isNotNull())
    quotes = durable(reply_links(placed.select("conv", "turn", "text")), "quote-links")
    turns = placed.select("conv", "turn").distinct().withColumn("self", F.col("turn"))
    turns = latest_before(turns, ["conv"], "turn", "self", "previous")
    turns = turns.join(quotes, ["conv", "turn"], "left").withColumn("reply_to", F.coalesce("quotes", "previous"))
    begins = F.col("previous").isNull() | (F.col("reply_to") != F.col("previous"))
    turns = turns.withColumn("begin", F.when(begins, F.col("turn")))
    turns = durable(
        latest_before(turns, ["conv"], "turn", "begin", "running").select(
            "conv", "turn", "n_quoted", "n_linked", "reply_to", "begin", F.coalesce("begin", "running").alias("strand")
        ), "reply-turns",
    )
    heads = turns.filter(F.col("begin").isNotNull()).select("conv", F.col("begin").alias("start"), F.col("reply_to").alias("at"))
    of_turn = turns.select("conv", F.col("turn").alias("at"), F.col("strand").alias("up"))
    paths = _paths(heads.join(of_turn, ["conv", "at"], "left").select("conv", "start", "up", "at"))
    linked = turns.join(paths.withColumnRenamed("start", "strand"), ["conv", "strand"]).select(
        "conv", "turn", "n_quoted", "n_linked", "reply_to", "strand", "path"
    )
    found = rows.join(linked, ["conv", "turn"], "left")
    none = F.lit(0).cast("bigint")
    return found.select(
        "row", unquoted(F.col("text")).alias("own"), F.coalesce("n_quoted", none).alias("n_quoted"),
        F.coalesce("n_linked", none).alias("n_linked"), "reply_to", "strand", "path",
    )
