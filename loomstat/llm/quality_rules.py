"""Quality rules as a short-circuit cascade.

A rule is a condition that rejects a document. Each rule's cost and the share it rejects are measured on a sample of
bounded size; the rules then run in order of rejected share per cost, and a document that one of them rejects is not
looked at by those that follow. The order has no influence on the verdict, only on the work.

:func:`judge` reports every feature, so it works all of them out first and orders the rules beyond the base rules.
:func:`keep_passing` reports none: there each rule, base rules included, works out what it reads itself, is timed with
that, and what only a later rule reads is never worked out for a document that was rejected before.

All of it is DataFrame functions: words by a split, repeated windows of words by hashes that are sorted only where
there is a repeat at all.

Defined cases: a null text counts as empty, without words and with no line that has one. Rows are judged one by one,
so repeated rows and null ids need no care; columns with the names of helpers are carried in a struct.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.llm.common import durable

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
# Documents that costs and selectivities are measured on at most.
SAMPLE = 2000


def word_features(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``row`` (all columns of ``docs``), ``text`` and what the rules read.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_lines`` with a word, ``n_dup_lines`` (equal
    to an earlier one) and ``n_repeat_words``, words in windows found twice or more. Windows are told apart by a
    64-bit hash of their words' 64-bit hashes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), text.alias("text"))
    with_words = rows.select(
        "row", "text",
        F.filter(F.split("text", BLANKS), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    hashed = with_words.select(
        "row", "text",
        F.size("words").alias("n"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    starts = F.sequence(F.lit(0), F.col("n") - window)
    whole = F.transform(starts, lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(window)]))
    windows = hashed.withColumn("windows", F.when(F.col("n") >= window, whole).otherwise(F.array().cast("array<bigint>")))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    ordered = windows.withColumn("ordered", F.when(repeats, F.array_sort(placed)))

    def twice(entry: Column, i: Column) -> Column:
        same = [F.coalesce(F.get("ordered", j)["w"] == entry["w"], F.lit(False)) for j in (i - 1, i + 1)]
        return same[0] | same[1]

    found = ordered.withColumn(
        "at", F.array_sort(F.transform(F.filter("ordered", twice), lambda entry: entry["i"]))
    )
    covered = F.aggregate(
        F.transform("at", lambda p, i: F.coalesce(F.least(F.lit(window), F.get("at", i + 1) - p), F.lit(window))),
        F.lit(0), lambda total, step: total + step,
    )
    return found.select(
        "row", "text", F.col("n").cast("bigint").alias("n_words"), "word_chars",
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.col("n_lines").cast("bigint").alias("n_lines"), "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def _let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` in which ``name`` stands for ``value``, worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _feature_sql(window: int = WINDOW) -> dict[str, str]:
    """Each column of :func:`word_features` as SQL of ``text`` alone."""
    blank = r"[\\x20\\x09-\\x0D]"
    words = f"filter(split(text, '{blank}+'), w -> w <> '')"
    lines = f"filter(split(text, '\\n'), line -> line rlike '[^{blank[1:]}')"
    whole = ", ".join(f"get(h, i + {k})" for k in range(window))
    steps = f"transform(at, (p, i) -> coalesce(least({window}, get(at, i + 1) - p), {window}))"
    twice = "coalesce(get(o, i - 1).w = e.w, false) or coalesce(get(o, i + 1).w = e.w, false)"
    covered = _let("at", f"array_sort(transform(filter(o, (e, i) -> {twice}), e -> e.i))", f"aggregate({steps}, 0, (a, b) -> a + b)")
    placed = _let("o", "array_sort(transform(v, (w, i) -> named_struct('w', w, 'i', i)))", covered)
    checked = f"if(size(array_distinct(v)) < size(v), {placed}, 0)"
    windows = _let("v", f"transform(sequence(0, size(h) - {window}), i -> xxhash64({whole}))", checked)
    repeated = _let("h", f"transform({words}, w -> xxhash64(w))", f"if(size(h) < {window}, 0, {windows})")
    return {
        "n_words": f"cast(size({words}) as bigint)",
        "word_chars": f"cast(length(array_join({words}, '')) as bigint)",
        "n_symbols": f"cast(length(text) - length(regexp_replace(text, '{SYMBOLS}', '')) as bigint)",
        "n_lines": f"cast(size({lines}) as bigint)",
        "n_dup_lines": _let("l", lines, "cast(size(l) - size(array_distinct(l)) as bigint)"),
        "n_repeat_words": f"cast({repeated} as bigint)",
    }


FEATURES = _feature_sql()


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over the columns of :func:`word_features`; null counts as no."""

    name: str
    rejects: str

    @property
    def condition(self) -> Column:
        return F.coalesce(F.expr(self.rejects), F.lit(False))

    @property
    def on_text(self) -> Column:
        """The condition over ``text`` alone: the features it names are worked out within it, each once."""
        sql = self.rejects
        for name, value in FEATURES.items():
            if re.search(rf"\b{name}\b", self.rejects):
                sql = f"exists(array({value}), {name} -> {sql})"
        return F.coalesce(F.expr(sql), F.lit(False))


BASE = (
    Rule("few_words", "n_words < 10"),
    Rule("repetition", "100 * n_repeat_words > 20 * n_words"),
)
RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("capitals", "10 * length(regexp_replace(text, '[^A-Z]', '')) > 4 * word_chars"),
    Rule("exclamations", "10 * (length(text) - length(replace(text, '!', ''))) > 3 * n_words"),
    Rule("digits", "10 * length(regexp_replace(text, '[^0-9]', '')) > 3 * word_chars"),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def over_features(rule: Rule) -> Column:
    return rule.condition


def over_text(rule: Rule) -> Column:
    return rule.on_text


def measure(
    features: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE,
    condition: Callable[[Rule], Column] = over_features,
) -> list[Measured]:
    """Cost and rejected share of each rule, best first; ``condition`` is how a rule is asked.

    The rows measured are a bounded number of some hundredth of ``features``; they are written once, so that each
    rule is timed on its own work. A job without any rule gives the time to take off.
    """
    columns = [c for c in features.columns if c != "row"]
    sample = durable(features.select(*columns).sample(0.01, seed=7).limit(sample_rows), "rule-sample")

    def run(condition: Column) -> tuple[float, int, int]:
        started = time.perf_counter()
        row = sample.agg(F.count(F.lit(1)).alias("n"), F.count_if(condition).alias("hit")).first()
        return time.perf_counter() - started, row.n, row.hit

    run(F.lit(False))
    floor = run(F.lit(False))[0]
    found = []
    for rule in rules:
        seconds, n, hit = run(condition(rule))
        found.append(Measured(rule, max(seconds - floor, 1e-3), (hit + 1) / (n + 2)))
    return sorted(found, key=lambda m: (-m.gain, m.rule.name))


def cascade(rules: Sequence[Rule], condition: Callable[[Rule], Column] = over_features) -> Column:
    """Whether no rule rejects; a rule is evaluated only for rows that passed those before it."""
    if not rules:
        return F.lit(True)
    verdict = F.when(condition(rules[0]), False)
    for rule in rules[1:]:
        verdict = verdict.when(condition(rule), False)
    return verdict.otherwise(True)


def judge(
    docs: DataFrame, *, text_col: str = "text", base: Sequence[Rule] = BASE, rules: Sequence[Rule] = RULES,
    sample_rows: int = SAMPLE,
) -> DataFrame:
    """``row``, the features, ``base_failed`` and ``kept``: neither a base rule nor one of ``rules`` rejects."""
    features = word_features(docs, text_col)
    ordered = [m.rule for m in measure(features, rules, sample_rows)]
    failed = ~cascade(base)
    return features.withColumn("base_failed", failed).withColumn(
        "kept", F.when(F.col("base_failed"), False).otherwise(cascade(ordered))
    ).drop("text")


def keep_passing(
    docs: DataFrame, *, text_col: str = "text", base: Sequence[Rule] = BASE, rules: Sequence[Rule] = RULES,
    sample_rows: int = SAMPLE,
) -> DataFrame:
    """``docs`` without the documents that a rule rejects; a rule's features are worked out when it is asked."""
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = [m.rule for m in measure(rows, [*base, *rules], sample_rows, over_text)]
    return rows.filter(cascade(ordered, over_text)).select("row.*")
