from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loomstat.llm import line_dedup

STRIP = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id bigint, text string, keep string, h1 int"


def brute(rows, min_chars, min_docs):
    """(id, text) -> kept lines, straight from the definition."""
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(STRIP))

    held = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(doc)
    keeper = {
        k: max(docs, key=lambda d: (d is not None, d or 0)) for k, docs in held.items() if len(docs) >= min_docs
    }
    return {
        (doc, text): [line for line in (text or "").split("\n") if keeper.get(key(line), doc) == doc]
        for doc, text in rows
    }


def cases():
    rnd = random.Random(5)
    lines = [f"line {i} of some length é{i}" for i in range(30)] + ["short", "", "  \t"]
    rows = [
        (i, "\n".join(rnd.choice(lines).upper() if rnd.random() < .2 else rnd.choice(lines) + " " for _ in range(rnd.randint(0, 8))))
        for i in range(120)
    ]
    hot = "the line that a third of all documents hold"
    rows += [(1000 + i, f"{hot}\nown text of document number {i}\n{hot}") for i in range(400)]
    rows += [(None, hot), (None, "another " + hot), (7, None), (8, ""), (9, "x" * 300_000 + "\n" + hot)]
    rows += [(1000, rows[120][1]), (1001, "second text under one id\n" + hot)]
    return rows


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_against_definition(spark, partitions):
    rows = cases()
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        out = line_dedup.drop_repeated_lines(docs, min_chars=20, min_docs=5)
        assert out.columns == docs.columns
        marked = line_dedup.with_bitmaps(docs, min_chars=20, min_docs=5)
        digests = marked.select(
            "row.doc_id", line_dedup.kept_digest(F.col("row.text"), "keep", "n_lines", "n_dropped"), "n_lines", "n_dropped"
        ).collect()
        found = sorted((r.doc_id is None, r.doc_id or 0, r.text, r.keep, r.h1) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute(rows, 20, 5)
    assert found == sorted((d is None, d or 0, "\n".join(want[d, t]), "clash", 1) for d, t in rows)
    assert sorted((r[0] or 0, r[1], r[2] - r[3]) for r in digests) == sorted(
        (d or 0, hashlib.sha256("\n".join(want[d, t]).encode()).hexdigest(), len(want[d, t])) for d, t in rows
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert line_dedup.drop_repeated_lines(docs).collect() == []
