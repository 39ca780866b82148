from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from loomstat.llm import quality_rules as rules

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = BLANK.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [line for line in text.split("\n") if BLANK.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)),
        len(covered),
    )


def cases():
    rnd = random.Random(3)
    texts = [
        "".join(rnd.choice(["a", "b", "é", "AB", "#", " ", " ", "\n", "\t", "\x0b", "\x1f", "\xa0", "😀"]) for _ in range(rnd.randint(0, 120)))
        for _ in range(250)
    ]
    texts += ["one two three four five six seven eight nine ten " * 400, "a" * 100_000, None, "", " \n \t\n", "w " * 4, "w " * 5, "w " * 6]
    texts += ["line of words\n" * 3, "\\x20 $1 [a]", *texts[:5]]
    return texts


def test_features_against_definition(spark):
    texts = cases()
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)], "doc_id int, text string, n_words string, h int")
    found = rules.word_features(docs.repartition(3)).collect()
    assert len(found) == len(texts)
    for r in found:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words)
        assert got == brute(texts[r.row.doc_id]), texts[r.row.doc_id]
        assert r.row.n_words == "c" and r.row.h == 1


def test_verdict_does_not_depend_on_order(spark):
    docs = spark.createDataFrame(list(enumerate(cases())), "doc_id int, text string")
    features = rules.word_features(docs)
    many = [*rules.RULES, rules.Rule("null", "cast(null as boolean)"), rules.Rule("short", "n_words < 30")]
    one = features.select("row.doc_id", rules.cascade(many).alias("kept")).collect()
    other = features.select("row.doc_id", rules.cascade(many[::-1]).alias("kept")).collect()
    assert sorted(one) == sorted(other)
    kept = rules.keep_passing(docs, rules=many)
    assert kept.columns == docs.columns
    verdict = dict(map(tuple, one))
    base = {i for i, t in enumerate(cases()) if (b := brute(t))[0] < 10 or 100 * b[5] > 20 * b[0]}
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in sorted(verdict) if verdict[i] and i not in base]


def test_order_is_by_rejections_per_cost(spark):
    docs = spark.range(30_000).selectExpr("cast(id as int) doc_id", "concat('word number ', id, ' and more') text")
    found = rules.measure(rules.word_features(docs), rules.RULES, sample_rows=500)
    assert [m.gain for m in found] == sorted((m.gain for m in found), reverse=True)
    assert {m.rule for m in found} == set(rules.RULES)


def test_empty_table_and_no_python(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    judged = rules.judge(docs)
    assert judged.collect() == []
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_features_of_text_alone(spark):
    docs = spark.createDataFrame(list(enumerate(cases())), "doc_id int, text string")
    names = list(rules.FEATURES)
    own = [F.expr(sql).alias(f"own_{name}") for name, sql in rules.FEATURES.items()]
    for r in rules.word_features(docs).select(*names, *own).collect():
        assert [r[n] for n in names] == [r[f"own_{n}"] for n in names]


def test_a_later_rule_is_not_evaluated_for_rejected_rows(spark):
    """The later rule works out repeated windows and fails when it is asked."""
    docs = spark.createDataFrame([(i, "too short") for i in range(50)], "doc_id int, text string")
    costly = rules.Rule("costly", "n_repeat_words >= 0 and cast(raise_error('asked') as boolean)")
    order = [rules.BASE[0], costly]
    assert docs.filter(rules.cascade(order, rules.over_text)).collect() == []
    with pytest.raises(Exception, match="asked"):
        docs.filter(rules.cascade(order[::-1], rules.over_text)).collect()


def test_costly_features_count_as_a_rule_s_cost(spark):
    """With equal rejections the rule that works out windows comes after the one that counts characters."""
    docs = spark.range(20_000).selectExpr("cast(id as int) doc_id", "repeat(concat('word', id, ' and more '), 200) text")
    rows = docs.select("text")
    cheap, costly = rules.Rule("z_cheap", "length(text) < 0"), rules.Rule("a_costly", "n_repeat_words < 0")
    found = rules.measure(rows, [costly, cheap], 200, rules.over_text)
    assert [m.rule for m in found] == [cheap, costly]


def test_keep_passing_with_clashing_columns_and_empty_table(spark):
    texts = cases()
    schema = "doc_id int, text string, row string, n_words string, h int, w int"
    docs = spark.createDataFrame([(i, t, "r", "n", 1, 2) for i, t in enumerate(texts)], schema)
    kept = rules.keep_passing(docs)
    judged = {r.row.doc_id for r in rules.judge(docs).select("row", "kept").collect() if r.kept}
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == judged
    plan = kept._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert rules.keep_passing(docs.limit(0)).collect() == []
