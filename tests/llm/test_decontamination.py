from __future__ import annotations

import random
import re

import numpy as np
import pytest

from loomstat.llm import decontamination as dc


def words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def brute(texts, items, window):
    out = []
    for text in texts:
        w = words(text)
        hit, names = set(), set()
        for name, item in items:
            v = words(item)
            n = min(window, len(v))
            keys = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i:i + n]) in keys:
                    hit |= set(range(i, i + n))
                    names.add(str(name))
        out.append((len(w), len(hit), sorted(names)))
    return out


def cases():
    rnd = random.Random(8)
    vocabulary = ["a", "b", "É", "c3", "the"]
    some = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, some(rnd.randint(0, 9))) for i in range(14)] + [(20, None), (21, ""), (22, "..."), (23, "a"), (24, "the é É")]
    items += [(i + 100, t) for i, t in items[:2]]
    texts = [some(rnd.randint(0, 30)).replace(" ", rnd.choice([" ", ", ", "\n", "-"])).upper() for _ in range(150)]
    texts += [None, "", "?!", items[0][1], "x " * 40_000 + str(items[3][1]), "zzz", *texts[:3]]
    return texts, items


@pytest.mark.parametrize("options", [{}, {"shard_words": 40}, {"block_words": 15}])
def test_against_definition(spark, options):
    texts, items = cases()
    docs = spark.createDataFrame(
        [(i, t, "x", 5) for i, t in enumerate(texts)], "doc_id int, text string, n_hit string, row int"
    ).repartition(2)
    bench = spark.createDataFrame(items, "item_id int, text string")
    found = dc.find_benchmark(docs, bench, window=4, **options).select("row.*", "n_words", "items", "hits").collect()
    want = brute(texts, items, 4)
    assert len(found) == len(texts)
    for r in found:
        n = sum(h.stop - h.start for h in r.hits)
        assert (r.n_words, n, sorted(r["items"])) == want[r.doc_id], r.doc_id
        assert r.n_hit == "x" and r.row == 5
    clean = dc.decontaminate(docs, bench, window=4, **options)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, w in enumerate(want) if not w[1]]


def test_longest_matches(spark):
    docs = spark.createDataFrame([(1, "x a b c d y"), (2, "a b c d e"), (3, None)], "doc_id int, text string")
    bench = spark.createDataFrame([("i", "q a b c d e f"), ("j", "zz")], "item_id string, text string")
    rows = {(r.item, r.item_word): (r.n_words, r.id, r.word) for r in dc.longest_matches(docs, bench).collect()}
    assert rows == {("i", 1): (5, 2, 0), ("i", 2): (4, 2, 1), ("i", 3): (3, 2, 2), ("i", 4): (2, 2, 3), ("i", 5): (1, 2, 4)}


def test_suffix_array():
    rnd = np.random.default_rng(1)
    for size in (0, 1, 5, 60, 300):
        for top in (2, 3, 9):
            w = rnd.integers(0, top, size).astype(np.int32)

            def suffix(i):
                out = []
                while i < len(w) and w[i]:
                    out.append(int(w[i]))
                    i += 1
                return out

            order = dc.suffix_array(w, max(size, 1)).tolist()
            assert sorted(order) == np.flatnonzero(w).tolist()
            assert [suffix(i) for i in order] == sorted(suffix(i) for i in order)


def test_empty_tables(spark):
    docs, bench = "doc_id int, text string", "item_id int, text string"
    none = spark.createDataFrame([], docs)
    one = spark.createDataFrame([(1, "a b")], docs)
    assert dc.find_benchmark(none, spark.createDataFrame([(1, "a")], bench)).collect() == []
    (row,) = dc.find_benchmark(one, spark.createDataFrame([], bench)).collect()
    assert (row.n_words, row.n_hit) == (2, 0)
