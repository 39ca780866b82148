from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from loomstat.llm import simhash
from loomstat.llm.queries import op2_simhash

SF_DIR = "/root/testdata/sf0.001"


def print_of(text, k):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance):
    """Index of the group's first member for every entry, by comparing all pairs."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(prints))]


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def check(spark, docs, shingle, distance, **options):
    frame = spark.createDataFrame(
        [(i, t, "x", 3) for i, t in docs], "doc_id bigint, text string, fp string, component int"
    ).repartition(3)
    found = simhash.near_duplicates(frame, shingle=shingle, distance=distance, **options).collect()
    prints = [print_of(t, shingle) for _, t in docs]
    groups = components(prints, distance)
    smallest = {}
    for (i, _), g in zip(docs, groups):
        if i is not None:
            smallest[g] = min(smallest.get(g, i), i)
    want = sorted((i is None, i or 0, signed(p), smallest.get(g) or 0) for (i, _), p, g in zip(docs, prints, groups))
    assert sorted((r.id is None, r.id or 0, r.fp, r.component or 0) for r in found) == want
    kept = simhash.keep_one_of_each(frame, shingle=shingle, distance=distance, **options)
    assert kept.columns == frame.columns
    rows = kept.collect()
    assert len(rows) == len(set(groups))
    by_text = {t: g for (_, t), g in zip(docs, groups)}
    assert {by_text[r.text] for r in rows} == set(groups)
    assert all(r.doc_id == smallest.get(by_text[r.text]) and r.fp == "x" for r in rows)


def cases():
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    docs = []
    for _ in range(350):
        w = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, 2, 4])):
            w[rnd.randrange(len(w))] = rnd.choice(words).upper()
        docs.append(rnd.choice([" ", "\n", "\t "]).join(w))
    docs += [None, "", " \n", "One", "one", "x " * 50_000, "x " * 49_999]
    numbered = [(10 + i, t) for i, t in enumerate(docs)]
    rnd.shuffle(numbered)
    return numbered + [(None, docs[0]), (None, "some text of nobody else at all"), (None, "and one more of them"), (11, "eleven again"), numbered[0]]


@pytest.mark.parametrize("shingle, distance, block", [(1, 8, 8192), (2, 4, 8192), (1, 8, 40), (1, 3, 16)])
def test_against_all_pairs(spark, shingle, distance, block):
    check(spark, cases(), shingle, distance, block=block)


def test_dense_group_hands_on_a_forest(spark):
    """Fingerprints around one centre: their links are many, what is handed on is not."""
    rng = np.random.default_rng(7)
    centre = int(rng.integers(1 << 62))
    prints = {centre}
    while len(prints) < 1500:
        prints.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False)))
    prints = [signed(p) for p in prints] + [int(x) for x in rng.integers(-(1 << 62), 1 << 62, 200)]
    frame = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    found = simhash.links(frame, distance=4, block=500).collect()
    assert len(found) < 40 * len(prints)
    near = {p: p for p in prints}

    def root(p):
        while near[p] != p:
            p = near[p]
        return p

    for a, b in found:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 4
        near[root(a)] = root(b)
    want = components([p & (2**64 - 1) for p in prints], 4)
    assert len({root(p) for p in prints}) == len(set(want))


def test_thresholds_are_complete():
    rng = np.random.default_rng(3)
    sample = rng.integers(-(1 << 62), 1 << 62, 600)
    for total in (10, 10_000, 10_000_000, 10**10):
        for distance in (0, 1, 4, 7):
            parts = simhash.plan(sample, total, distance)
            assert sum(p.threshold + 1 for p in parts) == distance + 1
            assert len({b for p in parts for b in p.bits}) == sum(len(p.bits) for p in parts)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.keep_one_of_each(docs).collect() == []


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    docs.sort()
    prints = [print_of(t, 4) for _, t in docs]
    groups = components(prints, 4)
    found = sorted(tuple(r) for r in op2_simhash(spark, SF_DIR).select("doc_id", "fingerprint", "component_id").collect())
    assert found == [(d, f"{p:016x}", docs[g][0]) for (d, _), p, g in zip(docs, prints, groups)]
