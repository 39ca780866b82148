from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from loomstat.llm import toxicity as tox
from loomstat.llm.queries import op10_toxicity

SF_DIR = "/root/testdata/sf0.001"
BAD = ["blockhead", "ninny", "scoundrel"]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_finds_what_edit_distance_finds():
    rnd = random.Random(1)
    terms = {"".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 7))): 1.0 for _ in range(60)}
    for distance in (1, 2):
        trie = tox.Trie(terms, distance)
        for _ in range(1500):
            word = "".join(rnd.choice("abcé") for _ in range(rnd.randint(0, 8)))
            want = {(t, edits(word, t)) for t in terms if edits(word, t) <= distance}
            assert {(t, e) for t, _, e in trie.find(word)} == want


def corpus(spark, n=1500):
    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choice("etaonris") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(10, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(BAD) + rnd.choice(["", ",", "!!"]))
        elif i % 6 == 1:
            at = rnd.randrange(len(words))
            words[at:at] = ["he", "quoted", '"' + rnd.choice(BAD) + '"', "yesterday"]
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    rows += [(n, None, "x"), (n + 1, "", "x"), (n + 2, "et " * 40_000, None), (n + 3, "you blokhead and you ninnny are all", "x"),
             (None, "a scoundrel you are, scoundrel ninny", "x"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string").repartition(3)
    return docs, spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id bigint, toxic int"), dict(labels)


def test_learns_terms_misspellings_and_quotation(spark):
    docs, labels, truth = corpus(spark)
    model = tox.fit_documents(docs, labels)
    assert set(BAD) <= set(model.whole)
    assert model.context["quoted"] < 0
    scored = {r.doc_id: r.s for r in docs.select("doc_id", model.column("text").alias("s")).collect()}
    assert all(0 <= s <= 1 for s in scored.values())
    held = [(scored[i] >= 0.5) == bool(t) for i, t in truth.items() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean(held) > 0.97
    assert scored[1503] >= 0.5 and scored[None] >= 0.5
    assert scored[1500] == scored[1501] < 0.1 and scored[1502] < 0.1
    lexicon = model.lexicon()
    assert [h[0] for h in lexicon.hits("no Blokhead here, (ninny)".lower().split())] == [1, 3]


def test_without_labels_or_documents(spark):
    docs, labels, _ = corpus(spark, 12)
    none = tox.fit_documents(docs, labels.filter("false"))
    assert docs.select(F.round(F.max(none.column("text")), 6)).first()[0] == 0.5
    assert docs.filter("false").select(none.column("text")).collect() == []


def test_query(spark):
    out = op10_toxicity(spark, SF_DIR)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    assert out.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_families_of_words_keep_their_misspellings():
    """Words that a beginning explains stay terms, and beginnings are met with an edit too."""
    from types import SimpleNamespace as Row

    model = tox.ToxicityModel()
    family = [("blorkig", 30), ("blorkigs", 30), ("blorkigic", 30)]
    rows = [Row(kind=tox.WHOLE, entry=w, odds=4.0, toxic=n) for w, n in family]
    tox._take(model, rows + [Row(kind=tox.BEGINNING, entry="blork", odds=4.0, toxic=90)])
    lexicon = model.lexicon()
    assert set(model.whole) == {w for w, _ in family} and set(model.beginnings) == {"blork"}
    for word in ("blorkg", "blorrkig", "bloorkigs", "blurkery", "blrkish"):
        assert lexicon.look(word) == (4.0, 1), word
    assert lexicon.look("blorkery") == (4.0, 2)
    assert lexicon.look("bxorxery") is None


def test_prefix_automaton_finds_beginnings():
    rnd = random.Random(7)
    terms = {"".join(rnd.choice("abcd") for _ in range(rnd.randint(4, 6))): 1.0 for _ in range(12)}
    trie = tox.Trie(terms, prefix=True)
    for _ in range(1500):
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 9)))
        want = {(t, e) for t in terms if (e := min(edits(word[:n], t) for n in range(len(word) + 1))) <= 1}
        assert {(t, e) for t, _, e in trie.find(word)} == want


def swapped_edits(a, b):
    """As edits(), but a swap of neighbours that stay together is one."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(rows[i - 1][j] + 1, row[j - 1] + 1, rows[i - 1][j - 1] + (x != y)))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                row[j] = min(row[j], rows[i - 2][j - 2] + 1)
        rows.append(row)
    return rows[-1][-1]


def test_automaton_with_swaps():
    rnd = random.Random(2)
    terms = {"".join(rnd.choice("abcé") for _ in range(rnd.randint(3, 9))): 1.0 for _ in range(60)}
    for distance in (1, 2):
        trie = tox.Trie(terms, distance, swaps=True)
        for n in range(1500):
            word = list(rnd.choice(list(terms)) if n % 2 else "".join(rnd.choice("abcé") for _ in range(rnd.randint(0, 10))))
            for _ in range(distance if len(word) > 1 else 0):
                at = rnd.randrange(len(word) - 1)
                word[at:at + 2] = word[at:at + 2][::-1]
            word = "".join(word)
            want = {(t, e) for t in terms if (e := swapped_edits(word, t)) <= distance}
            assert {(t, e) for t, _, e in trie.find(word)} == want


def test_planted_swaps_and_short_terms():
    lexicon = tox.ToxicityModel(whole={"blorkig": 3.0, "wrimthless": 3.0, "scaz": 3.0, "zup": 3.0}).lexicon()
    for word in ("bolrkig", "blokrig", "wirmthless", "rwimthlses", "wr1mthl3ss", "scvz", "sczaz", "caz", "csaz"):
        assert lexicon.look(word) == (3.0, 1), word
    for word in ("bolrkgi", "wr1mthl3zs", "zuup", "zpu"):
        assert lexicon.look(word) is None, word
