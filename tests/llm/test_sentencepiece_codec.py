from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from loomstat.llm import sentencepiece_codec as sp
from loomstat.llm.queries import op7_sentencepiece

PATH = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = "abcé ▁\n\t  thing<s></s><0x0A>€😀Ａﬁ\x00\r​\x85日本語, .ÉR!|%$#(')\"-0129_"
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rnd = random.Random(3)
    made = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 16))) for _ in range(3000)]
    made += [" " * rnd.randint(1, 40) + t for t in made[:300]]
    return [*made, None, "", " ", "x" * 3000, "ab " * 20_000, "日本" * 500, "é" * 999, "\n" * 50, "the same", "the same"]


def test_encoding_and_decoding(spark, library):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(rows)], "doc_id int, text string, n_tokens string")
    ids = docs.select("doc_id", sp.encode_ids("text", PATH).alias("ids"), sp.digest("text", PATH).alias("d"))
    out = ids.select("*", sp.decode_ids("ids", PATH).alias("back")).orderBy("doc_id").collect()
    for text, row in zip(rows, out):
        want = [*library.encode(text or ""), library.eos_id()]
        assert row.ids == want
        assert row.back == library.decode(want)
        assert tuple(row.d) == (
            len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest(),
            hashlib.sha256(row.back.encode()).hexdigest(),
        )


def test_decoding_of_any_ids(library):
    rnd, own = random.Random(4), sp.codec(PATH)
    for _ in range(5000):
        ids = [
            rnd.choice([0, 1, 2, rnd.randint(3, 258), rnd.randint(3, 258), 259, 28705, rnd.randint(259, 31999)])
            for _ in range(rnd.randint(0, 8))
        ]
        assert own.decode(ids) == library.decode(ids)


def test_bounded_memory_of_cuts(library, monkeypatch):
    monkeypatch.setattr(sp, "KNOWN_CUTS", 20)
    own = sp.Codec(PATH)
    for text in texts()[:400]:
        (cuts, table), = own.encode([text])
        assert [int(i) for c in cuts for i in table[c].split()] == library.encode(text or "")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert docs.select(sp.encode_ids("text", PATH), sp.digest("text", PATH)).collect() == []


def test_query(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in op7_sentencepiece(spark, SF_DIR).collect()}
    assert len(found) == len(docs)
    for doc in docs:
        ids = [*library.encode(doc.text or ""), library.eos_id()]
        row = found[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
