from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_decontamination import brute as contaminated
from test_line_dedup import brute as deduplicated
from test_simhash import components, print_of

import corpus_pipeline
from loomstat.llm import quality
from loomstat.llm.common import durable

NAMES = ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "SentencePiece encoding and decoding"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with junk, shared lines, near copies and benchmark passages."""
    rnd = random.Random(12)
    vocabulary = ["".join(rnd.choice("aeinorst") for _ in range(rnd.randint(2, 7))) for _ in range(900)]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    shared = [prose(12) for _ in range(4)]
    bench = [(i, prose(14)) for i in range(6)]
    rows, labels = [], []
    for i in range(300):
        text = "\n".join(prose(rnd.randint(5, 25)) + "." for _ in range(rnd.randint(2, 5)))
        junk = i % 5 == 3
        if junk:
            text = " ".join(w + "%%%" for w in text.split())
        elif i % 7 == 2:
            text += "\n" + rnd.choice(shared)
        elif i % 11 == 4:
            text += " " + rnd.choice(bench)[1]
        elif i % 13 == 5:
            text = rows[rnd.randrange(len(rows))][1]
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int("%%%" not in text), 0))
    rows += [(400, None, None, None, None), (401, "", "en", "s", 0), rows[0], rows[10]]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id int, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def key(row):
    return (row[0], row[1] or "", len(row))


def test_stages_against_plain_python(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    outs = []
    for _, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, folder), "test-stage")
        outs.append(docs)
    for out in outs[:-1]:
        assert out.columns == columns
    before = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]

    model = quality.fit_documents(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    kept = [r for r in before if model.score(quality.matrix(pa.array([r[1]], pa.string())))[0] >= 0.3]
    assert sorted(map(tuple, outs[0].collect()), key=key) == sorted(kept, key=key)
    assert sum("%%%" in (r[1] or "") for r in kept) == 0 and len(kept) > 200

    lines = deduplicated([r[:2] for r in kept], 40, 5)
    texts = [(r[0], "\n".join(lines[r[0], r[1]]), *r[2:4]) for r in kept]
    rows = [(*r, len(r[1])) for r in texts]
    assert sorted(map(tuple, outs[1].collect()), key=key) == sorted(rows, key=key)

    rows.sort(key=key)
    groups = components([print_of(r[1], 4) for r in rows], 4)
    single = [r for i, (r, g) in enumerate(zip(rows, groups)) if g == i]
    got = sorted(map(tuple, outs[2].collect()), key=key)
    assert got == single and len(single) < len(rows) - 10

    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = [r for r, found in zip(single, contaminated([r[1] for r in single], items, 10)) if not found[1]]
    assert sorted(map(tuple, outs[3].collect()), key=key) == clean and len(clean) < len(single)

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    last = {r.doc_id: r for r in outs[4].collect()}
    assert sorted(last) == [r[0] for r in clean]
    for r in clean:
        ids = [*library.encode(r[1]), library.eos_id()]
        row = last[r[0]]
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).select("doc_id", "ids_sha256").collect()) == sorted(
        (r.doc_id, r.ids_sha256) for r in last.values())


def test_clashing_columns_empty_and_very_long(spark, folder, tmp_path):
    """Columns named like those that stages add; a table without rows; a text far longer than the others."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = ["ids", "digest", "n_tokens", "Ids_SHA256", "row", "tokens", "key", "keep", "label", "score"]
    rnd = random.Random(1)
    long = " ".join("".join(rnd.choice("aeinorst") for _ in range(5)) for _ in range(60_000))
    odd = docs.unionByName(spark.createDataFrame([(900, long, "en", "s", len(long))], docs.schema))
    for name in names:
        odd = odd.withColumn(name, F.lit("x"))
    odd.filter("doc_id > 250").write.parquet(str(tmp_path / "documents.parquet"))
    for table in ("benchmark", "labels"):
        spark.read.parquet(f"{folder}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert {"ids", "n_tokens", "ids_sha256", "decoded_sha256", "digest", "row", "key"} <= set(found.columns)
    row = {r.doc_id: r for r in found.collect()}[900]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert row.ids == [*library.encode(long), library.eos_id()] and row.n_tokens == len(row.ids) and row.digest == "x"

    empty = str(tmp_path / "empty")
    for table in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{empty}/{table}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
