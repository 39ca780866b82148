"""Line deduplication: lines found in many documents stay in one of them only.

Line hashes are range-partitioned by (hash, document, descending) and sorted within each partition by hash, document
and position. A task streams its rows once: the first document of a hash is the one that keeps its lines. A hash at
the edge of a partition may go on in the next one, so a line that a third of all documents hold is spread over many
tasks; the edges, two rows a partition at most, are settled afterwards. What comes out is a compressed bitmap of kept
lines per document; text is touched only by who applies the bitmaps.

Defined cases: a null or empty text is one empty line. A null id is a document of its own, smaller than all others.
Rows with one id count as one document; rows equal in id and text get the same bitmap. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loomstat.llm.common import durable, fold, shuffle_partitions, slices, text_hash, text_key, utf8

STRIP = b" \t\n\x0b\x0c\r"
LINES = "id bigint, th bigint, h1 bigint, h2 bigint, pos int, n_lines int"
FOUND = "kind tinyint, h1 bigint, h2 bigint, id bigint, th bigint, pos int, n_docs bigint"
DROP, OPEN, EDGE = 0, 1, 2


def _points(line: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(line) if line.isascii() else len(line.decode())


def _hash_lines(min_chars: int):
    """Per document a header row (no hash) with its number of lines, and a row for each line long enough."""

    def run(batches):
        for batch in slices(batches):
            out = [[], [], [], [], [], []]
            ids, ths, h1s, h2s, positions, counts = out
            for doc, text in zip(batch.column("id").to_pylist(), utf8(batch.column("text"))):
                th = text_hash(text)
                lines = (text or b"").split(b"\n")
                ids.append(doc), ths.append(th), h1s.append(None), h2s.append(None)
                positions.append(None), counts.append(len(lines))
                for pos, line in enumerate(lines):
                    if len(line) < min_chars:
                        continue
                    key = fold(line.strip(STRIP))
                    if len(key) < min_chars or _points(key) < min_chars:
                        continue
                    wide = xxhash.xxh3_128_intdigest(key)
                    ids.append(doc), ths.append(th), positions.append(pos), counts.append(None)
                    h1s.append((wide >> 64) - (1 << 63)), h2s.append((wide & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, kinds)], ["id", "th", "h1", "h2", "pos", "n_lines"]
            )

    return run


def _stream(min_docs: int):
    """Walk one sorted partition: rows to drop, rows that the edges decide on, and the edges."""

    def batch_of(kind, h1, h2, doc, null, th, pos, n_docs):
        n = len(h1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, kind, np.int8)), pa.array(h1), pa.array(h2), pa.array(doc, mask=null),
                pa.array(th), pa.array(pos), pa.array(np.full(n, n_docs, np.int64)),
            ],
            ["kind", "h1", "h2", "id", "th", "pos", "n_docs"],
        )

    def run(batches):
        held = None  # rows of the key that is not over yet
        first_key = None  # the partition's first key, which may have begun in the partition before
        edge = {}  # key -> [documents so far, largest id, whether it is null, the last document]
        state = None  # of a key that has shown min_docs documents: (key, largest id, null)

        def split(cols):
            """The columns with the starts of their keys, documents per key and each row's rank of document."""
            nonlocal first_key
            h1, h2, doc, null, th, pos = cols
            new = np.empty(len(h1), bool)
            new[0] = True
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            starts = np.flatnonzero(new)
            if first_key is None:
                first_key = (h1[0], h2[0])
            new_doc = new.copy()
            new_doc[1:] |= (doc[1:] != doc[:-1]) | (null[1:] != null[:-1])
            group = np.cumsum(new) - 1
            docs = np.add.reduceat(new_doc.astype(np.int64), starts)
            # Rank of a row's document within its key: 0 for the one that keeps its lines.
            rank = np.cumsum(new_doc) - 1
            rank = rank - rank[starts][group]
            return h1, h2, doc, null, th, pos, starts, group, docs, rank

        def columns(batch):
            ids = batch.column("id")
            return [
                batch.column("h1").to_numpy(zero_copy_only=False), batch.column("h2").to_numpy(zero_copy_only=False),
                ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False),
                batch.column("th").to_numpy(zero_copy_only=False), batch.column("pos").to_numpy(zero_copy_only=False),
            ]

        def open_rows(cols, key):
            """Rows of the partition's first key: counted here, decided later."""
            h1, h2, doc, null, th, pos = cols
            new = np.empty(len(doc), bool)
            known = edge.get(key)
            new[0] = known is None or (doc[0], null[0]) != known[3]
            new[1:] = (doc[1:] != doc[:-1]) | (null[1:] != null[:-1])
            if known is None:
                known = edge[key] = [0, doc[0], null[0], None]
            known[0] += int(new.sum())
            known[3] = (doc[-1], null[-1])
            return batch_of(OPEN, h1, h2, doc, null, th, pos, 0)

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = columns(batch)
            if held is not None:
                cols = [np.concatenate(pair) for pair in zip(held, cols)]
            h1, h2, doc, null, th, pos, starts, group, docs, rank = split(cols)
            last = starts[-1]
            key_last = (h1[last], h2[last])
            begin = 0
            if first_key == (h1[0], h2[0]):
                begin = starts[1] if len(starts) > 1 else len(h1)
                yield open_rows([c[:begin] for c in cols], first_key)
                if begin == len(h1):
                    held = None
                    continue
            elif state is not None and state[0] == (h1[0], h2[0]):
                # The key has min_docs documents already: all that follows but its first document goes.
                begin = starts[1] if len(starts) > 1 else len(h1)
                gone = (doc[:begin] != state[1]) | (null[:begin] != state[2])
                part = [c[:begin][gone] for c in cols]
                if len(part[0]):
                    yield batch_of(DROP, *part, 0)
                if begin == len(h1):
                    held = None
                    continue
            state = None
            settled = (docs[group] >= min_docs) & (rank > 0)
            settled[:begin] = False
            if docs[-1] >= min_docs:
                state = (key_last, doc[last], null[last])
                held = None
            else:
                settled[last:] = False
                held = [c[last:] for c in cols]
            if settled.any():
                yield batch_of(DROP, *[c[settled] for c in cols], 0)
        if held is not None:
            h1, h2, doc, null, th, pos, starts, group, docs, rank = split(held)
            key = (h1[0], h2[0])
            edge[key] = [int(docs[0]), doc[0], null[0], None]
            rest = rank > 0
            if rest.any():
                yield batch_of(OPEN, *[c[rest] for c in held], 0)
        elif state is not None:
            edge[state[0]] = [min_docs, state[1], state[2], None]
        for (a, b), (n_docs, doc, null, _) in edge.items():
            yield batch_of(
                EDGE, np.array([a]), np.array([b]), np.array([doc]), np.array([null]), np.zeros(1, np.int64),
                np.zeros(1, np.int32), n_docs,
            )

    return run


def _pack(batches):
    """Positions to drop -> kept lines as a bitmap, compressed; bit i, most significant first, stands for line i."""
    for batch in slices(batches):
        keeps, dropped = [], []
        for n, positions in zip(batch.column("n_lines").to_pylist(), batch.column("gone").to_pylist()):
            bits = np.ones(n, bool)
            bits[positions] = False
            keeps.append(zlib.compress(np.packbits(bits).tobytes(), 1))
            dropped.append(len(positions))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"), batch.column("th"), batch.column("n_lines").cast(pa.int64()),
                pa.array(dropped, pa.int64()), pa.array(keeps, pa.binary()),
            ],
            ["id", "th", "n_lines", "n_dropped", "keep"],
        )


def unpack(keep: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """``id, th, n_lines, n_dropped, keep``: the kept lines of each document, without its text.

    ``th`` is Spark's xxhash64 of the text; ``keep`` is read by :func:`unpack`.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    lines = durable(rows.mapInArrow(_hash_lines(min_chars), LINES), "lines")
    hashed = lines.filter(F.col("h1").isNotNull()).select("id", "th", "h1", "h2", "pos")
    descending = F.col("id").desc_nulls_last()
    ordered = hashed.repartitionByRange(shuffle_partitions(docs), "h1", "h2", descending)
    ordered = ordered.sortWithinPartitions("h1", "h2", descending, "pos")
    found = durable(ordered.mapInArrow(_stream(min_docs), FOUND), "repeated-lines")
    edges = found.filter(F.col("kind") == EDGE).groupBy("h1", "h2").agg(
        F.sum("n_docs").alias("n"), F.max("id").alias("keeper")
    ).filter(F.col("n") >= min_docs)
    decided = (
        # Two rows a partition at most, so the table is as small as the list of partitions.
        found.filter(F.col("kind") == OPEN).join(F.broadcast(edges), ["h1", "h2"])
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
    )
    none = F.lit(None).cast("int")
    gone = found.filter(F.col("kind") == DROP).select("id", "th", "pos", none.alias("n_lines"))
    gone = gone.union(decided.select("id", "th", "pos", none))
    heads = lines.filter(F.col("h1").isNull()).select("id", "th", none.alias("pos"), "n_lines")
    marked = gone.union(heads).groupBy("id", "th").agg(
        F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("gone")
    )
    return marked.mapInArrow(_pack, "id bigint, th bigint, n_lines bigint, n_dropped bigint, keep binary")


def _kept(text: bytes | None, keep: bytes, n_lines: int, n_dropped: int) -> bytes:
    text = text or b""
    if not n_dropped:
        return text
    return b"\n".join(line for line, stay in zip(text.split(b"\n"), unpack(keep, n_lines)) if stay)


@F.arrow_udf(StringType())
def kept_text(text: pa.Array, keep: pa.Array, n_lines: pa.Array, n_dropped: pa.Array) -> pa.Array:
    """The text without its dropped lines; null becomes empty."""
    rows = zip(utf8(text), keep.to_pylist(), n_lines.to_pylist(), n_dropped.to_pylist())
    return pa.array([_kept(*row).decode() for row in rows], pa.string())


@F.arrow_udf(StringType())
def kept_digest(text: pa.Array, keep: pa.Array, n_lines: pa.Array, n_dropped: pa.Array) -> pa.Array:
    """SHA-256 of what :func:`kept_text` gives, without building a column of texts."""
    rows = zip(utf8(text), keep.to_pylist(), n_lines.to_pylist(), n_dropped.to_pylist())
    return pa.array([hashlib.sha256(_kept(*row)).hexdigest() for row in rows], pa.string())


def with_bitmaps(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct) beside its ``n_lines``, ``n_dropped`` and ``keep``."""
    maps = keep_bitmaps(docs, id_col=id_col, text_col=text_col, **options)
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("rid"), text_key(text_col).alias("rth")
    )
    same = F.col("rid").eqNullSafe(F.col("id")) & (F.col("rth") == F.col("th"))
    return rows.join(maps, same).select("row", "n_lines", "n_dropped", "keep")


def drop_repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text_col``; every row and every other column stays."""
    marked = with_bitmaps(docs, id_col=id_col, text_col=text_col, **options)
    kept = kept_text(F.col("row")[text_col], "keep", "n_lines", "n_dropped")
    return marked.select(*[
        kept.alias(name) if name == text_col else F.col("row")[name].alias(name) for name in docs.columns
    ])
