"""Exact top-k search by inner product, on segment statistics of several resolutions.

Components become integers, ``floor(scale * x)``. A vector is cut into segments, and of each the mean and the deviation
are kept. For two vectors a segment of length L adds at least ``L * ((m1 - m2)^2 + (s1 - s2)^2)`` to their squared
distance, so with the norms it adds at most ``L * (m1 * m2 + s1 * s2)`` to their inner product. A pair is asked at the
coarsest resolution first and goes on to the next finer one only while its bound reaches the query's k-th best score so
far; exact scores are worked out for what is left. Bounds change work, never results.

Candidates are packed into blocks of at most ``BLOCK`` vectors, queries into packs. Packs and blocks meet in the cells
of a grid: a cell is one pack and some blocks, of bounded size, so no task holds more whatever the table's size, and
any cell can be done again elsewhere. Each pack carries the k-th scores that its queries reach among themselves, which
every cell starts from. A cell hands on at most k rows a query.

Defined cases: vectors that are null or hold null or non-finite components take no part. A shorter vector is as if it
ended in zeros; an empty one scores 0 with all. Rows are told apart by where they lie, not by id: a row that shares the
query's id is a candidate like any other, and a query id that several rows have gets a result for each. A null id is no
query; as a candidate it comes after all others of its score. Equal scores go by id, ascending. Scaled components
beyond 2^46 count as 2^46, and a score beyond a long as the long's end. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstat.llm.common import durable, slices
from loomstat.llm.vectors import integer_rows, widen

# Vectors of a block, vectors that a cell has on average, queries of a pack on average.
BLOCK, CELL, PACK = 4096, 8192, 4096
# Segments of each resolution, coarse to fine.
LEVELS = (2, 8, 16)
# Queries asked together, pairs refined together, and the share of pairs below which they are refined one by one.
STRIP, PAIRS, FEW = 256, 1 << 17, 1 / 16
NO_ID = (1 << 63) - 1
PACKED = "ids array<bigint>, isquery binary, width int, kind string, x binary"
FOUND = "block bigint, pos int, query_id bigint, vec_id bigint, score bigint"


def _pack(matrix: np.ndarray) -> tuple[int, str, bytes]:
    most = int(np.abs(matrix).max(initial=0))
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return matrix.shape[1], kind, matrix.astype(kind).tobytes()


def _unpack(width: int, kind: str, x: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(x, kind).astype(np.int64).reshape(rows, width)


def _blocks(scale: float, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                keep, matrix = integer_rows(part.column(2), scale)
                if not len(keep):
                    continue
                width, kind, x = _pack(matrix)
                asked = pc.fill_null(part.column(1), False).to_numpy(zero_copy_only=False)[keep]
                ids = part.column(0).take(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([asked.astype(np.uint8).tobytes()], pa.binary()),
                     pa.array([width], pa.int32()), pa.array([kind]), pa.array([x], pa.binary())],
                    names=names,
                )

    return run


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each query of the blocks: where it lies, its id and its numbers."""
    for batch in slices(batches, 1):
        for row in batch.to_pylist():
            matrix = _unpack(row["width"], row["kind"], row["x"], len(row["ids"]))
            at = np.flatnonzero(np.frombuffer(row["isquery"], np.uint8))
            packed = [_pack(matrix[i:i + 1]) for i in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]] * len(at), pa.int64()), pa.array(at, pa.int32()),
                 pa.array([row["ids"][i] for i in at], pa.int64()), pa.array([p[0] for p in packed], pa.int32()),
                 pa.array([p[1] for p in packed], pa.string()), pa.array([p[2] for p in packed], pa.binary())],
                names=["block", "pos", "query_id", "width", "kind", "x"],
            )


class Vectors:
    """Integer vectors with their segment statistics, as rows whose inner products are the bounds."""

    def __init__(self, matrix: np.ndarray):
        self.whole = matrix
        self.most = int(np.abs(matrix).max(initial=0))
        self.real = matrix.astype(np.float64)
        self.norm = np.sqrt((self.real ** 2).sum(axis=1))
        self.levels = []
        width = matrix.shape[1]
        for segments in LEVELS:
            if segments >= width:
                break
            cuts = np.linspace(0, width, segments + 1).astype(int)
            sizes = np.diff(cuts)
            mean = np.add.reduceat(self.real, cuts[:-1], axis=1) / sizes
            square = np.add.reduceat(self.real ** 2, cuts[:-1], axis=1) / sizes
            # rounding must not make a deviation smaller than it is
            spread = np.sqrt(np.maximum(square - mean ** 2, 0) + 1e-12 * square)
            self.levels.append(np.hstack([mean, spread]) * np.sqrt(np.concatenate([sizes, sizes])))


def _doubles(left: Vectors, right: Vectors) -> bool:
    """Whether every inner product and every partial sum of one is a double without rounding."""
    return left.most * right.most * left.whole.shape[1] < 1 << 53


def _exact(left: Vectors, right: Vectors, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The integer inner products of pairs of rows, exact: doubles while they hold them, else longs, else any size."""
    if _doubles(left, right):
        return np.einsum("ij,ij->i", left.real[i], right.real[j]).astype(np.int64)
    if left.most * right.most * left.whole.shape[1] < 1 << 63:
        return np.einsum("ij,ij->i", left.whole[i], right.whole[j])
    whole = (left.whole[i].astype(object) * right.whole[j].astype(object)).sum(axis=1)
    return np.array([min(max(int(s), -NO_ID - 1), NO_ID) for s in whole], np.int64)


def _survivors(left: Vectors, right: Vectors, rows: np.ndarray, floor: np.ndarray):
    """Pairs of ``rows`` of ``left`` and rows of ``right`` whose scores reach ``floor`` of the row, with the scores.

    While many pairs are left, a level is asked of all of them at once, as one product of matrices; once few are, pair
    by pair. Both ask the same bounds.
    """
    least, levels = floor[rows][:, None], list(zip(left.levels, right.levels, strict=True))
    alive = np.ones((len(rows), len(right.norm)), bool)
    while levels and alive.sum() > FEW * alive.size:
        mine, other = levels.pop(0)
        bound = mine[rows] @ other.T
        bound += 1e-9 * np.outer(left.norm[rows], right.norm) + 1e-6
        alive &= bound >= least
    if alive.sum() > FEW * alive.size and _doubles(left, right):
        score = left.real[rows] @ right.real.T
        alive &= score >= least
        i, j = np.nonzero(alive)
        yield rows[i], j, score[i, j].astype(np.int64)
        return
    i, j = np.nonzero(alive)
    for start in range(0, len(i), PAIRS):
        a, b = rows[i[start:start + PAIRS]], j[start:start + PAIRS]
        for mine, other in levels:
            slack = 1e-9 * left.norm[a] * right.norm[b] + 1e-6
            good = np.einsum("ij,ij->i", mine[a], other[b]) + slack >= floor[a]
            a, b = a[good], b[good]
        score = _exact(left, right, a, b)
        good = score >= floor[a]
        yield a[good], b[good], score[good]


class Best:
    """The k best of each query so far: scores, then ids ascending."""

    def __init__(self, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        self.parts.append((row, ids, score))
        if sum(len(p[0]) for p in self.parts) > 4 * self.k * len(self.floor) + PAIRS:
            self.shrink()

    def shrink(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        row, ids, score = (np.concatenate(p) for p in zip(*self.parts, strict=True))
        order = np.lexsort((ids, ~score, row))  # ~ turns the order round and cannot overflow
        row, ids, score = row[order], ids[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        top, last = rank < self.k, rank == self.k - 1
        reached = score[last].astype(np.float64)
        reached -= np.where(np.abs(reached) >= 1 << 53, 1e-15 * np.abs(reached), 0)  # doubles may have rounded it up
        self.floor[row[last]] = np.maximum(self.floor[row[last]], reached)
        self.parts = [(row[top], ids[top], score[top])]
        return self.parts[0]


def _with_floors(k: int):
    """Queries of one pack as one row, with the k-th score each reaches among the others of the pack."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = [_unpack(r["width"], r["kind"], r["x"], 1) for r in rows]
        width = max(p.shape[1] for p in parts)
        matrix = np.vstack([widen(p, width) for p in parts])
        mine = Vectors(matrix)
        best = Best(k, np.full(len(rows), -np.inf))
        for start in range(0, len(rows), STRIP):
            strip = np.arange(start, min(start + STRIP, len(rows)))
            for a, b, score in _survivors(mine, mine, strip, best.floor):
                best.add(a[a != b], b[a != b], score[a != b])
            best.shrink()
        width, kind, x = _pack(matrix)
        return pa.table({
            "pack": pa.array([key[0].as_py()], pa.int64()),
            "at": pa.array([np.array([(r["block"], r["pos"]) for r in rows], "<i8").tobytes()], pa.binary()),
            "ids": pa.array([[r["query_id"] for r in rows]], pa.list_(pa.int64())),
            "floor": pa.array([best.floor.astype("<f8").tobytes()], pa.binary()),
            "width": pa.array([width], pa.int32()), "kind": [kind], "x": pa.array([x], pa.binary()),
        })

    return run


def _search(k: int):
    def run(packs: pa.Table, blocks: pa.Table) -> pa.Table:
        out = []
        for pack in packs.to_pylist():
            at = np.frombuffer(pack["at"], "<i8").reshape(-1, 2)
            numbers = _unpack(pack["width"], pack["kind"], pack["x"], len(at))
            best, left = Best(k, np.frombuffer(pack["floor"], "<f8").copy()), Vectors(numbers)
            for batch in blocks.to_batches(max_chunksize=1):
                block = batch.to_pylist()[0]
                theirs = _unpack(block["width"], block["kind"], block["x"], len(block["ids"]))
                width = max(numbers.shape[1], theirs.shape[1])
                if left.whole.shape[1] != width:
                    left = Vectors(widen(numbers, width))
                right = Vectors(widen(theirs, width))
                ids = np.array([NO_ID if i is None else i for i in block["ids"]], np.int64)
                for start in range(0, len(at), STRIP):
                    strip = np.arange(start, min(start + STRIP, len(at)))
                    for a, b, score in _survivors(left, right, strip, best.floor):
                        other = (at[a, 0] != block["block"]) | (at[a, 1] != b)
                        best.add(a[other], ids[b[other]], score[other])
                best.shrink()
            row, ids, score = best.shrink()
            out.append(pa.table({
                "block": pa.array(at[row, 0], pa.int64()), "pos": pa.array(at[row, 1], pa.int32()),
                "query_id": pa.array([pack["ids"][i] for i in row], pa.int64()),
                "vec_id": pa.array(ids, pa.int64(), mask=ids == NO_ID), "score": pa.array(score, pa.int64()),
            }))
        return pa.concat_tables(out) if out else pa.schema(
            [("block", pa.int64()), ("pos", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
        ).empty_table()

    return run


def top_k(
    vectors: DataFrame, asked: Column, *, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding",
    cell: int = CELL, pack: int = PACK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``asked`` holds for, the k rows of largest inner product."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), asked.alias("asked"), F.col(vector_col).alias("v"))
    names = [f.split()[0] for f in PACKED.split(", ")]
    blocks = durable(
        rows.mapInArrow(_blocks(scale, names), PACKED).withColumn("block", F.monotonically_increasing_id()), "vector-blocks"
    )
    single = durable(
        blocks.mapInArrow(_queries, "block bigint, pos int, query_id bigint, width int, kind string, x binary"), "queries"
    )
    total = blocks.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    packs, groups = max(1, math.ceil(single.count() / pack)), max(1, math.ceil(total / cell))
    packed = single.groupBy(F.pmod(F.xxhash64("block", "pos"), F.lit(packs)).alias("pack")).applyInArrow(
        _with_floors(k), "pack bigint, at binary, ids array<bigint>, floor binary, width int, kind string, x binary"
    )
    left = durable(packed, "query-packs").withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = blocks.withColumn("grp", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")).withColumn(
        "pack", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(packs - 1).cast("bigint")))
    ).drop("isquery")
    found = left.groupBy("pack", "grp").cogroup(right.groupBy("pack", "grp")).applyInArrow(_search(k), FOUND)
    order = Window.partitionBy("block", "pos").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
