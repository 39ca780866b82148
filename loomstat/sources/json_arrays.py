"""Top-level JSON arrays of any layout, read by as many tasks as their files have splits.

Files are read as text that ends at every ``}``, which a file of records has often enough whatever its line breaks, so
Spark splits them like any text. Where a split begins nobody knows at first whether that is inside a string or how
deep. So a first pass works out for each split what it does to both: whether it ends inside a string, the change of
depth and the least depth behind a ``}``, for either state at its start. One row per split goes to the driver, which
combines them in order. A second pass then cuts each split's text where the depth returns to the array's own. A record
that reaches across splits arrives in fragments, which are put together by the split that it begins in.

An escape never crosses a split: splits begin behind a ``}``, and no escape ends with one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE, ESCAPE, CLOSE = b'"\\}'
SEPARATOR = b"}"
STEP = np.zeros(256, np.int64)
STEP[list(b"{[")], STEP[list(b"}]")] = 1, -1
NOTABLE = (STEP != 0) | (np.arange(256) == QUOTE)
# What may stand before a file's first record, before each other one, behind the last, and in an array without any.
FIRST, NEXT = re.compile(rb"(?:\xef\xbb\xbf)?\s*\[\s*(?=\{)"), re.compile(rb"\s*,\s*(?=\{)")
REST, EMPTY = re.compile(rb"\s*\]\s*"), re.compile(rb"(?:\xef\xbb\xbf)?\s*\[\s*\]\s*")
# More than any depth: no bracket closed yet.
NEVER = 1 << 40
OUT_ROWS = 1024
SUMMARY = "file string, start bigint, " + ", ".join(
    f"inside{i} boolean, change{i} bigint, least{i} bigint, before{i} bigint" for i in (0, 1)
)
CUT = "file string, owner bigint, at bigint, record binary"


class MalformedArray(ValueError):
    """A file is not one JSON array of objects."""


def _brackets(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and kinds of quotes and brackets, and whether each ends up inside a string if the text begins outside."""
    codes = np.frombuffer(text, np.uint8)
    places = np.flatnonzero(NOTABLE[codes])
    kinds = codes[places]
    quote = kinds == QUOTE
    slashes = np.flatnonzero(codes == ESCAPE)
    if len(slashes):
        begins = np.flatnonzero(np.diff(slashes, prepend=-2) > 1)
        ends = np.append(begins[1:], len(slashes)) - 1
        quote &= ~np.isin(places, slashes[ends[(ends - begins) % 2 == 0]] + 1)  # behind an odd run of backslashes
    return places, kinds, np.cumsum(quote) % 2 == 1


def _depths(places: np.ndarray, kinds: np.ndarray, within: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of brackets outside strings the places, whether each is a ``}``, and the depth behind each from the start."""
    outside = ~within & (kinds != QUOTE)
    return places[outside], kinds[outside] == CLOSE, np.cumsum(STEP[kinds[outside]])


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[bytes]]]:
    """Pieces of text in order, with the split that they are of."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        file, start = batch.column(0), batch.column(1)
        new = pc.or_(pc.not_equal(file.slice(1), file.slice(0, n - 1)), pc.not_equal(start.slice(1), start.slice(0, n - 1)))
        cuts = [0, *(np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1).tolist(), n]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield (file[begin].as_py(), start[begin].as_py()), batch.column(2).slice(begin, end - begin).to_pylist()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per split; ``least`` counts all of its ``}``, ``before`` all but the one behind its last piece."""
    seen: dict[tuple[str, int], list[dict]] = {}
    for split, pieces in _stretches(batches):
        text = SEPARATOR.join(pieces) + SEPARATOR
        places, kinds, within = _brackets(text)
        flips = bool(within[-1]) if len(within) else False
        for state in seen.setdefault(split, [{"inside": bool(i), "change": 0, "least": NEVER, "before": NEVER} for i in (0, 1)]):
            where, close, depth = _depths(places, kinds, within ^ state["inside"])
            behind = depth[close] + state["change"]
            last = len(behind) and where[-1] == len(text) - 1
            state["before"] = int(min(state["least"], behind[:len(behind) - bool(last)].min(initial=NEVER)))
            state["least"] = int(min(state["least"], behind.min(initial=NEVER)))
            state["change"] += int(depth[-1]) if len(depth) else 0
            state["inside"] ^= flips
    if seen:
        rows = [
            {"file": file, "start": start, **{f"{name}{i}": state[name] for i, state in enumerate(states) for name in state}}
            for (file, start), states in seen.items()
        ]
        kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
        fields = [(f"{name}{i}", kind) for i in (0, 1) for name, kind in zip(("inside", "change", "least", "before"), kinds, strict=True)]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("file", pa.string()), ("start", pa.int64()), *fields]))


@dataclass(frozen=True)
class Split:
    """How a split begins: inside a string or not, how deep, and which split the record open there begins in."""

    inside: bool
    depth: int
    owner: int
    first: bool
    last: bool


@dataclass(frozen=True)
class Edges:
    """Owners of the fragments that a file's opening bracket is in, and its closing one; None where no fragment has it."""

    opening: int | None
    closing: int | None


def combine(summaries: Iterable) -> tuple[dict[tuple[str, int], Split], dict[str, Edges]]:
    """The beginning of every split, from the summaries of all."""
    files: dict[str, list] = {}
    for row in summaries:
        files.setdefault(row["file"], []).append(row)
    splits, edges = {}, {}
    for file, rows in files.items():
        rows.sort(key=lambda r: r["start"])
        inside, depth, owner, opening = False, 0, rows[0]["start"], None
        for i, row in enumerate(rows):
            first, last, state = i == 0, i == len(rows) - 1, int(inside)
            splits[file, row["start"]] = Split(inside, depth, owner, first, last)
            least = depth + row[f"before{state}" if last else f"least{state}"]
            if least < 1:
                raise MalformedArray(f"{file}: a malformed array, its brackets close too early")
            cut = least == 1
            if first and not cut:
                opening = owner
            if cut:
                owner = row["start"]
            inside, depth = row[f"inside{state}"], depth + row[f"change{state}"]
        if inside or depth != -1:  # there is no bracket behind the last piece
            raise MalformedArray(f"{file}: a malformed array, it is still open where the file ends")
        edges[file] = Edges(opening if len(rows) > 1 else None, owner if len(rows) > 1 and not cut else None)
    return splits, edges


def _body(file: str, text: bytes, first: bool) -> bytes:
    found = (FIRST if first else NEXT).match(text)
    if not found:
        raise MalformedArray(f"{file}: a malformed array, no record begins at {text[:40]!r}")
    return text[found.end():]


def _end(file: str, text: bytes, empty: bool) -> None:
    if not (EMPTY if empty else REST).fullmatch(text):
        raise MalformedArray(f"{file}: a malformed array, it does not end with {text[-40:]!r}")


def _cut(splits: dict[tuple[str, int], Split], whole: bool):
    """Records that a split holds from end to end, or else the fragments of the others."""

    def of_split(key: tuple[str, int], stretches: Iterator[list[bytes]]) -> Iterator[tuple[str, int, int, bytes]]:
        file, start = key
        if key not in splits:
            raise RuntimeError(f"{file} has other splits than when it was read first; was it changed?")
        split = splits[key]
        inside, depth, cut, held, kept = split.inside, split.depth, False, [], None

        def texts() -> Iterator[bytes]:
            """The split's text; of a file's last split the last piece, which has no bracket behind it, is kept back."""
            nonlocal kept
            for pieces in stretches:
                if kept is not None:
                    pieces = [kept, *pieces]
                kept = pieces.pop()
                if pieces:
                    yield SEPARATOR.join(pieces) + SEPARATOR
            if not split.last:
                yield kept + SEPARATOR
                kept = b""

        for text in texts():
            places, kinds, within = _brackets(text)
            where, close, depths = _depths(places, kinds, within ^ inside)
            begin = 0
            for end in (where[close & (depth + depths == 1)] + 1).tolist():
                record = b"".join([*held, text[begin:end]])
                if cut or split.first:
                    if whole:
                        yield file, start, start, _body(file, record, not cut)
                elif not whole:
                    yield file, split.owner, start, record
                held, begin, cut = [], end, True
            held.append(text[begin:])
            inside ^= bool(within[-1]) if len(within) else False
            depth += int(depths[-1]) if len(depths) else 0
        rest = b"".join([*held, kept])
        mine = cut or split.first
        if split.last and mine:
            _end(file, rest, not cut)
        elif not whole:
            yield file, start if mine else split.owner, start, rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        stream = _stretches(batches)
        ahead = next(stream, None)

        def of_key(key: tuple[str, int]) -> Iterator[list[bytes]]:
            nonlocal ahead
            while ahead is not None and ahead[0] == key:
                pieces, ahead = ahead[1], next(stream, None)
                yield pieces

        while ahead is not None:
            for row in of_split(ahead[0], of_key(ahead[0])):
                rows.append(row)
                if len(rows) >= OUT_ROWS:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple[str, int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["file", "owner", "at", "record"])


def _joined(edges: dict[str, Edges]):
    """One record from its fragments, or nothing where they are the end of an array."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        file, owner = (k.as_py() for k in key)
        text = b"".join(table.sort_by("at").column("record").to_pylist())
        edge, out = edges[file], []
        if owner == edge.closing:
            _end(file, text, owner == edge.opening)
        else:
            out.append(_body(file, text, owner == edge.opening))
        return pa.table({"record": pa.array(out, pa.binary())})

    return run


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the JSON text of each record of the arrays at ``path``, one array per file.

    A file that is not an array of objects stops the job; what is inside a record is left to whoever parses it.
    Compressed files cannot be split and are a task each.
    """
    text = spark.read.option("lineSep", SEPARATOR.decode()).text(path)
    pieces = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("value"),
    )
    splits, edges = combine(pieces.mapInArrow(_summaries, SUMMARY).collect())
    records = pieces.mapInArrow(_cut(splits, True), CUT).select("record")
    if len(splits) > len(edges):
        parts = pieces.mapInArrow(_cut(splits, False), CUT)
        records = records.unionByName(parts.groupBy("file", "owner").applyInArrow(_joined(edges), "record binary"))
    return records.select(F.col("record").cast("string").alias("record"))
