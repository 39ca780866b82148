"""Benchmark decontamination with suffix arrays over the training text.

A task gathers whole documents into shards of bounded size, numbers their words and sorts the suffixes of each shard
by prefix doubling. Words that no benchmark text has get number 0, which ends every comparison, as a match never
reaches across one; documents are kept apart the same way. All suffixes of all benchmark texts are then looked up
together: word by word two binary searches narrow the range of training suffixes that share the prefix, until it is
empty. That gives each test suffix its longest verbatim match and the places of it; the range at the length of a
window gives the documents and words that are hit.

Words are the runs of letters, digits and non-ASCII signs, A-Z in lower case. The benchmark goes to the tasks in
blocks of a fixed number of words; more blocks mean more passes over the documents, each of them complete.

Defined cases: null or empty texts have no words; a benchmark text without words finds nothing; one with fewer words
than a window is a window itself. Equal benchmark texts all count, by their own ids; rows of documents are treated one
by one, whatever their ids.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.llm.common import FOLD, durable, slices, utf8

WINDOW = 10
# Words of one shard, and benchmark words of one pass: some 40 MB and 30 MB in a task.
SHARD_WORDS = 1 << 20
BLOCK_WORDS = 1 << 18
# 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F are no part of a word, once A-Z are folded.
WORDS = bytes(
    b if b >= 128 or b in range(0x30, 0x3A) or b in range(0x61, 0x7B) else 32 for b in FOLD
)
RESULT = "n_words bigint, n_hit bigint, items array<string>, hits array<struct<start:int,stop:int>>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORDS).split() if text else []


@dataclass
class Block:
    """Benchmark texts as numbers: ``words`` one after another with 0 behind each text."""

    vocabulary: dict[bytes, int]
    words: np.ndarray
    names: list[str]
    starts: np.ndarray  # of the suffixes searched, all but those that begin with the closing 0
    lengths: np.ndarray  # words from there to the end of the text
    items: np.ndarray  # index into names
    windows: np.ndarray  # words that must match, 0 where no window begins

    @classmethod
    def of(cls, texts: list[tuple[str, list[bytes]]], window: int) -> "Block":
        vocabulary: dict[bytes, int] = {}
        numbers, starts, lengths, items, windows = [], [], [], [], []
        for item, (_, words) in enumerate(texts):
            n = len(words)
            for i in range(n):
                starts.append(len(numbers) + i)
                lengths.append(n - i)
                items.append(item)
                windows.append(window if n - i >= window else n if i == 0 else 0)
            numbers += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
            numbers.append(0)
        as_array = lambda values: np.array(values, np.int64)
        return cls(
            vocabulary, np.array(numbers, np.int32), [name for name, _ in texts], as_array(starts),
            as_array(lengths), as_array(items), as_array(windows),
        )


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes whose first word is not 0, in order of their first ``depth`` words at least.

    Prefix doubling: the ranks of two neighbouring stretches of h words sort by 2h words, and only suffixes that are
    still level with another one are sorted again. A 0 ends a suffix: what follows it has no influence.
    """
    starts = np.flatnonzero(words)
    first = words[starts].astype(np.int64)
    order = starts[np.argsort(first)]
    slots = np.arange(len(order))  # of ``order``, where suffixes may still change places
    level = np.sort(first)
    zeros = np.concatenate([[0], np.cumsum(words == 0)])
    rank = np.zeros(len(words) + 1, np.int64)
    reach = 1
    while len(slots):
        new = np.empty(len(level), bool)
        new[0] = True
        new[1:] = level[1:] != level[:-1]
        heads = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        # The rank of a group is the slot it begins at, which stays true whatever is sorted inside it.
        rank[order[slots]] = slots[heads][group] + 1
        if reach >= depth:
            break
        tied = np.diff(np.append(heads, len(new)))[group] > 1
        slots = slots[tied]
        suffixes = order[slots]
        stop = np.minimum(suffixes + reach, len(words))
        going = zeros[stop] == zeros[suffixes]
        slots, suffixes = slots[going], suffixes[going]
        level = (rank[suffixes] << 32) | rank[np.minimum(suffixes + reach, len(words))]
        by_level = np.argsort(level)
        order[slots] = suffixes[by_level]
        level = level[by_level]
        reach *= 2
    return order


def search(words: np.ndarray, order: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every test suffix ``longest`` match, a place of it, and the range of ``order`` that matches its window."""
    m = len(block.starts)
    longest, place = np.zeros(m, np.int64), np.full(m, -1, np.int64)
    first, last = np.zeros(m, np.int64), np.zeros(m, np.int64)
    active = np.arange(m)
    low, high = np.zeros(m, np.int64), np.full(m, len(order), np.int64)
    depth = 0
    while len(active):
        wanted = block.words[block.starts[active] + depth]
        low = _bound(words, order, depth, low, high, wanted, False)
        high = _bound(words, order, depth, low, high, wanted, True)
        depth += 1
        alive = low < high
        active, low, high = active[alive], low[alive], high[alive]
        longest[active], place[active] = depth, order[low]
        at_window = block.windows[active] == depth
        first[active[at_window]], last[active[at_window]] = low[at_window], high[at_window]
        going = block.lengths[active] > depth
        active, low, high = active[going], low[going], high[going]
    return longest, place, first, last


def _bound(words, order, depth, low, high, wanted, upper: bool) -> np.ndarray:
    """Binary search in each range for the first suffix whose word at ``depth`` is not below ``wanted`` (or above)."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        at = np.minimum(order[np.where(open_, middle, 0)] + depth, len(words) - 1)
        found = words[at]
        right = open_ & ((found <= wanted) if upper else (found < wanted))
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of all ranges, with the index of the range each belongs to."""
    sizes = last - first
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes), owner


def _shard(texts: list[list[int]], block: Block):
    """Per document: words hit as (start, stop) ranges and the benchmark texts that hit them."""
    sizes = np.array([len(t) for t in texts], np.int64)
    heads = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.zeros(int(heads[-1]), np.int32)
    for numbers, head in zip(texts, heads):
        words[head:head + len(numbers)] = numbers
    depth = int(block.lengths.max()) if len(block.lengths) else 1
    order = suffix_array(words, depth)
    longest, place, first, last = search(words, order, block)
    found, owner = _expand(first, last)
    at = order[found] if len(order) else found
    document = np.searchsorted(heads, at, side="right") - 1
    begun, ended = (np.bincount(x, minlength=len(words) + 1) for x in (at, at + block.windows[owner]))
    covered = np.cumsum(begun - ended)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    starts, stops = edges[::2], edges[1::2]
    of_range = np.searchsorted(heads, starts, side="right") - 1
    items: list[set] = [set() for _ in texts]
    if len(document):
        pairs = np.unique(document * len(block.names) + block.items[owner])
        for pair in pairs.tolist():
            items[pair // len(block.names)].add(block.names[pair % len(block.names)])
    hits: list[list] = [[] for _ in texts]
    for doc, start, stop in zip(of_range.tolist(), starts.tolist(), stops.tolist()):
        hits[doc].append((start - int(heads[doc]), stop - int(heads[doc])))
    return hits, items, (longest, place, heads)


def _shards(batches, text_col: str, block: Block, shard_words: int):
    """``(columns carried, words as numbers)`` of whole documents, some ``shard_words`` words at a time."""
    carried, texts, size = [], [], 0
    lookup = block.vocabulary.get
    for batch in slices(batches):
        row = batch.column("row")
        text = batch.column("text") if "text" in batch.schema.names else row.field(text_col)
        for content in utf8(text):
            numbers = np.array([lookup(w, 0) for w in words_of(content)], np.int32)
            texts.append(numbers)
            size += len(numbers)
        carried.append(row)
        if size >= shard_words:
            yield pa.concat_arrays(carried), texts
            carried, texts, size = [], [], 0
    if texts:
        yield pa.concat_arrays(carried), texts


def _scan(text_col: str, block: Block, shard_words: int):
    entry = pa.struct([("start", pa.int32()), ("stop", pa.int32())])

    def run(batches):
        for row, texts in _shards(batches, text_col, block, shard_words):
            hits, items, _ = _shard(texts, block)
            yield pa.RecordBatch.from_arrays(
                [
                    row,
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([sum(b - a for a, b in h) for h in hits], pa.int64()),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                    pa.array([[{"start": a, "stop": b} for a, b in h] for h in hits], pa.list_(entry)),
                ],
                ["row", "n_words", "n_hit", "items", "hits"],
            )

    return run


def _scan_longest(text_col: str, block: Block, shard_words: int):
    offsets = block.starts - block.starts[np.searchsorted(block.items, block.items)] if len(block.items) else block.starts

    def run(batches):
        for row, texts in _shards(batches, text_col, block, shard_words):
            _, _, (longest, place, heads) = _shard(texts, block)
            found = np.flatnonzero(longest)
            document = np.searchsorted(heads, place[found], side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block.names[i] for i in block.items[found].tolist()], pa.string()),
                    pa.array(offsets[found]), pa.array(longest[found]), row.field(0).take(pa.array(document)),
                    pa.array(place[found] - heads[document]),
                ],
                ["item", "item_word", "n_words", "id", "word"],
            )

    return run


def blocks(benchmark: DataFrame, *, item_col: str, text_col: str, window: int, block_words: int):
    """The benchmark in blocks of ``block_words`` words (or one text), drawn partition by partition."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    part: list[tuple[str, list[bytes]]] = []
    size = 0
    for row in rows.toLocalIterator():
        words = words_of(row.text.encode() if row.text is not None else None)
        if not words:
            continue
        part.append((row.item or "", words))
        size += len(words)
        if size >= block_words:
            yield Block.of(part, window)
            part, size = [], 0
    if part:
        yield Block.of(part, window)


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, *, carry: list[str] | None = None, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``row`` (the columns of ``docs`` in ``carry``, else all, as a struct), ``n_words``, ``n_hit``, the benchmark
    ``items`` found and ``hits``, the ranges of words that they cover."""
    carry = docs.columns if carry is None else carry
    found = blocks(benchmark, item_col=item_col, text_col=item_text_col, window=window, block_words=block_words)
    block, following = next(found, Block.of([], window)), next(found, None)
    if following is None:
        rows = docs.select(F.struct(*carry).alias("row"), *([] if text_col in carry else [F.col(text_col).alias("text")]))
        schema = f"row {rows.schema['row'].dataType.simpleString()}, {RESULT}"
        return rows.mapInArrow(_scan(text_col, block, shard_words), schema)
    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"))
    rows = rows.select(F.struct("doc").alias("row"), "text")
    first = True
    while block is not None:
        schema = f"row {rows.schema['row'].dataType.simpleString()}, {RESULT}"
        scanned = rows.mapInArrow(_scan(text_col, block, shard_words), schema)
        merged = scanned if first else scanned.select("row", "n_words", _union("row.before").alias("u")).select(
            "row", "n_words", "u.*")
        # Each pass is written, so a lost executor repeats one pass, and the driver holds one block at a time.
        result = durable(merged.select(F.col("row.doc").alias("doc"), "n_words", "n_hit", "items", "hits"), "benchmark")
        rows = result.select(
            F.struct("doc", F.struct("n_hit", "items", "hits").alias("before")).alias("row"),
            F.col(f"doc.{text_col}").alias("text"),
        )
        block, following, first = following, next(found, None), False
    carried = F.struct(*[F.col(f"doc.{c}") for c in carry]).alias("row")
    return result.select(carried, "n_words", "n_hit", "items", "hits")


def _union(before: str):
    """Hits and items of two blocks as one: ranges that touch are joined."""
    hits = F.array_sort(F.concat(F.col(f"{before}.hits"), "hits"))
    empty = F.array().cast("array<struct<start:int,stop:int>>")

    def add(done, hit):
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], hit["stop"]).alias("stop"))
        return F.when(F.size(done) == 0, F.array(hit)).when(
            last["stop"] >= hit["start"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        ).otherwise(F.concat(done, F.array(hit)))

    merged = F.aggregate(hits, empty, add)
    total = F.aggregate(merged, F.lit(0).cast("bigint"), lambda n, h: n + h["stop"] - h["start"])
    items = F.array_sort(F.array_union(F.col(f"{before}.items"), "items"))
    return F.struct(total.alias("n_hit"), items.alias("items"), merged.alias("hits"))


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The longest verbatim match of every benchmark suffix: ``item, item_word, n_words`` and, as one place of it,
    document ``id`` and ``word``. Suffixes whose first word occurs nowhere have no row."""
    rows = docs.select(F.struct(id_col).alias("row"), F.col(text_col).alias("text"))
    schema = f"item string, item_word bigint, n_words bigint, id {docs.schema[id_col].dataType.simpleString()}, word bigint"
    result = None
    for block in blocks(benchmark, item_col=item_col, text_col=item_text_col, window=1, block_words=block_words):
        found = rows.mapInArrow(_scan_longest(text_col, block, shard_words), schema)
        result = found if result is None else result.union(found)
    if result is None:
        return docs.sparkSession.createDataFrame([], schema)
    best = F.max_by(F.struct("n_words", "id", "word"), F.struct("n_words", "id", "word")).alias("b")
    return result.groupBy("item", "item_word").agg(best).select("item", "item_word", "b.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    return find_benchmark(docs, benchmark, **options).filter(F.col("n_hit") == 0).select("row.*")
