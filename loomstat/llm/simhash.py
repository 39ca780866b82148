"""SimHash near-duplicates: fingerprints within a few bits of each other, found by the general pigeonhole principle.

The 64 bits are grouped so that correlated bits share a part, and the parts get unequal thresholds that sum to
``distance - parts + 1``: two fingerprints within ``distance`` bits then agree, in at least one part, up to that part's
threshold. Number of parts and thresholds come from a dynamic program over candidate counts estimated on a bounded
sample of fingerprints; whatever it chooses, the links found are the same. Each distinct fingerprint is indexed by
its value in each part and probes the values within the threshold; what meets is compared over all 64 bits.

A bucket hands on a spanning forest of its links, not all pairs, so a group of copies costs rows in proportion to its
size. A bucket beyond ``block`` rows is cut into blocks, and each pair of blocks is a task's work of its own. Equal
fingerprints are one entry from the start.

Defined cases: null and empty texts have fingerprint 0. A null id is never the smallest of a group unless all are
null. Rows that share an id are rows of their own. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from loomstat.graph.components import connected_components
from loomstat.graph.model import PropertyGraph
from loomstat.llm.common import durable, fold, slices, text_key, utf8

BITS = 64
# Fingerprints on which correlations and candidate counts are estimated.
SAMPLE = 4096
# What a probe row (shuffled and sorted) and a compared candidate cost, in microseconds.
PROBE_COST, COMPARE_COST = 1.0, 0.005
# Rows of one bucket that one task compares.
BLOCK = 8192
# Buckets up to this size are compared many at a time.
SMALL = 32


def _fingerprint(text: bytes | None, shingle: int) -> int:
    words = fold(text).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate([[0], ends[:-shingle] + 1]).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[i:j], 42) for i, j in zip(begins, ends[shingle - 1:].tolist())], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start:start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprint(text: Column | str, shingle: int) -> Column:
    """The fingerprint as a signed 64-bit number."""

    @F.arrow_udf(LongType())
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices([pa.RecordBatch.from_arrays([texts], ["text"])]):
            out += [_fingerprint(t, shingle) for t in utf8(part.column("text"))]
        return pa.array(out, pa.int64())

    return run(text)


@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int  # -1: the part is not used

    def value(self, prints: np.ndarray) -> np.ndarray:
        """The bits of this part, packed."""
        out = np.zeros(len(prints), np.int64)
        wide = prints.view(np.uint64)
        for place, bit in enumerate(self.bits):
            out |= ((wide >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
        return out

    def masks(self) -> list[int]:
        """What to flip to reach every other value within the threshold."""
        return [
            sum(1 << place for place in places)
            for flips in range(1, self.threshold + 1)
            for places in combinations(range(len(self.bits)), flips)
        ]


def group_bits(sample: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Bits in ``parts`` groups of nearly equal size, each grown by the free bit most correlated with it."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
    spread = bits - bits.mean(axis=0) if len(bits) else np.zeros((1, BITS))
    scale = np.sqrt((spread**2).sum(axis=0))
    scale[scale == 0] = 1.0
    near = np.abs((spread / scale).T @ (spread / scale))
    np.fill_diagonal(near, 0.0)
    free, out = set(range(BITS)), []
    for size in (BITS * (i + 1) // parts - BITS * i // parts for i in range(parts)):
        rest = sorted(free)
        seed = rest[int(near[np.ix_(rest, rest)].sum(axis=1).argmax())]
        group = [seed]
        free.discard(seed)
        while len(group) < size:
            rest = sorted(free)
            best = rest[int(near[np.ix_(rest, group)].mean(axis=1).argmax())]
            group.append(best)
            free.discard(best)
        out.append(tuple(sorted(group)))
    return out


def plan(sample: np.ndarray, total: int, distance: int) -> list[Part]:
    """Parts and thresholds with the least estimated cost for ``total`` distinct fingerprints."""
    best: tuple[float, list[Part]] = (np.inf, [])
    for parts in range(2, min(distance + 2, 8) + 1):
        groups = group_bits(sample, parts)
        costs = [_costs(sample, group, total, distance) for group in groups]
        # least[s]: cost of the groups so far with thresholds that sum to s - (groups so far), -1 counting as 0.
        least: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for cost in costs:
            following: dict[int, tuple[float, tuple[int, ...]]] = {}
            for used, (so_far, chosen) in least.items():
                for threshold in range(-1, len(cost) - 1):
                    entry = (so_far + cost[threshold + 1], (*chosen, threshold))
                    key = used + threshold + 1
                    if key not in following or entry < following[key]:
                        following[key] = entry
            least = following
        # Thresholds t sum to distance - parts + 1, so the shares t + 1 sum to distance + 1.
        if distance + 1 in least and least[distance + 1][0] < best[0]:
            cost, chosen = least[distance + 1]
            best = (cost, [Part(g, t) for g, t in zip(groups, chosen) if t >= 0])
    return best[1]


def _costs(sample: np.ndarray, group: tuple[int, ...], total: int, most: int) -> list[float]:
    """Estimated cost of a group for thresholds -1, 0, 1, ... as long as probes stay below 10,000."""
    mask = np.uint64(sum(1 << b for b in group))
    wide = sample.view(np.uint64) & mask
    counts = np.zeros(BITS + 1, np.int64)
    for i in range(0, len(wide), 256):
        apart = np.bitwise_count(wide[i:i + 256, None] ^ wide[None, :])
        counts += np.bincount(apart.ravel(), minlength=BITS + 1)
    counts[0] -= len(wide)
    pairs = max(1, len(wide) * (len(wide) - 1))
    out, probes, candidates, ways = [0.0], 1.0, 0.0, 1.0
    for threshold in range(most + 1):
        if threshold:
            ways = ways * (len(group) - threshold + 1) / threshold
            probes += ways / 2
            if probes > 10_000:
                break
        # A value never seen in the sample is still met by chance.
        candidates += max(counts[threshold] / pairs, ways / 2.0 ** len(group)) * total / 2
        out.append(total * (probes * PROBE_COST + candidates * COMPARE_COST))
    return out


SIGNATURES = "part int, value bigint, fp bigint, probe boolean"


def _signatures(parts: list[Part]):
    """Index and probe rows; of two values in reach of each other only the larger one probes."""

    def run(batches):
        for batch in batches:
            prints = batch.column("fp").to_numpy(zero_copy_only=False)
            for number, part in enumerate(parts):
                values = part.value(prints)
                for mask in [0, *part.masks()]:
                    flipped = values ^ mask
                    own = flipped < values if mask else np.ones(len(values), bool)
                    n = int(own.sum())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, number, np.int32)), pa.array(flipped[own]), pa.array(prints[own]),
                            pa.array(np.full(n, bool(mask))),
                        ],
                        ["part", "value", "fp", "probe"],
                    )

    return run


def _compare(distance: int, small: int = SMALL):
    """Rows sorted by bucket -> links (src, dst) that join what the bucket joins.

    A bucket is (part, value, cell_a, cell_b); ``side`` says of which block a row is. In a cell of one block all its
    indexed rows are compared with each other and with its probes; in a cell of two blocks only across.
    """

    def forest(prints, probe, side, two):
        links = []
        label = np.arange(len(prints))
        for i in range(len(prints) - 1):
            near = np.bitwise_count(prints[i + 1:] ^ prints[i]) <= distance
            near &= label[i + 1:] != label[i]
            near &= ~(probe[i + 1:] & probe[i])
            if two:
                near &= side[i + 1:] != side[i]
            found = np.flatnonzero(near) + i + 1
            if len(found):
                others, first = np.unique(label[found], return_index=True)
                links += [(prints[i], prints[j]) for j in found[first]]
                label[np.isin(label, others)] = label[i]
        return links

    def run(batches):
        held = None
        for batch in _closed(batches):
            if batch is not None:
                cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "value", "a", "b", "fp", "probe", "side")]
                if held is not None:
                    cols = [np.concatenate(pair) for pair in zip(held, cols)]
            else:
                if held is None:
                    return
                cols = held
            part, value, a, b, prints, probe, side = cols
            new = np.empty(len(part), bool)
            new[0] = True
            new[1:] = (part[1:] != part[:-1]) | (value[1:] != value[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            starts = np.append(np.flatnonzero(new), len(part))
            if batch is not None:
                # The last bucket may go on in the next batch.
                held = [c[starts[-2]:] for c in cols]
                starts = starts[:-1]
            wide = prints.view(np.uint64)
            sizes = np.diff(starts)
            src, dst = [], []
            few = np.flatnonzero((sizes > 1) & (sizes <= small))
            for size in np.unique(sizes[few]):
                at = starts[few[sizes[few] == size]]
                for chunk in range(0, len(at), 1 << 12):
                    rows = at[chunk:chunk + (1 << 12), None]
                    i, j = np.triu_indices(size, 1)
                    left, right = (rows + i).ravel(), (rows + j).ravel()
                    near = np.bitwise_count(wide[left] ^ wide[right]) <= distance
                    near &= ~(probe[left] & probe[right]) & ((a[left] == b[left]) | (side[left] != side[right]))
                    src.append(prints[left[near]])
                    dst.append(prints[right[near]])
            for k in np.flatnonzero(sizes > small):
                rows = slice(starts[k], starts[k + 1])
                links = forest(wide[rows], probe[rows], side[rows], a[starts[k]] != b[starts[k]])
                pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
                src.append(pairs[:, 0])
                dst.append(pairs[:, 1])
            if src:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(src)), pa.array(np.concatenate(dst))], ["src", "dst"]
                )

    return run


def _closed(batches):
    """The batches that have rows, then None."""
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def _cells(signatures: DataFrame, block: int) -> DataFrame:
    """Signatures with the cells of their bucket: one, or a row and a column of cells for a bucket beyond ``block``."""
    heavy = signatures.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    # Written first, so that its size is known when the join is planned: a bucket in thousands is heavy, if any.
    heavy = durable(heavy.select("part", "value", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "heavy")
    side = F.pmod(F.xxhash64("fp", "probe"), F.coalesce("blocks", F.lit(1))).cast("int")
    marked = signatures.join(heavy, ["part", "value"], "left").withColumn("side", side)
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    return marked.withColumn("other", other).select(
        "part", "value", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"), "fp", "probe", "side"
    )


def links(prints: DataFrame, *, distance: int, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """``src, dst``: fingerprints within ``distance`` bits, enough of them to join whatever is reachable.

    ``prints`` has the distinct fingerprints in ``fp``.
    """
    spark = prints.sparkSession
    drawn = prints.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample)
    known = np.array([r.fp for r in drawn.collect()], np.int64)
    parts = plan(known, prints.count(), distance)
    signatures = durable(prints.select("fp").mapInArrow(_signatures(parts), SIGNATURES), "signatures")
    cells = _cells(signatures, block)
    keys = ["part", "value", "a", "b"]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = cells.repartition(partitions, *keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(_compare(distance), "src bigint, dst bigint")


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4, **options
) -> DataFrame:
    """One row per row of ``docs``: ``id, th, fp, root, component`` with the smallest id reachable.

    ``th`` is Spark's xxhash64 of the text, ``fp`` the fingerprint as a signed number, ``root`` names the group by
    its smallest fingerprint.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), text_key(text_col).alias("th"),
        fingerprint(text_col, shingle).alias("fp"),
    )
    rows = durable(rows, "fingerprints")
    prints = durable(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    found = durable(links(prints, distance=distance, **options).distinct(), "links")
    graph = PropertyGraph(prints.select(F.col("fp").alias("id")), found)
    roots = connected_components(graph).select(F.col("id").alias("fp"), F.col("component").alias("root"))
    placed = prints.join(roots, "fp").select("fp", "root", "first")
    smallest = placed.groupBy("root").agg(F.min("first").alias("component"))
    named = placed.join(smallest, "root").select("fp", "root", "component")
    return rows.join(named, "fp").select("id", "th", "fp", "root", "component")


def _row_key(id_: str, th: str) -> Column:
    return F.concat_ws(":", F.coalesce(F.col(id_).cast("string"), F.lit("-")), F.col(th).cast("string"))


def keep_one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of every group: that of the smallest id; among rows of one id, the smallest text hash."""
    groups = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    smallest = groups.filter(F.col("id").eqNullSafe(F.col("component")))
    kept = smallest.groupBy("root", "id").agg(F.min("th").alias("th")).select(_row_key("id", "th").alias("key"))
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("rid"), text_key(text_col).alias("rth")
    )
    met = rows.select("row", _row_key("rid", "rth").alias("key")).join(kept, "key", "left_semi")
    # Rows equal in id and text are one; the join has brought them together already.
    return met.groupBy("key").agg(F.first("row").alias("row")).select("row.*")
