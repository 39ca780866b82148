"""Conversation prefix trie, built from sorted shards under a skeleton of splitter paths.

A conversation's path is the sequence of its turns' digests (SHA-256 of role and text, cut to 128 bits), and two paths
share a node of the trie as far as they agree. Paths are ordered as byte strings, so a node's members are neighbours.
Splitters drawn from the paths, each a path with a conversation's id, deal the conversations to shards; a group of
equal paths is split by id like any other stretch, so no shard holds more than its share whatever is common.

A node whose members lie in several shards starts a splitter: those nodes are the skeleton, the trie of the splitters'
paths, which is broadcast. A shard is sorted and read once, with one open node per turn of the current path: all
other nodes are finished there, and for skeleton nodes it hands on what it has seen. Those partial results are summed
by node, and the sums go up the skeleton, which is as small as the splitters. The ids that end at a skeleton node come
as pieces in order of their shards and are hashed as a stream.

Bounds: at most ``SPLITTERS`` splitters of at most ``SPLITTER_TURNS`` turns each; cutting a splitter's path moves a
border, not a result. A conversation's path is one row, of 24 bytes a turn; texts are left behind before.

Defined cases: rows without a conversation id take no part. Turns go by number, a null one first; turns of equal number
go by the digest of their role and text, and a turn given twice counts twice. A null role or text is as an empty one. A
conversation may have no turns at all, then it ends at the root. Of conversations with one id there is only one. An
empty table gives no rows, not even a root. Other columns are not read. Texts of any length are read whole, by Spark.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstat.llm.common import durable, new_path, shuffle_partitions

# Bytes of a turn's digest.
WIDE = 16
# Conversations that a shard should hold, splitters at most, turns of a splitter at most, sampled paths per splitter.
SHARD, SPLITTERS, SPLITTER_TURNS, DRAWN = 20_000, 1024, 1024, 32
# Ids of one piece of an end's list.
PIECE = 50_000
OUT_ROWS = 8192
NODE = "kind int, conv_id bigint, depth bigint, parent_conv_id bigint, under int, n_convs bigint, n_children bigint, " \
    "n_leaves bigint, saved_tokens bigint, size bigint, at int, shard int, piece int, ends string"
NAMES = [f.split()[0] for f in NODE.split(", ")]
KINDS = [{"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[f.split()[1]] for f in NODE.split(", ")]
LOCAL, PART, ENDS = 0, 1, 2
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def paths(turns: DataFrame, *, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, path, sizes`` per conversation: its turns' digests in hex and their texts' lengths in UTF-8 bytes."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    one = F.struct(
        F.col(order_col).alias("turn"), F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * WIDE).alias("digest"),
        F.octet_length(text).cast("bigint").alias("size"),
    )
    rows = turns.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("conv_id"), one.alias("one"))
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("all"))
    return gathered.select("conv_id", F.col("all.digest").alias("path"), F.col("all.size").alias("sizes"))


def rebuilt(convs: DataFrame, *, group: int = 5, most: int = 9) -> DataFrame:
    """Each conversation behind the first turns of its group's first one: ``crc32(id) % most`` turns of that are taken.

    The group of id c begins at ``c - c % group``; the taken turns stand in the place of c's own first ones.
    """
    heads = convs.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("head"), F.slice("path", 1, most).alias("head_path"), F.slice("sizes", 1, most).alias("head_sizes")
    )
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    joined = convs.withColumn("head", F.col("conv_id") - F.col("conv_id") % group).join(heads, "head", "left").withColumn("taken", taken)

    def spliced(head: str, own: str, kind: str):
        none = F.array().cast(kind)
        rest = F.slice(own, F.col("taken") + 1, F.greatest(F.size(own) - F.col("taken"), F.lit(0)))
        return F.concat(F.slice(F.coalesce(F.col(head), none), F.lit(1), F.col("taken")), rest)

    return joined.select(
        "conv_id", spliced("head_path", "path", "array<string>").alias("path"), spliced("head_sizes", "sizes", "array<bigint>").alias("sizes")
    )


def _common(left: bytes, right: bytes) -> int:
    """Turns that two paths have in common from the start."""
    most = min(len(left), len(right))
    if left[:most] == right[:most]:
        return most // WIDE
    a, b = np.frombuffer(left, np.uint8, most), np.frombuffer(right, np.uint8, most)
    return int(np.argmax(a != b)) // WIDE


class Skeleton:
    """The splitters in order, and the trie of their paths. A node is named by its least splitter and its depth."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.shared = [0] + [_common(splitters[i - 1][0], splitters[i][0]) for i in range(1, len(splitters))]

    def shard(self, path: bytes, conv: int) -> int:
        return bisect.bisect_right(self.splitters, (path, conv))

    def reach(self, shard: int, path: bytes) -> int:
        """Depth down to which the nodes of a path of this shard are skeleton nodes; the root always is one."""
        around = self.splitters[max(shard - 1, 0):shard + 1]
        return max((_common(path, s) for s, _ in around), default=0)

    def name(self, shard: int, path: bytes, depth: int) -> int:
        """The least splitter that shares ``depth`` turns with a path of this shard."""
        at = shard - 1 if shard and _common(self.splitters[shard - 1][0], path) >= depth else shard
        while at > 0 and self.shared[at] >= depth:
            at -= 1
        return at


def _skeleton(convs: DataFrame, shard: int) -> Skeleton:
    """Splitters for shards of some ``shard`` conversations each, from a sample in order of a hash of the ids."""
    n = convs.count()
    count = min(SPLITTERS, max(math.ceil(n / shard), min(shuffle_partitions(convs), math.ceil(n / 64))) - 1)
    if count < 1:
        return Skeleton([])
    drawn = convs.select(F.substring("path", 1, WIDE * SPLITTER_TURNS).alias("path"), "conv_id", F.xxhash64("conv_id").alias("h"))
    if n > count * DRAWN:
        share = int(min(1.0, count * DRAWN / n) * (1 << 62))
        drawn = drawn.filter(F.shiftright(F.col("h"), 1).bitwiseAND(F.lit((1 << 62) - 1)) < share)
    # the borders are picked in Spark, so only they reach the driver
    place = F.row_number().over(Window.orderBy("path", "conv_id"))
    size = drawn.count()
    picked = drawn.withColumn("place", place).filter(
        F.floor(F.col("place") * (count + 1) / F.lit(size + 1)) > F.floor((F.col("place") - 1) * (count + 1) / F.lit(size + 1))
    )
    return Skeleton(sorted({(bytes(r["path"]), r["conv_id"]) for r in picked.select("path", "conv_id").collect()}))


class _Open:
    """A node on the current path."""

    __slots__ = ("size", "convs", "least", "children", "leaves", "saved", "hash", "ends", "n_ends", "pieces", "waiting")

    def __init__(self, size: int):
        self.size, self.convs, self.least, self.children, self.leaves, self.saved = size, 0, None, 0, 0, 0
        self.hash, self.ends, self.n_ends, self.pieces, self.waiting = None, [], 0, 0, []


def _shards(skeleton: Skeleton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        opened: list[_Open] = []
        shard, path, reach = None, b"", -1

        def ended(depth: int, node: _Open) -> None:
            """Pieces of ids: into the hash of a local node, out as a row of a skeleton node."""
            if node.ends:
                text = ",".join(map(str, node.ends))
                if depth <= reach:
                    out.append((ENDS, None, depth, None, None, None, None, None, None, None, skeleton.name(shard, path, depth), shard, node.pieces, text))
                else:
                    node.hash = node.hash or hashlib.sha256()
                    node.hash.update(("," if node.pieces else "").encode() + text.encode())
                node.pieces, node.ends = node.pieces + 1, []

        def close(least: int) -> None:
            """Finishes the open nodes deeper than ``least``."""
            while len(opened) > least + 1:
                depth, node = len(opened) - 1, opened.pop()
                above = opened[-1] if opened else None
                ended(depth, node)
                if depth <= reach:
                    at = skeleton.name(shard, path, depth)
                    out.extend((LOCAL, row[0], depth + 1, None, at, *row[1:]) for row in node.waiting)
                    out.append((PART, node.least, depth, None, None, node.convs, node.children, node.leaves, node.saved, node.size, at, shard, None, None))
                else:
                    out.extend((LOCAL, row[0], depth + 1, node.least, None, *row[1:]) for row in node.waiting)
                    node.leaves += not node.children
                    node.saved += (node.convs - 1) * node.size
                    digest = (node.hash or hashlib.sha256()).hexdigest()
                    above.waiting.append((node.least, node.convs, node.children, node.leaves, node.saved, None, None, None, None, digest))
                    above.children, above.leaves, above.saved = above.children + 1, above.leaves + node.leaves, above.saved + node.saved
                if above is not None:
                    above.convs += node.convs
                    above.least = node.least if above.least is None else min(above.least, node.least)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)], names=NAMES)

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for at, conv, new, sizes in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                    if at != shard:
                        close(-1)
                        shard, path = at, b""
                        opened.append(_Open(0))
                    shared = _common(path, new)
                    close(shared)
                    path, reach = new, skeleton.reach(shard, new)
                    opened.extend(_Open(size) for size in sizes[shared:])
                    last = opened[-1]
                    last.convs, last.least = last.convs + 1, conv if last.least is None else min(last.least, conv)
                    last.ends.append(conv)
                    if len(last.ends) >= PIECE:
                        ended(len(opened) - 1, last)
                    while len(out) >= OUT_ROWS:
                        yield batch_of(out[:OUT_ROWS])
                        del out[:OUT_ROWS]
        close(-1)
        for start in range(0, len(out), OUT_ROWS):
            yield batch_of(out[start:start + OUT_ROWS])

    return run


def _dealt(skeleton: Skeleton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [skeleton.shard(p, c) for c, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns], names=["shard", "conv_id", "path", "sizes"])

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of ids, in order within each node, to one digest per node: a stream, so only a piece is held."""
    now, state, done = None, None, []
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1).to_pylist()[0]
            if (one["at"], one["depth"]) != now:
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (one["at"], one["depth"]), hashlib.sha256(one["ends"].encode())
            else:
                state.update(b"," + one["ends"].encode())
    if now is not None:
        done.append((*now, state.hexdigest()))
    if done:
        at, depth, ends = zip(*done, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(depth, pa.int64()), pa.array(ends)], names=["at", "depth", "ends_sha256"])


def _skeleton_rows(skeleton: Skeleton, parts: dict[tuple[int, int], tuple]) -> list[tuple]:
    """Sums of the shards' parts, brought up the skeleton from its deepest nodes: rows of nodes, with their names."""
    nodes = {key: list(value) for key, value in parts.items()}
    above: dict[tuple[int, int], tuple[int, int]] = {}
    for at, depth in nodes:
        if depth:
            up = at
            while up > 0 and skeleton.shared[up] >= depth - 1:
                up -= 1
            above[at, depth] = (up, depth - 1)
    for key in sorted(nodes, key=lambda k: -k[1]):
        _, convs, children, leaves, saved, size = nodes[key]
        nodes[key][3] = leaves = leaves + (not children)
        nodes[key][4] = saved = saved + (convs - 1) * size
        if key in above:
            parent = nodes[above[key]]
            parent[2], parent[3], parent[4] = parent[2] + 1, parent[3] + leaves, parent[4] + saved
    return [
        (at, depth, least, nodes[above[at, depth]][0] if depth else None, convs, children, leaves, saved)
        for (at, depth), (least, convs, children, leaves, saved, _) in nodes.items()
    ]


def trie(convs: DataFrame, *, shard: int = SHARD) -> DataFrame:
    """A row per node of the trie of ``conv_id, path, sizes`` rows; ``conv_id`` is unique and not null."""
    spark = convs.sparkSession
    whole = durable(convs.select("conv_id", F.unhex(F.array_join("path", "")).alias("path"), "sizes"), "paths")
    skeleton = _skeleton(whole, shard)
    shards = len(skeleton.splitters) + 1
    dealt = whole.mapInArrow(_dealt(skeleton), "shard int, conv_id bigint, path binary, sizes array<bigint>")
    sorted_ = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id").select("shard", "conv_id", "path", "sizes")
    path = new_path(spark, "trie-nodes")
    sorted_.mapInArrow(_shards(skeleton), NODE).write.partitionBy("kind").parquet(path)
    found = spark.read.schema(NODE).parquet(path)

    part = found.filter(F.col("kind") == PART).groupBy("at", "depth").agg(
        F.min("conv_id").alias("least"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.first("size").alias("size"),
    )
    parts = {
        (r["at"], r["depth"]): (r["least"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["size"])
        for r in part.collect()
    }
    pieces = found.filter(F.col("kind") == ENDS).select("at", "depth", "shard", "piece", "ends")
    ends = pieces.repartition("at", "depth").sortWithinPartitions("at", "depth", "shard", "piece").mapInArrow(
        _hashed, "at int, depth bigint, ends_sha256 string"
    )
    bones = spark.createDataFrame(
        _skeleton_rows(skeleton, parts),
        "at int, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint",
    )
    none = hashlib.sha256().hexdigest()
    upper = bones.join(ends, ["at", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none)))
    local = found.filter(F.col("kind") == LOCAL).withColumnRenamed("ends", "ends_sha256")
    # as many rows as the broadcast skeleton has nodes
    tops = F.broadcast(bones.select(F.col("at").alias("under"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("top")))
    local = local.join(tops, ["under", "depth"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top"))
    return local.select(*RESULT).unionByName(upper.select(*RESULT))
