"""Vectorised batch scoring: the model travels to each worker once, rows go through in Arrow batches."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.session import durable

# Most classes a model may have to travel whole to every worker; rows and centroids of a block beyond that, blocks of
# rows for each salt of a pack of centroids as long as there are too few groups, bytes of a pack and of the rows of a salt.
MAX_CLASSES, BLOCK, CELLS, PACK_BYTES, SALT_BYTES = 10_000, 4096, 64, 16 << 20, 32 << 20
ROW = "__row"


def class_centroids(vectors: DataFrame, *, vector: str = "embedding", label: str = "label") -> DataFrame:
    """Mean vector per class, summed up map-side: one small row per class."""
    dense = array_to_vector(F.col(vector).cast("array<double>"))
    return vectors.groupBy(label).agg(vector_to_array(Summarizer.mean(dense)).alias("centroid"))


def nearest_centroid_udf(labels: list[int], centroids: np.ndarray, *, batch_size: int = 32):
    """A scorer column function: array of numbers -> label of the nearest centroid, the smaller label on a tie."""
    order = np.argsort(labels)
    names = np.asarray(labels)[order]
    centres = np.asarray(centroids, dtype=np.float64)[order]

    def load():
        norms = (centres**2).sum(axis=1)

        def predict(batch: np.ndarray) -> np.ndarray:
            distances = norms - 2.0 * batch.astype(np.float64) @ centres.T
            return names[distances.argmin(axis=1)].astype(np.int32)

        return predict

    return predict_batch_udf(
        load, return_type=T.IntegerType(), batch_size=batch_size, input_tensor_shapes=[[centres.shape[1]]]
    )


def score_batch(
    vectors: DataFrame, *, vector: str = "embedding", label: str = "label", batch_size: int = 32, most: int = MAX_CLASSES, block: int = BLOCK,
):
    """``vectors`` with the label of the nearest class centroid; the model is one vector per class.

    Up to ``most`` classes the model travels whole to every worker. With more, blocks of rows meet blocks of centroids,
    and no worker holds more than a few blocks.
    """
    centres = durable(class_centroids(vectors, vector=vector, label=label), "centroids")
    model = centres.orderBy(label).limit(most + 1).collect()
    if len(model) > most:
        return _score_in_blocks(vectors, centres, vector, label, block)
    udf = nearest_centroid_udf([r[label] for r in model], np.array([r["centroid"] for r in model]), batch_size=batch_size)
    return vectors.withColumn("prediction", udf(F.col(vector).cast("array<double>")))


# Blocks of rows and of centroids


def _blocks(df: DataFrame, key: str, vector: str, block: int, n: int) -> DataFrame:
    """Rows of like norms packed together: ``id, low, high`` (of the norms), ``keys, norms, x``, written."""

    def pack(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                x = np.array(part.column(1).to_pylist(), np.float64)
                norms = np.sqrt((x**2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([norms.min()]), pa.array([norms.max()]), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                     pa.array([norms.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())],
                    names=["low", "high", "keys", "norms", "x"],
                )

    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda total, c: total + c * c)
    near = rows.withColumn("norm", norm).repartitionByRange(math.ceil(n / block), "norm").select("key", "v")
    packed = near.mapInArrow(pack, "low double, high double, keys array<bigint>, norms binary, x binary")
    return durable(packed.withColumn("id", F.monotonically_increasing_id()), "vector-blocks")


def _packs(ranges: list, most: int) -> list[tuple[int, int]]:
    """The pack of each block of centroids: blocks of like norms, ``most`` bytes of them or a single one."""
    packs, pack, held = [], -1, most
    for r in sorted(ranges, key=lambda r: (r["low"], r["id"])):
        if held + r["bytes"] > most:
            pack, held = pack + 1, 0
        held += r["bytes"]
        packs.append((r["id"], pack))
    return packs


def _spread(blocks: int, held: int, packs: int, tasks: int) -> int:
    """Salts of the rows, each of which gets all packs: as few as keep ``SALT_BYTES`` of rows together and all tasks busy."""
    return max(1, math.ceil(held / SALT_BYTES), min(math.ceil(blocks / CELLS), math.ceil(tasks / packs)))


def _met(asked: DataFrame, rows: DataFrame, centres: DataFrame, packs: DataFrame, spread: int) -> DataFrame:
    """``id, labels, distances``: the nearest centroid for each row of block ``id``, among the blocks ``asked`` (``id, centre``).

    Blocks of centroids travel in packs, so a block of rows is sent once per pack that holds one it asks, and has one
    answer per pack. A pack that many blocks of rows ask is given ``spread`` salts.
    """

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        models: dict[int, tuple[np.ndarray, ...]] = {}
        for r in right.select(["block", "names", "cx"]).to_pylist():
            names = np.array(r["names"])
            order = np.argsort(names)
            centre = np.frombuffer(r["cx"]).reshape(len(names), -1)[order]
            models[r["block"]] = names[order].astype(np.int64), centre, (centre**2).sum(axis=1)
        out = []
        for i in range(left.num_rows):
            row = left.slice(i, 1).to_pylist()[0]
            x = np.frombuffer(row["x"]).reshape(len(np.frombuffer(row["norms"])), -1)
            labels = far = None
            for block in row["asked"]:
                names, centre, lengths = models[block]
                gaps = lengths - 2.0 * x @ centre.T
                best = gaps.argmin(axis=1)
                found, gap = names[best], gaps[np.arange(len(best)), best]
                if labels is not None:
                    nearer = (gap < far) | ((gap == far) & (found < labels))
                    found, gap = np.where(nearer, found, labels), np.where(nearer, gap, far)
                labels, far = found, gap
            out.append((row["id"], labels.tobytes(), far.tobytes()))
        return pa.table({"id": pa.array([o[0] for o in out], pa.int64()), "labels": pa.array([o[1] for o in out], pa.binary()), "distances": pa.array([o[2] for o in out], pa.binary())})

    wanted = asked.join(F.broadcast(packs), "centre").groupBy("id", "pack").agg(F.collect_list("centre").alias("asked"))
    left = rows.select("id", "norms", "x").join(wanted, "id").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(spread)).cast("int"))
    right = centres.withColumnRenamed("id", "centre").join(F.broadcast(packs), "centre").select(
        F.col("centre").alias("block"), F.col("pack").alias("pack"), F.col("keys").alias("names"), F.col("x").alias("cx"), F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("salt")
    )
    keys = "pack", "salt"
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(nearest, "id bigint, labels binary, distances binary")


def _score_in_blocks(vectors: DataFrame, centres: DataFrame, vector: str, label: str, block: int) -> DataFrame:
    """Every row with the nearest of any number of centroids.

    A vector is no nearer to a centroid than their norms differ. So each block of rows meets the block of centroids whose
    norms are most like its own first, and after that only those that could still hold a nearer one for some row.
    """
    rows = durable(vectors.withColumn(ROW, F.monotonically_increasing_id()), "scored-rows")
    packed = _blocks(rows.filter(F.col(vector).isNotNull()), ROW, vector, block, max(1, rows.count()))
    models = _blocks(centres, label, "centroid", block, centres.count())
    # a row per block of centroids: one ``block``-th of the classes
    ranges = models.select("id", "low", "high", F.length("x").alias("bytes")).collect()
    ids, low, high = (np.array([r[c] for r in ranges]) for c in ("id", "low", "high"))
    numbered = _packs(ranges, PACK_BYTES)
    packs = vectors.sparkSession.createDataFrame(numbered, "centre bigint, pack int")
    blocks, held = packed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("x")), F.lit(0))).first()
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = _spread(blocks, held, len({pack for _, pack in numbered}), tasks)

    def home(batches):
        for batch in batches:
            middle = (batch.column(1).to_numpy() + batch.column(2).to_numpy()) / 2
            gap = np.maximum(np.maximum(low - middle[:, None], middle[:, None] - high), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids[gap.argmin(axis=1)], pa.int64())], names=["id", "home"])

    def others(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                norms = np.frombuffer(row["norms"])
                reach = np.sqrt(np.maximum(np.frombuffer(row["distances"]) + norms**2, 0))
                gap = np.maximum(np.maximum(low - norms[:, None], norms[:, None] - high), 0)
                near = (gap <= reach[:, None] * (1 + 1e-9) + 1e-9).any(axis=0) & (ids != row["home"])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(near.sum(), row["id"]), pa.int64()), pa.array(ids[near], pa.int64())], names=["id", "centre"])

    homes = durable(packed.select("id", "low", "high").mapInArrow(home, "id bigint, home bigint"), "home-blocks")
    first = durable(_met(homes.withColumnRenamed("home", "centre"), packed, models, packs, spread), "nearest")
    asked = packed.select("id", "norms").join(first, "id").join(homes, "id").select("id", "norms", "distances", "home")
    further = durable(asked.mapInArrow(others, "id bigint, centre bigint"), "asked-blocks")
    second = _met(further, packed, models, packs, spread)

    def least(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        labels, far = (np.array([np.frombuffer(v.as_py(), kind) for v in table.column(c)]) for c, kind in (("labels", np.int64), ("distances", np.float64)))
        order = np.lexsort((labels, far), axis=0)[0]
        return pa.table({"id": pa.array(np.full(1, key[0].as_py()), pa.int64()), "labels": pa.array([labels[order, np.arange(labels.shape[1])].tolist()], pa.list_(pa.int64()))})

    best = first.unionByName(second).groupBy("id").applyInArrow(least, "id bigint, labels array<bigint>")
    named = best.join(packed.select("id", "keys"), "id").select(F.inline(F.arrays_zip(F.col("keys").alias(ROW), F.col("labels").alias("prediction"))))
    return rows.join(named.select(ROW, F.col("prediction").cast("int").alias("prediction")), ROW, "left").drop(ROW)
