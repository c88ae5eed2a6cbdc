"""Near-duplicate vectors by an inverted multi-index.

A codebook for each half of the (unit) vectors spans a grid of cells. Every vector is stored in the cell of its two nearest codewords and, as a query,
visits cells by growing sum of both distances (multi-sequence order). How many cells it visits is calibrated on the sample: pairs just at
the threshold are made from it, and the number is the rank that finds ``recall`` of them. Pairs that meet in a cell are verified in double precision.
Equal vectors are one class with a multiplicity, and crowded cells are split into blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import components

COSINE, RECALL = 0.98, 0.99
SAMPLE, CODEWORDS, ROUNDS = 4096, 32, 12
BLOCK_ROWS = 2048


class Grid:
    """Two codebooks, and the number of cells to visit; of fixed size."""

    def __init__(self, sample: np.ndarray, cosine: float, recall: float, seed: int = 11):
        random = np.random.default_rng(seed)
        self.half = sample.shape[1] // 2
        self.books = [self._kmeans(part, random) for part in (sample[:, : self.half], sample[:, self.half:])]
        noise = random.standard_normal(sample.shape)
        noise -= (noise * sample).sum(axis=1, keepdims=True) * sample
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
        other = cosine * sample + np.sqrt(1 - cosine ** 2) * noise
        home, grid = self.order(other).argmin(axis=1), self.order(sample)
        ranks = (grid < grid[np.arange(len(grid)), home][:, None]).sum(axis=1)
        self.visits = int(np.quantile(ranks, recall, method="higher")) + 1

    @staticmethod
    def _kmeans(points: np.ndarray, random) -> np.ndarray:
        book = points[random.choice(len(points), min(CODEWORDS, len(points)), replace=False)]
        for _ in range(ROUNDS):
            near = ((points ** 2).sum(1)[:, None] - 2 * points @ book.T + (book ** 2).sum(1)).argmin(axis=1)
            sums, counts = np.zeros_like(book), np.bincount(near, minlength=len(book))
            np.add.at(sums, near, points)
            book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
        return book

    def order(self, units: np.ndarray) -> np.ndarray:
        """Squared distance to every cell, cells as first index * size of the second book + second index."""
        parts = [((u ** 2).sum(1)[:, None] - 2 * u @ b.T + (b ** 2).sum(1)) for u, b in zip((units[:, : self.half], units[:, self.half:]), self.books)]
        return (parts[0][:, :, None] + parts[1][:, None, :]).reshape(len(units), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; divided by their largest component first, so that no square of a finite one is lost or infinite."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(v, dtype="<f8") for v in column.to_pylist()])


def _meet(cosine: float):
    """Verified pairs of rows sorted by cell, stored rows before queries; a cell's block of stored rows is all that is held."""

    def run(batches):
        key, ids, stored = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, role, cid = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            units = batch.column(3)
            heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            for at, end in zip(heads.tolist(), [*heads[1:].tolist(), len(keys)]):
                if key != keys[at]:
                    key, ids, stored = keys[at], [], []
                middle = at + int(np.searchsorted(role[at:end], 1))
                if middle > at:
                    ids.append(cid[at:middle])
                    stored.append(_matrix(units.slice(at, middle - at)))
                if end > middle and ids:
                    have, queries = np.concatenate(ids), _matrix(units.slice(middle, end - middle))
                    q, s = np.nonzero(queries @ np.concatenate(stored).T >= cosine)
                    a, b = cid[middle:end][q], have[s]
                    other = a != b
                    yield pa.record_batch([pa.array(np.minimum(a, b)[other]), pa.array(np.maximum(a, b)[other])], names=["a", "b"])

    return run


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE,
                 recall: float = RECALL, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Rows are linked if labels are equal and not null and the cosine is ``cosine`` at least. Null, empty, zero vectors and those with null or non-finite
    components, and rows with a null label, link with nothing and are their own components; vectors of different lengths never link. Repeated rows
    are vectors of their own; rows with a null id count as links and are not kept.
    """
    spark = vectors.sparkSession
    number = F.col("v").cast("array<double>")
    rows = stage(vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                                F.col(vector_col).alias("v")).withColumn("v", number).withColumn("usable", F.coalesce(
        F.expr("label is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x <> 0)"), F.lit(False))), "vectors")
    classes = rows.where("usable").groupBy("label", "v").agg(F.count("*").alias("m"), F.min("id").alias("least"))
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    lengths = [r.n for r in classes.select(F.size("v").alias("n")).distinct().collect()]
    pairs = None
    for length in lengths:
        some = classes.where(F.size("v") == length).select("cid", "label", "v")
        found = _pairs(some, cosine, recall, block_rows)
        pairs = found if pairs is None else pairs.union(found)
    if pairs is None:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    pairs = stage(pairs.distinct(), "vector-links")
    sizes = classes.select(F.col("cid").alias("b"), F.col("m").alias("bm"))
    counts = pairs.union(pairs.select("b", "a")).toDF("a", "b").join(sizes, "b").groupBy(F.col("a").alias("cid")).agg(F.sum("bm").alias("others"))
    roots = components(pairs).withColumnRenamed("node", "cid")
    rooted = classes.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    told = rooted.join(named, "root").join(counts, "cid", "left").select(
        "label", "v", (F.col("m") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    linked = rows.where("usable").join(told, ["label", "v"]).select("id", "n_links", "component_id")
    alone = rows.where("not usable").select("id", F.lit(0).cast("long"), "id")
    return linked.union(alone).toDF("vec_id", "n_links", "component_id").withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _pairs(classes: DataFrame, cosine: float, recall: float, block_rows: int) -> DataFrame:
    """``a, b``: verified links among classes of one length."""
    taken = classes.orderBy(F.xxhash64("v"), "cid").limit(SAMPLE).select("v").collect()
    grid = Grid(_unit(np.array([r.v for r in taken])), cosine, recall)
    shared = classes.sparkSession.sparkContext.broadcast(grid)

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                units = _unit(np.array(batch.column(2).to_pylist()))
                g = shared.value
                for at in range(0, len(units), 512):
                    part = units[at:at + 512]
                    order = g.order(part)
                    k = min(g.visits, order.shape[1])
                    near = np.argpartition(order, k - 1, axis=1)[:, :k]
                    rest = batch.slice(at, len(part))
                    yield pa.record_batch([rest.column(0), rest.column(1), pa.array(order.argmin(axis=1)), pa.array(list(near.astype(np.int64)), pa.list_(pa.int64())),
                                           pa.array([u.astype("<f8").tobytes() for u in part], pa.binary())], names=["cid", "label", "home", "near", "unit"])

    placed = stage(classes.mapInArrow(place, "cid long, label string, home long, near array<long>, unit binary"), "placed")
    crowd = placed.groupBy("label", F.col("home").alias("cell")).agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / block_rows)).drop("n")
    cell = F.xxhash64("label", "cell")
    stored = placed.withColumnRenamed("home", "cell").join(crowd, ["label", "cell"]).select(
        F.xxhash64(cell, F.pmod("cid", "blocks")).alias("key"), F.lit(0).alias("role"), "cid", "unit", "label", "cell")
    asked = placed.withColumn("cell", F.explode("near")).join(crowd, ["label", "cell"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    asked = asked.select(F.xxhash64(cell, "block").alias("key"), F.lit(1).alias("role"), "cid", "unit", "label", "cell")
    met = stored.union(asked).select("key", "role", "cid", "unit").repartition("key").sortWithinPartitions("key", "role")
    # labels share a key only if two 64-bit hashes are equal; the labels of a pair are compared all the same
    labels = placed.select("cid", "label")
    found = met.mapInArrow(_meet(cosine), "a long, b long").distinct()
    same = found.join(labels.toDF("a", "la"), "a").join(labels.toDF("b", "lb"), "b").where("la = lb")
    return same.select("a", "b")
