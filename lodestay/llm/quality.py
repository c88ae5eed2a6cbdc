"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Features are hashed byte trigrams, weighted by tf-idf, with a few shares that describe the shape of a text (repeated words, capitals, symbols). The
singular vectors of a bounded sample of labelled rows span the space; the sample's vectors are broadcast (their number is a parameter) and every
document is compared with all of them, block by block. The nearest vote with weights that grow with their cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

SAMPLE = 2000
FEATURES, RANK, NEIGHBOURS, SHARPNESS = 2048, 48, 15, 8
_SHAPES = 6


def features(texts: list) -> np.ndarray:
    """A row per text: log counts of hashed trigrams, then the shape shares."""
    raw = [t.encode("utf-8", "replace") if t else b"" for t in texts]
    sizes = np.array([len(r) for r in raw])
    owner = np.repeat(np.arange(len(raw), dtype=np.int32), sizes)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    out = np.zeros((len(raw), FEATURES + _SHAPES), dtype=np.float32)
    if len(data) > 2:
        wide = data.astype(np.uint32)
        gram = ((wide[:-2] * 65599 + wide[1:-1] * 2053 + wide[2:]) * np.uint32(2654435761)) >> np.uint32(21)
        inside = owner[:-2] == owner[2:]
        cells = owner[:-2][inside].astype(np.int64) * FEATURES + gram[inside]
        out[:, :FEATURES] = np.log1p(np.bincount(cells, minlength=len(raw) * FEATURES).reshape(len(raw), FEATURES))
    kind = np.zeros(256, dtype=np.uint8)
    kind[65:91], kind[[*range(33, 44), 60, 61, 62, 64, 94, 124, 126]], kind[48:58] = 1, 2, 3
    kinds = kind[data]
    for k in (1, 2, 3):
        out[:, FEATURES + k - 1] = np.bincount(owner[kinds == k], minlength=len(raw)) / np.maximum(sizes, 1)
    for i, r in enumerate(raw):
        w = r.split()
        if w:
            out[i, FEATURES + 3:] = (sum(map(bytes.__eq__, w[1:], w)) / len(w), 1 - len(set(w)) / len(w), 1 / (1 + len(w)))
    return out


class Voters:
    """The space and the labelled vectors in it; all of fixed size."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray):
        self.labels = labels.astype(np.float32)
        grams = rows[:, :FEATURES]
        self.idf = np.log((1 + len(rows)) / (1 + (grams > 0).sum(axis=0))).astype(np.float32)
        weighted = self.weigh(rows)
        rank = min(RANK, *weighted.shape) if len(rows) else 1
        random = np.random.default_rng(7).standard_normal((weighted.shape[1], rank + 16)).astype(np.float32)
        probe = weighted.T @ (weighted @ random) if len(rows) else random
        for _ in range(2):
            probe = weighted.T @ (weighted @ np.linalg.qr(probe)[0]) if len(rows) else probe
        basis = np.linalg.qr(probe)[0]
        turn = np.linalg.svd(weighted @ basis, full_matrices=False)[2] if len(rows) else np.eye(basis.shape[1])
        self.basis = (basis @ turn.T[:, :rank]).astype(np.float32)
        self.vectors = self.place(rows)

    def weigh(self, rows: np.ndarray) -> np.ndarray:
        grams = rows[:, :FEATURES] * self.idf
        grams /= np.maximum(np.linalg.norm(grams, axis=1, keepdims=True), 1e-9)
        return np.hstack([grams, rows[:, FEATURES:] * 1.5])

    def place(self, rows: np.ndarray) -> np.ndarray:
        placed = self.weigh(rows) @ self.basis
        return placed / np.maximum(np.linalg.norm(placed, axis=1, keepdims=True), 1e-9)

    def vote(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        cosines = self.place(rows) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(cosines, near, axis=1), 0) ** SHARPNESS + 1e-6  # all vote alike where none is similar
        return np.clip((weights * self.labels[near]).sum(axis=1) / weights.sum(axis=1), 0, 1)


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  sample: int = SAMPLE, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    At most ``sample`` labelled rows that are not held out, chosen by a hash of their ids, are learned from; null labels are not used. Null and
    empty texts are scored like a text without features. Without labelled rows every score is 0.5.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    known = rows.where("not held_out").select("doc_id").join(marked, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)

    def learn(batches):
        for batch in batches:
            for part in slices(batch, 0, 1 << 20):
                made = features(part.column(0).to_pylist()).astype(np.float16)
                yield pa.record_batch([part.column(1), pa.array([m.tobytes() for m in made], pa.binary())], names=["label", "row"])

    taken = rows.join(F.broadcast(known), "doc_id").select("text", "label").mapInArrow(learn, "label int, row binary").collect()
    taken.sort(key=lambda r: (bytes(r.row), r.label))
    matrix = np.array([np.frombuffer(r.row, dtype=np.float16) for r in taken], dtype=np.float32).reshape(-1, FEATURES + _SHAPES)
    shared = spark.sparkContext.broadcast(Voters(matrix, np.array([r.label for r in taken])))

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2, 1 << 20):
                scores = shared.value.vote(features(part.column(2).to_pylist())).astype(np.float64)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(scores)], names=["doc_id", "held_out", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
