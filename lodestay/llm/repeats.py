"""Substring dedup by fixed-block anchors.

A repeat of ``window`` words holds, in each of its places, a whole block of ``block = (window + 1) // 2`` words that starts at a multiple of the
block's length. The index holds these blocks; every rolling window of that length, of every text, probes it. Blocks that are probed more than
once anchor the search: only windows around them are hashed whole (96 bits) and counted, and runs of repeated windows are the maximal
repeats. Places are never paired with each other: hashes are counted, and a place asks whether its hash occurs again.

Probes are the bulk of what is shuffled, so they travel packed: a task sorts the hashes of a few megabytes of text, keeps two of equal ones at most and
sends one binary row to each bucket of hashes. The number of buckets follows the number of blocks, so a bucket's size does not grow with the data.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import arrow_map, release, slices, words

WINDOW = 35
#: Probes of one bucket, before equal ones of a slice are dropped; and the bytes that travel of a hash besides its bucket.
BUCKET_PROBES, KEY_BYTES = 1 << 21, 5
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _word_hashes(tokens: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), tokens), dtype=np.uint64, count=len(tokens))


def rolling(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` values, by doubling."""
    if len(hashes) < length:
        return np.empty(0, dtype=np.uint64)

    def joined(a, b):
        x = (a ^ (a >> np.uint64(29))) * _MIX + (b ^ (b >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(31))

    power, size, made, covered = hashes, 1, None, 0
    rest = length
    while rest:
        if rest & 1:
            made = power if made is None else joined(made[: len(made) - size], power[covered:])
            covered += size
        rest >>= 1
        if rest:
            power = joined(power[:-size], power[size:])
            size *= 2
    return made


def _windows(tokens: list[list[bytes]], length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and start of every window of every text."""
    counts = np.array([len(t) for t in tokens], dtype=np.int64)
    flat = [w for t in tokens for w in t]
    hashes = rolling(_word_hashes(flat, seed), length)
    owner = np.repeat(np.arange(len(tokens)), counts)[: len(hashes)]
    start = np.arange(len(hashes)) - (np.cumsum(counts) - counts)[owner]
    inside = start + length <= counts[owner]
    return hashes[inside].view(np.int64), owner[inside], start[inside]


def _packed(keys: np.ndarray, indexed: bool) -> pa.RecordBatch:
    """Sorted keys as one binary row for each bucket."""
    buckets = keys >> (8 * KEY_BYTES)
    heads = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    raw = np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES])
    offsets = (np.append(heads, len(keys)) * KEY_BYTES).astype(np.int32)
    rows = pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    return pa.record_batch([pa.array(buckets[heads]), pa.array(np.full(len(heads), indexed)), rows], names=["bucket", "indexed", "keys"])


def _unpacked(rows: pa.ChunkedArray) -> np.ndarray:
    data = np.frombuffer(b"".join(rows.to_pylist()), dtype=np.uint8).reshape(-1, KEY_BYTES)
    wide = np.zeros((len(data), 8), dtype=np.uint8)
    wide[:, :KEY_BYTES] = data
    return wide.view("<i8").ravel()


def _probed_again(bucket: pa.Table) -> pa.Table:
    """Keys of the bucket's blocks that more than one window has; a block is a window too."""
    indexed = bucket.column("indexed")
    probes, times = np.unique(_unpacked(bucket.filter(pa.compute.invert(indexed)).column("keys")), return_counts=True)
    again = np.intersect1d(probes[times > 1], _unpacked(bucket.filter(indexed).column("keys")))
    return pa.table({"h": again | bucket.column("bucket")[0].as_py() << (8 * KEY_BYTES)})


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rid, text``; the id itself where it names every row, else numbers fixed in a staged copy."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    usable = docs.schema[id_col].dataType.simpleString() in ("bigint", "int")
    if usable and plain.groupBy("id").count().where("id is null or count > 1").isEmpty():
        return plain.select(F.col("id").cast("long").alias("rid"), "id", "text")
    return stage(plain.select(F.monotonically_increasing_id().alias("rid"), "id", "text"), "numbered")


def _again(batches):
    """Of rows sorted by hash, those whose hash the row before or after has too; one row is carried from batch to batch."""
    last, told = None, True

    def out(rids, starts):
        return pa.record_batch([pa.array(rids, pa.int64()), pa.array(starts, pa.int32())], names=["rid", "s"])

    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, rid, s = (batch.column(i).to_numpy() for i in range(4))
        same = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
        twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        if last is not None and (last[0], last[1]) == (h1[0], h2[0]):
            twice[0] = True
            if not told:
                yield out([last[2]], [last[3]])
        yield out(rid[twice], s[twice])
        last, told = (h1[-1], h2[-1], rid[-1], s[-1]), bool(twice[-1])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row.

    A word goes if a window of ``window`` words that covers it occurs again, in another or the same text; windows are those of the input. Null and
    empty texts have no words and an empty kept text; texts shorter than a window lose nothing; repeated rows are copies of each other.
    """
    block = (window + 1) // 2
    rows = _numbered(docs, id_col, text_col)

    def blocks(batch):
        for part in slices(batch, 1):
            h, owner, start = _windows([words(t) for t in part.column(1).to_pylist()], block, 1)
            at = start % block == 0
            yield pa.record_batch([pa.array(h[at]), part.column(0).take(pa.array(owner[at])), pa.array((start[at] // block).astype(np.int32))],
                                  names=["h", "rid", "n"])

    index = stage(arrow_map(rows.select("rid", "text"), blocks, "h long, rid long, n int"), "blocks")
    # a key holds the upper bits of a hash, which name its bucket, and the lower ones
    bits = max(6, (index.count() * block // BUCKET_PROBES).bit_length())
    low = (1 << 8 * KEY_BYTES) - 1

    def probes(batch):
        for part in slices(batch, 0):
            h, _, start = _windows([words(t) for t in part.column(0).to_pylist()], block, 1)
            keys = (h.view(np.uint64) >> np.uint64(64 - bits) << np.uint64(8 * KEY_BYTES)).view(np.int64) | (h & low)
            if len(keys):
                values, times = np.unique(keys, return_counts=True)
                yield _packed(np.repeat(values, np.minimum(times, 2)), False)
                if len(own := np.unique(keys[start % block == 0])):
                    yield _packed(own, True)

    packed = arrow_map(rows.select("text"), probes, "bucket long, indexed boolean, keys binary")
    again = stage(packed.groupBy("bucket").applyInArrow(_probed_again, "h long"), "anchors")
    release(packed)
    key = F.shiftleft(F.shiftrightunsigned("h", 64 - bits), 8 * KEY_BYTES).bitwiseOR(F.col("h").bitwiseAND(F.lit(low)))
    anchors = index.withColumn("h", key).join(again, "h").groupBy("rid").agg(F.collect_list("n").alias("n"))

    def candidates(batch):
        for part in slices(batch, 1):
            tokens = [words(t) for t in part.column(1).to_pylist()]
            first, owner, start = _windows(tokens, window, 1)
            second = _windows(tokens, window, 2)[0]
            counts = np.array([-(-len(t) // block) + 1 for t in tokens])
            base = np.cumsum(counts) - counts
            anchor = np.zeros(int(counts.sum()), dtype=bool)
            lists = part.column(2)
            anchor[np.repeat(base, np.asarray(pa.compute.list_value_length(lists))) + np.asarray(lists.flatten())] = True
            at = anchor[base[owner] + -(-start // block)]
            yield pa.record_batch([pa.array(first[at]), pa.array(second[at].astype(np.int32)), part.column(0).take(pa.array(owner[at])), pa.array(start[at].astype(np.int32))],
                                  names=["h1", "h2", "rid", "s"])

    near = arrow_map(rows.select("rid", "text").join(anchors, "rid"), candidates, "h1 long, h2 int, rid long, s int")
    ordered = near.repartition("h1", "h2").sortWithinPartitions("h1", "h2")
    repeated = ordered.mapInArrow(_again, "rid long, s int")
    starts = stage(repeated.groupBy("rid").agg(F.collect_list("s").alias("s")), "starts")
    release(near)

    def cut(batch):
        for part in slices(batch, 1):
            kept, total, removed = [], [], []
            for text, covered in zip(part.column(1).to_pylist(), part.column(2)):
                tokens = words(text)
                total.append(len(tokens))
                if covered.is_valid:
                    begins = np.asarray(covered.values)
                    edge = np.zeros(len(tokens) + 1, dtype=np.int64)
                    np.add.at(edge, begins, 1)
                    np.add.at(edge, begins + window, -1)
                    left = np.flatnonzero(np.cumsum(edge)[:-1] == 0)
                    tokens = [tokens[i] for i in left.tolist()]
                removed.append(total[-1] - len(tokens))
                kept.append(b" ".join(tokens).decode("utf-8"))
            yield pa.record_batch([part.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                  names=["doc_id", "n_words", "n_removed", "kept_text"])

    kind = docs.schema[id_col].dataType.simpleString()
    joined = rows.join(starts, "rid", "left").select("id", "text", "s")
    return arrow_map(joined, cut, f"doc_id {kind}, n_words long, n_removed long, kept_text string")
