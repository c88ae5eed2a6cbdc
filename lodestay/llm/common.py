"""Helpers the operators share: table access, Arrow tasks, words, links to components."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import stage

#: A word is a run of anything but the six ASCII white-space characters; the same set ``bytes.split`` uses.
WORD = r"[^\x20\x09-\x0D]+"
LETTER = re.compile(r"[^\W\d_]")


def kept(name: str) -> dict:
    """A dictionary a worker process keeps from task to task. Code travels to executors by value, so the globals of these modules are new in every task."""
    home = sys.modules.setdefault("__lodestay_kept__", types.ModuleType("__lodestay_kept__"))
    return home.__dict__.setdefault(name, {})


def give_back() -> None:
    """Returns memory that was freed in this process to the system; else it stays with the process, beside what the JVM takes."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def lean(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *names: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same task, which drops what its worker process keeps beside ``names`` before it begins, and gives its own memory back when it ends.

    Spark hands worker processes on from one operator's tasks to the next one's, which would carry the dictionaries and the peaks of all before.
    """

    def run(batches):
        home = sys.modules.get("__lodestay_kept__")
        others = [k for k, v in vars(home).items() if isinstance(v, dict) and not k.startswith("__") and k not in names] if home else []
        for k in others:
            vars(home)[k].clear()
        if others:
            gc.collect()
            give_back()
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, unchanged."""
    return text.encode("utf-8", "replace").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z in lower case; other letters stay."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def crc_bucket(column: str, modulus: int) -> Column:
    """crc32 of the number as text, modulo ``modulus``; -1 for a null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus, F.lit(-1))


def arrow_map(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch; batches without rows are skipped."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(lean(run), schema)


def slices(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about ``limit`` bytes (one text at least), so work arrays stay small."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0))
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for each start, ``count`` of them, in one array."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def release(done: DataFrame) -> None:
    """Lets Spark drop the shuffle files of finished work now; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    done.sparkSession.sparkContext._jvm.System.gc()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """The smallest node reachable, for every node of ``edges`` (a long, b long): ``node, root``.

    Alternating star contraction: each round hangs a node's neighbours on its smallest neighbour, first the larger ones and
    then the smaller ones, so the number of rounds follows the logarithm of a component's size. Only minima are grouped, no neighbour lists, and
    every round is written to the shared folder, which cuts the lineage.
    """
    oriented = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current, seen = stage(oriented, "links"), None
    for _ in range(rounds):
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003)).first())
        if state == seen or not state[0]:
            break
        seen = state
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        turned = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        current = stage(least.select("u", F.col("m").alias("v")).union(turned).distinct(), "links")
    else:
        raise RuntimeError(f"links did not settle in {rounds} rounds")
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(current.select("v", "v").distinct())


def crc_ctes(source: str) -> str:
    """CTEs of a ``WITH RECURSIVE``, the last of which, ``crcs(s, crc)``, has the crc32 of the UTF-8 of every distinct ``s`` of the query ``source``.

    The crc is linear: each byte adds, by exclusive or, a value that follows from itself and the number of bytes after it.
    """
    return f"""coded AS (SELECT DISTINCT s, hex(s) AS code FROM ({source})),
longest AS (SELECT coalesce(max(length(code)), 0) // 2 AS size FROM coded),
bits AS (SELECT b, b AS v, 0 AS k FROM range(256) t(b) UNION ALL SELECT b, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM bits WHERE k < 8),
byte_crc AS (SELECT b, v, printf('%02X', b) AS code FROM bits WHERE k = 8),
moved AS (SELECT 0 AS k, b, code, v FROM byte_crc
    UNION ALL SELECT k + 1, m.b, m.code, xor(m.v // 256, t.v) FROM moved m JOIN byte_crc t ON t.b = m.v % 256 WHERE k < (SELECT size FROM longest)),
zeros AS (SELECT 0 AS k, 4294967295 AS v UNION ALL SELECT k + 1, xor(z.v // 256, t.v) FROM zeros z JOIN byte_crc t ON t.b = z.v % 256 WHERE k < (SELECT size FROM longest)),
bytes AS (SELECT s, unnest(range(length(code) // 2)) AS i, length(code) // 2 AS size, code FROM coded),
crcs AS (SELECT b.s, xor(xor(bit_xor(m.v), any_value(z.v)), 4294967295) AS crc
    FROM bytes b JOIN moved m ON m.k = b.size - 1 - b.i AND m.code = substr(b.code, 2 * b.i + 1, 2) JOIN zeros z ON z.k = b.size GROUP BY b.s)"""
