"""SimHash fingerprints of word shingles and the groups they form, found by pigeonring filtering.

A fingerprint of 64 bits is cut into 8 segments of 8 bits that form a ring. If two fingerprints differ in at most 3 bits,
some segment starts a chain in which every prefix of n segments differs in at most ``floor(n * 3 / 8)`` bits: the first two
segments are equal, the first five differ in one bit at most, so two of the third, fourth and fifth are equal as well.
Start and equal segments make a join key of 32 bits, 24 of them for a fingerprint, which is selective at any realistic number of
fingerprints. Rows of a key meet in sorted order, the rest of the chain prunes the pairs, and the full distance is checked last.

Three bits of 64 stand for a similarity of about 0.95; one of 0.8 is ten bits away on average, where no ring of segments is selective. So
``near_groups(similarity=...)`` also links texts by their shingles: bands of minima of the shingles' hashes are join keys for candidates, and the Jaccard similarity
of the shingle sets themselves decides.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import arrow_map, components, lean, lower_words
from .repeats import _numbered

SEED = 42
SEGMENTS = 8
DISTANCE = 3
#: Cumulative differences allowed for chains of 1..8 segments.
BUDGETS = np.array([(n + 1) * DISTANCE // SEGMENTS for n in range(SEGMENTS)], dtype=np.uint8)
#: Rows of one key that a task compares in memory; longer runs go the other way (``_ball_edges``).
RUN_LIMIT = 4096
_NEAR = 24
#: Minima of a text (a byte each; standard error 0.025 at 0.8), and the bands of them that are join keys: a pair at 0.8 misses all with chance 0.0001.
MINIMA, BANDS, BAND_ROWS = 256, 24, 5
#: Pairs estimated from this much below the wanted similarity are compared exactly, four standard errors of the estimate.
SLACK = 0.1
#: Rows that meet in one group; more are dealt to several.
PART_ROWS = 256
_random = np.random.default_rng(11)
_XORS, _FACTORS = _random.integers(1 << 32, size=(MINIMA, 1), dtype=np.uint32), _random.integers(1 << 32, size=(MINIMA, 1), dtype=np.uint32) | np.uint32(1)


def _shingle_hashes(tokens: list[bytes], shingle: int):
    """Hashes of a text's shingles, some thousands at a time."""
    text = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(tokens) > shingle:
        starts, ends = starts[: len(tokens) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    hash64 = partial(xxhash.xxh64_intdigest, seed=SEED)
    for at in range(0, len(starts), 1 << 13):
        pieces = [text[a:b] for a, b in zip(starts[at:at + (1 << 13)].tolist(), ends[at:at + (1 << 13)].tolist())]
        yield np.fromiter(map(hash64, pieces), dtype="<u8", count=len(pieces))


def _print(tokens: list[bytes], shingle: int, minima: bool) -> tuple[int, bytes | None, int | None]:
    """Fingerprint and, if wanted, a byte of each minimum and a hash of the set of shingles and the fingerprint; zero and none without words."""
    if not tokens:
        return 0, None, None
    counts, total, least, parts = np.zeros(64, dtype=np.int64), 0, np.full(MINIMA, 0xFFFFFFFF, dtype=np.uint32), []
    for hashes in _shingle_hashes(tokens, shingle):
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
        if minima:
            np.minimum(least, (((hashes >> np.uint64(32)).astype(np.uint32) ^ _XORS) * _FACTORS).min(axis=1), out=least)
            parts.append(hashes)
    fp = int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])
    if not minima:
        return fp, None, None
    return fp, (least * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).tobytes(), xxhash.xxh64_intdigest(np.unique(np.concatenate(parts)).tobytes(), seed=fp)


def fingerprint(tokens: list[bytes], shingle: int) -> int:
    """The fingerprint of a word sequence, unsigned; zero without words."""
    return _print(tokens, shingle, False)[0]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id, fp``: the fingerprint of every whole text, as a signed long. Null and empty texts get zero."""

    def run(batch):
        values = np.array([fingerprint(lower_words(t), shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        yield pa.record_batch([batch.column(0), pa.array(values.view(np.int64))], names=["id", "fp"])

    return arrow_map(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), run, "id long, fp long")


def _minima(rows: DataFrame, shingle: int) -> DataFrame:
    """``rid, id, fp, minima, sid`` from ``rid, id, text``; ``sid`` names the set of shingles with the fingerprint. Without words there are no minima."""

    def run(batch):
        fps, minima, sids = zip(*(_print(lower_words(t), shingle, True) for t in batch.column(2).to_pylist()))
        signed = [s if s is None or s < 1 << 63 else s - (1 << 64) for s in sids]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(np.array(fps, dtype=np.uint64).view(np.int64)), pa.array(minima, pa.binary()), pa.array(signed, pa.int64())],
                              names=["rid", "id", "fp", "minima", "sid"])

    return arrow_map(rows.select("rid", F.col("id").cast("long"), "text"), run, "rid long, id long, fp long, minima binary, sid long")


def _keys(column: str) -> list:
    """The 24 keys: start and pattern in the upper bits, four equal segments below."""
    segment = [F.shiftrightunsigned(F.col(column), 8 * i).bitwiseAND(255) for i in range(SEGMENTS)]
    made = []
    for start in range(SEGMENTS):
        ring = [segment[(start + i) % SEGMENTS] for i in range(5)]
        for k, pair in enumerate(combinations((2, 3, 4), 2)):
            value = F.lit((start * 3 + k) << 32)
            for place, i in enumerate((0, 1, *pair)):
                value = value.bitwiseOR(F.shiftleft(ring[i], 8 * place))
            made.append(value)
    return made


def _linked(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Chains first, full distance last, for pairs (elementwise)."""
    parts = np.bitwise_count((a ^ b).reshape(-1, 1).view(np.uint8))
    ring = np.take_along_axis(parts, (start.reshape(-1, 1) + np.arange(SEGMENTS)) % SEGMENTS, axis=1)
    viable = (np.cumsum(ring, axis=1, dtype=np.uint8) <= BUDGETS).all(axis=1)
    viable[viable] = parts[viable].sum(axis=1) <= DISTANCE
    return viable


def _run_forest(values: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is connected inside one run: each value with the first of its group."""
    n, chunk = len(values), max(1, (1 << 20) // len(values))
    labels = np.arange(n)
    while True:
        before = labels.copy()
        for at in range(0, n, chunk):
            a = np.repeat(values[at:at + chunk], n)
            near = _linked(a, np.tile(values, len(a) // n), np.full(len(a), start)).reshape(-1, n)
            near[np.arange(len(near)), at + np.arange(len(near))] = True
            labels[at:at + chunk] = np.where(near, labels, n).min(axis=1)
        labels = labels[labels]
        if (labels == before).all():
            break
    other = np.flatnonzero(labels != np.arange(n))
    return values[other], values[labels[other]]


def _match(run_limit: int):
    """Links among rows sorted by key; a run over ``run_limit`` is passed on as rows whose ``b`` is null."""

    def pairs(key, value):
        """Short runs of a sorted block, then the longer ones."""
        left, right = [], []
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(heads, len(key)))
        near = np.repeat(sizes <= _NEAR, sizes)
        k, v = key[near], value[near]
        for d in range(1, min(_NEAR, len(k))):
            at = np.flatnonzero(k[d:] == k[:-d])
            if not len(at):
                break
            hit = at[_linked(v[at], v[at + d], (k[at] >> 32) // 3)]
            left.append(v[hit])
            right.append(v[hit + d])
        for at, size in zip(heads[sizes > _NEAR].tolist(), sizes[sizes > _NEAR].tolist()):
            a, b = _run_forest(value[at:at + size], int(key[at] >> 32) // 3)
            left.append(a)
            right.append(b)
        return [np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right)]

    def run(batches):
        key = value = np.empty(0, dtype=np.int64)
        spilling = None
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            value = np.concatenate([value, batch.column(1).to_numpy()])
            if spilling is not None:
                end = int(np.searchsorted(key, spilling, side="right"))
                if end:
                    yield pa.record_batch([pa.array(value[:end]), pa.nulls(end, pa.int64())], names=["a", "b"])
                key, value = key[end:], value[end:]
            if len(key) and key[0] != key[-1]:
                last = int(np.searchsorted(key, key[-1]))
                yield pa.record_batch([pa.array(x) for x in pairs(key[:last], value[:last])], names=["a", "b"])
                key, value, spilling = key[last:], value[last:], None
            if len(key) > run_limit:
                spilling = key[0]
                yield pa.record_batch([pa.array(value), pa.nulls(len(value), pa.int64())], names=["a", "b"])
                key = value = np.empty(0, dtype=np.int64)
        if len(key):
            yield pa.record_batch([pa.array(x) for x in pairs(key, value)], names=["a", "b"])

    return run


def _ball_edges(fps: DataFrame) -> DataFrame:
    """Links of fingerprints in crowded keys without comparing them with each other.

    Two fingerprints within 3 bits share a value within 1 bit of one and 2 bits of the other. All that are within 1 bit of a value
    are linked with all that are within 2 bits of it, so each of them is linked with the smallest of the former.
    """

    def ball(batch):
        values = batch.column(0).to_numpy()
        single = np.int64(1) << np.arange(64, dtype=np.int64)
        i, j = np.triu_indices(64, 1)
        near = np.concatenate([[0], single])
        masks = np.concatenate([near, single[i] ^ single[j]])
        for value in values:
            around = value ^ masks
            yield pa.record_batch([pa.array(around), pa.array(np.full(len(masks), value)), pa.array(np.arange(len(masks)) < len(near))],
                                  names=["w", "a", "near"])

    rows = arrow_map(fps.select("a").distinct(), ball, "w long, a long, near boolean")
    anchors = rows.groupBy("w").agg(F.min(F.when(F.col("near"), F.col("a"))).alias("b")).where("b is not null")
    return rows.join(anchors, "w").where("a <> b").select("a", "b").distinct()


def links(values: DataFrame, run_limit: int = RUN_LIMIT) -> DataFrame:
    """``a, b``: links that connect exactly those of the distinct ``fp`` which the 3-bit rule connects."""
    keyed = values.select(F.explode(F.array(*_keys("fp"))).alias("key"), "fp")
    sorted_rows = keyed.repartition("key").sortWithinPartitions("key", "fp")
    found = stage(sorted_rows.mapInArrow(lean(_match(run_limit)), "a long, b long"), "simhash-links")
    plain = found.where("b is not null")
    if found.where("b is null").isEmpty():
        return plain
    return plain.union(_ball_edges(found.where("b is null")))


def _similar_forest(values: np.ndarray, minima: np.ndarray, least: float) -> tuple[list, list]:
    """Links that join what is connected among some rows: every row asks, once, which of those not yet joined are similar to it."""
    left, right, rest, waiting = [], [], np.arange(len(values)), []
    while len(rest) or waiting:
        if waiting:
            at = waiting.pop()
        else:
            at, rest = int(rest[0]), rest[1:]
        near = (minima[rest] == minima[at]).mean(axis=1) >= least
        found = rest[near]
        left.append(np.full(len(found), values[at]))
        right.append(values[found])
        waiting += found.tolist()
        rest = rest[~near]
    return left, right


def _match_similar(least: float):
    """Links among rows sorted by group; groups are small, the last one is carried to the next batch."""

    def pairs(group, value, minima):
        heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = np.diff(np.append(heads, len(group)))
        short = np.flatnonzero(np.repeat(sizes <= _NEAR, sizes))
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for d in range(1, min(_NEAR, len(short))):
            at = np.flatnonzero(group[short[d:]] == group[short[:-d]])
            if not len(at):
                break
            a, b = short[at], short[at + d]
            hit = (minima[a] == minima[b]).mean(axis=1) >= least
            left.append(value[a[hit]])
            right.append(value[b[hit]])
        for at, size in zip(heads[sizes > _NEAR].tolist(), sizes[sizes > _NEAR].tolist()):
            a, b = _similar_forest(value[at:at + size], minima[at:at + size], least)
            left += a
            right += b
        a, b = np.concatenate(left), np.concatenate(right)
        return pa.record_batch([pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"])

    def run(batches):
        group, value, minima = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, MINIMA), np.uint8)
        for batch in batches:
            group = np.concatenate([group, batch.column(0).to_numpy()])
            value = np.concatenate([value, batch.column(1).to_numpy()])
            minima = np.concatenate([minima, np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, MINIMA)])
            last = int(np.searchsorted(group, group[-1])) if len(group) else 0
            if last:
                yield pairs(group[:last], value[:last], minima[:last])
                group, value, minima = group[last:], value[last:], minima[last:]
        if len(group):
            yield pairs(group, value, minima)

    return run


def _exact_forest(values: np.ndarray, tops: np.ndarray, minima: np.ndarray, sets: list, similarity: float) -> tuple[list, list]:
    """Links that join what is connected among some rows by their shingle sets; rows of one ``top`` are joined already and not compared."""
    left, right, rest, waiting = [], [], np.arange(len(values)), []
    while len(rest) or waiting:
        if waiting:
            at = waiting.pop()
        else:
            at, rest = int(rest[0]), rest[1:]
        joined = tops[rest] == tops[at]
        for k in np.flatnonzero(~joined & ((minima[rest] == minima[at]).mean(axis=1) >= similarity - SLACK)).tolist():
            a, b = sets[at], sets[rest[k]]
            both = np.sort(np.concatenate([a, b]), kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            if common >= similarity * (len(a) + len(b) - common):
                joined[k] = True
                left.append(values[at])
                right.append(values[rest[k]])
        waiting += rest[joined].tolist()
        rest = rest[~joined]
    return left, right


def _match_exact(similarity: float):
    """Links among rows ``group, sid, top, minima, shingles`` sorted by group; groups are small, the last one is carried on."""

    def links_of(held):
        values, tops = (np.array([h[i] for h in held], dtype=np.int64) for i in (0, 1))
        minima = np.frombuffer(b"".join(h[2] for h in held), np.uint8).reshape(-1, MINIMA)
        a, b = _exact_forest(values, tops, minima, [np.frombuffer(h[3], "<u8") for h in held], similarity)
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        group, held = None, []
        for batch in batches:
            for g, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if g != group and held:
                    yield links_of(held)
                    held = []
                group = g
                held.append(row)
        if held:
            yield links_of(held)

    return run


def _candidates(texts: DataFrame, similarity: float) -> DataFrame:
    """``node, root``: of the texts ``sid, minima``, those that can be linked to others, in groups beyond which no text can.

    Where few rows share a band, those whose minima are estimated near enough are joined. Where many do, all of them are, without comparing.
    """
    bands = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    keyed = texts.select("sid", "minima", bands).select("sid", F.xxhash64("band", F.expr(f"substring(minima, band * {BAND_ROWS} + 1, {BAND_ROWS})")).alias("key"))
    shared = stage(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("sid").alias("first")).where("n > 1"), "bands")
    few = keyed.join(shared.where(F.col("n") <= PART_ROWS), "key").select("sid", F.col("key").alias("group"))
    met = few.join(texts, "sid").select("group", "sid", "minima").repartition("group").sortWithinPartitions("group")
    near = met.mapInArrow(lean(_match_similar(similarity - SLACK)), "a long, b long")
    crowd = keyed.join(shared.where(F.col("n") > PART_ROWS), "key").select(F.col("sid").alias("a"), F.col("first").alias("b"))
    return components(near.union(crowd.distinct()))


def _uncompared(members: DataFrame, found: DataFrame) -> DataFrame:
    """``group`` and the columns ``_match_exact`` reads: every pair of a large candidate group that the links found so far do not join meets in a group.

    The largest part of a candidate group that is joined already need not meet itself: its blocks meet those of the rest, and these each other.
    """
    tops = components(found)
    placed = members.drop("top").join(tops.withColumnRenamed("node", "sid").withColumnRenamed("root", "top"), "sid", "left").withColumn("top", F.coalesce("top", "sid"))
    parts = placed.groupBy("root", "top").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("root").agg(F.sum("n").alias("all"), F.max(F.struct("n", "top")).alias("most"))
    open_ = stage(sizes.where((F.col("all") > PART_ROWS) & (F.col("most.n") < F.col("all"))).select(
        "root", F.col("most.top").alias("main"), F.ceil(F.col("most.n") / PART_ROWS).alias("mains"),
        F.ceil((F.col("all") - F.col("most.n")) / PART_ROWS).alias("others")), "uncompared")
    rows = placed.join(open_, "root").withColumn("is_main", F.col("top") == F.col("main")).withColumn(
        "own", F.pmod(F.xxhash64("sid", F.lit(2)), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others"))))

    def upto(count):
        return F.sequence(F.lit(0).cast("long"), F.col(count) - 1)

    def pair(kind, a, b):
        return F.xxhash64("root", F.lit(kind), a, b)

    of_main = F.transform(upto("others"), lambda j: pair("main", F.col("own"), j))
    of_other = F.concat(F.transform(upto("mains"), lambda i: pair("main", i, F.col("own"))),
                        F.transform(upto("others"), lambda j: pair("other", F.least("own", j), F.greatest("own", j))))
    return rows.select(F.explode(F.when(F.col("is_main"), of_main).otherwise(of_other)).alias("group"), "sid", "top", "minima", "shingles")


def similar_links(rows: DataFrame, prints: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """``a, b``: links between the ``fp`` of texts whose shingle sets are this similar, from ``rid, text`` and ``_minima`` of them.

    The minima only find groups of candidates; the texts of these are read again and the shingle sets compared. A group of up to ``PART_ROWS`` texts
    is compared whole. A larger one is dealt to parts twice, which joins most copies, and then what is not joined meets block by block.
    """
    texts = stage(prints.where("minima is not null").groupBy("sid").agg(F.min(F.struct("rid", "fp", "minima")).alias("t")).select("sid", "t.*"), "minima")
    roots = _candidates(texts, similarity).withColumnRenamed("node", "sid")
    chosen = stage(roots.join(texts, "sid").select("rid", "sid", "root", "minima"), "chosen")

    def sets(batch):
        made = [np.unique(np.concatenate(list(_shingle_hashes(lower_words(t), shingle)))).tobytes() for t in batch.column(3).to_pylist()]
        yield pa.record_batch([*batch.columns[:3], pa.array(made, pa.binary())], names=["sid", "root", "minima", "shingles"])

    read = arrow_map(chosen.join(rows.select("rid", "text"), "rid").select("sid", "root", "minima", "text"), sets, "sid long, root long, minima binary, shingles binary")
    members = stage(read.withColumn("top", F.col("sid")), "candidates")
    parts = chosen.groupBy("root").agg(F.ceil(F.count("*") / PART_ROWS).alias("parts"))
    times = F.explode(F.when(F.col("parts") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("time")
    dealt = members.join(parts, "root").select("*", times).select(
        F.xxhash64("root", "time", F.pmod(F.xxhash64("sid", "time"), F.col("parts"))).alias("group"), "sid", "top", "minima", "shingles")

    def compared(groups, label):
        return stage(groups.repartition("group").sortWithinPartitions("group").mapInArrow(lean(_match_exact(similarity)), "a long, b long"), label)

    found = compared(dealt, "similar")
    found = found.union(compared(_uncompared(members, found), "similar"))
    names = texts.select("sid", "fp")
    ends = found.join(names.toDF("a", "x"), "a").join(names.toDF("b", "y"), "b")
    return ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                run_limit: int = RUN_LIMIT, similarity: float | None = None, row_col: str | None = None) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row; with ``row_col``, a number of the row's own, and ``similarity`` also ``rid, root``.

    ``root`` names a component where ids do not, because they are null or stand on several rows.

    Documents whose fingerprints are equal or linked, directly or through others, form a component named by its smallest id.
    With ``similarity``, texts whose shingle sets have that Jaccard similarity or more are linked as well.
    Null and empty texts have fingerprint zero and are linked like any other; a row with a null id takes part and names no
    component (a component of null ids only has a null name); repeated rows are all kept.
    """
    if similarity is None:
        prints = stage(fingerprints(docs, id_col, text_col, shingle), "simhash")
    else:
        rows = _numbered(docs, id_col, text_col) if row_col is None else docs.select(
            F.col(row_col).alias("rid"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        prints = stage(_minima(rows, shingle), "simhash")
    distinct = stage(prints.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-distinct")
    edges = links(distinct, run_limit)
    if similarity is not None:
        edges = edges.union(similar_links(rows, prints, shingle, similarity))
    roots = components(edges).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    names = rooted.join(named, "root").select("fp", "root", "component_id")
    return prints.join(names, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        *(["rid", "root"] if row_col is not None else []))
