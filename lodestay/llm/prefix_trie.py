"""Conversation prefix trie by adaptive radix trees over turn ids.

A turn's id is a 128-bit number, the first half of the SHA-256 of its role and text, written big-endian: a conversation is one byte string of fixed-width
ids, and byte order is the order of id sequences. Conversations are sorted by it over all tasks, so equal ones and those with a common prefix are neighbours,
and a prefix of a third of all conversations is simply many tasks. Each task grows an adaptive radix tree of its range: nodes of 4, 16, 48 or 256
slots that grow when full, with the bytes that do not branch kept as a path. Only byte depths at whole turns are nodes of the trie.

A trie node that reaches over the edge of a range is a prefix of the neighbour's nearest conversation. Each range is given those two, so every node, child
and leaf counts in one range alone, and what the ranges found for an edge node is only added up. There are twice as many edge paths as ranges.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import WORD, crc_ctes

ID_BYTES = 16
#: Conversations share the first turns of the one whose id is the multiple of ``GROUP`` before theirs; fewer than ``MOST_SHARED``.
GROUP, MOST_SHARED = 20, 4
#: Conversations of a range; there are at least as many ranges as shuffle partitions.
RANGE_ROWS = 20_000
NO_IDS = hashlib.sha256(b"").hexdigest()
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


class Node:
    """A radix tree node: the path bytes before it branches, a value if a key ends here, and its slots in one of four layouts."""

    __slots__ = ("index", "labels", "path", "slots", "value")

    def __init__(self, path: bytes, value: int | None = None):
        self.path, self.value = path, value
        self.labels, self.index, self.slots = bytearray(), None, []

    @property
    def size(self) -> int:
        """The layout: 4 or 16 sorted labels beside their slots, 48 slots behind an index of 256 bytes, or 256 slots."""
        if self.labels is None:
            return 48 if self.index is not None else 256
        return 4 if len(self.slots) <= 4 else 16

    def child(self, label: int) -> Node | None:
        if self.labels is not None:
            at = bisect.bisect_left(self.labels, label)
            return self.slots[at] if at < len(self.labels) and self.labels[at] == label else None
        if self.index is not None:
            return self.slots[self.index[label] - 1] if self.index[label] else None
        return self.slots[label]

    def put(self, label: int, node: Node) -> None:
        """Adds a child, or replaces the one of that label."""
        if self.labels is not None:
            at = bisect.bisect_left(self.labels, label)
            if at < len(self.labels) and self.labels[at] == label:
                self.slots[at] = node
                return
            if len(self.slots) < 16:
                self.labels.insert(at, label)
                self.slots.insert(at, node)
                return
            self.index = bytearray(256)
            for k, other in enumerate(self.labels, 1):
                self.index[other] = k
            self.labels = None
        if self.index is not None:
            if self.index[label]:
                self.slots[self.index[label] - 1] = node
                return
            if len(self.slots) < 48:
                self.slots.append(node)
                self.index[label] = len(self.slots)
                return
            self.slots, self.index = [self.slots[k - 1] if k else None for k in self.index], None
        self.slots[label] = node

    def children(self) -> Iterator[Node]:
        """In the order of their labels."""
        if self.index is not None:
            return (self.slots[k - 1] for k in self.index if k)
        return (node for node in self.slots if node is not None)


def shared(a: bytes, b: bytes) -> int:
    """The number of first bytes two strings have in common."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    low, high = 0, size
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


def insert(root: Node, key: bytes, value: int) -> None:
    """Adds a key; keys may be prefixes of one another."""
    node, at = root, 0
    while True:
        rest = key[at:at + len(node.path)]
        common = shared(node.path, rest)
        if common < len(node.path):
            lower = Node(node.path[common + 1:], node.value)
            lower.labels, lower.index, lower.slots = node.labels, node.index, node.slots
            label = node.path[common]
            node.path, node.value, node.labels, node.index, node.slots = node.path[:common], None, bytearray(), None, []
            node.put(label, lower)
        at += common
        if at == len(key):
            node.value = value
            return
        child = node.child(key[at])
        if child is None:
            node.put(key[at], Node(key[at + 1:], value))
            return
        node, at = child, at + 1


class _Range:
    """The trie nodes of one range of sorted conversations, from its radix tree."""

    def __init__(self, keys: list[bytes], ids: list[list[int]], words: list[list[int]], before: bytes | None, after: bytes | None):
        self.keys, self.ids, self.words = keys, ids, words
        # depths to which the range's first and last paths are also those of its neighbours
        self.left = -1 if before is None else shared(before, keys[0]) // ID_BYTES
        self.right = -1 if after is None else shared(after, keys[-1]) // ID_BYTES
        self.edges = [self._digests(keys[0], self.left), self._digests(keys[-1], self.right)]
        self.rows: list[dict] = []
        self.root = Node(b"")
        for k, key in enumerate(keys):
            insert(self.root, key, k)

    @staticmethod
    def _digests(key: bytes, depth: int) -> list[str]:
        state, out = hashlib.sha256(), []
        for d in range(depth + 1):
            state.update(key[(d - 1) * ID_BYTES:d * ID_BYTES] if d else b"")
            out.append(state.hexdigest())
        return out

    def _emit(self, depth: int, found: dict, value: int | None) -> None:
        """A trie node above the topmost nodes ``found["tops"]`` of its subtree."""
        left = found["first"] == 0 and depth <= self.left
        right = found["last"] == len(self.keys) - 1 and depth <= self.right
        tops, first = found["tops"], found["first"]
        found["saved"] += (found["n"] - (not left)) * (self.words[first][depth - 1] if depth else 0)
        found["leaves"] += not tops and not right
        row = {"node": self.edges[0][depth] if left else self.edges[1][depth] if right else None, "parent": None, "conv_id": found["least"], "depth": depth,
               "parent_conv_id": None, "n_convs": found["n"], "n_children": sum(self.rows[t]["fresh"] for t in tops), "n_leaves": found["leaves"],
               "saved_tokens": found["saved"], "ends_sha256": NO_IDS, "piece": None, "fresh": not left}
        if value is not None:
            text = ",".join(map(str, self.ids[value]))
            if row["node"]:
                row["piece"] = text
            else:
                row["ends_sha256"] = hashlib.sha256(text.encode()).hexdigest()
        for t in tops:
            if row["node"]:
                self.rows[t]["parent"] = row["node"]
            else:
                self.rows[t]["parent_conv_id"] = row["conv_id"]
        found["tops"] = [len(self.rows)]
        self.rows.append(row)

    def nodes(self) -> list[dict]:
        """Every trie node of the range, children before parents; a stack, for paths may be longer than Python's."""
        stack = [(self.root, -1, 0, iter(self.root.children()), [])]
        while True:
            node, start, end, rest, parts = stack[-1]
            if (child := next(rest, None)) is not None:
                stack.append((child, end, end + 1 + len(child.path), iter(child.children()), []))
                continue
            stack.pop()
            if node.value is not None:
                own = self.ids[node.value]
                parts.insert(0, {"n": len(own), "least": own[0], "first": node.value, "last": node.value, "saved": 0, "leaves": 0, "tops": []})
            found = {"n": sum(p["n"] for p in parts), "least": min(p["least"] for p in parts), "first": parts[0]["first"], "last": parts[-1]["last"],
                     "saved": sum(p["saved"] for p in parts), "leaves": sum(p["leaves"] for p in parts), "tops": [t for p in parts for t in p["tops"]]}
            for depth in range(end // ID_BYTES, start // ID_BYTES, -1):
                self._emit(depth, found, node.value if depth * ID_BYTES == end else None)
            if not stack:
                return self.rows
            stack[-1][4].append(found)


_FOUND = _NODE + ", node string, parent string, part int, piece string"


def _grow(rows: pa.Table, bounds: pa.Table) -> pa.Table:
    """The trie nodes of a range: whole ones, and for those on its edges what it adds to them."""
    keys, ids, words = rows.column("key").to_pylist(), rows.column("conv_id").to_pylist(), rows.column("words").to_pylist()
    distinct, members, counts = [], [], []
    for i in sorted(range(len(keys)), key=lambda i: (keys[i], ids[i])):
        if not distinct or distinct[-1] != keys[i]:
            distinct.append(keys[i])
            members.append([])
            counts.append(words[i])
        members[-1].append(ids[i])
    nodes = _Range(distinct, members, counts, bounds.column("before")[0].as_py(), bounds.column("after")[0].as_py()).nodes()
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    part = rows.column("part")[0].as_py()
    return pa.table({name: pa.array([part if name == "part" else n[name] for n in nodes], kinds[kind]) for name, kind in (c.split() for c in _FOUND.split(", "))})


def _joined_ends(batches):
    """``node, ends_sha256`` from pieces sorted by node and range: one running digest, whatever the number of ids."""
    node, state = None, None
    for batch in batches:
        done = []
        for name, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if done:
            yield pa.record_batch([pa.array([d[0] for d in done]), pa.array([d[1] for d in done])], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.record_batch([pa.array([node]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def _shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def rebuild(conversations: DataFrame) -> DataFrame:
    """``conv_id, key, words``: the turn ids of every rebuilt conversation as bytes, and the words of its turns.

    Turns stand in order of ``turn``, null first, ties by id. Null roles and texts are empty. Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turn = F.struct("turn", F.substring(digest, 1, 2 * ID_BYTES).alias("id"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    own = stage(conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("t")).alias("turns")), "conversations")
    heads = own.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, MOST_SHARED - 1).alias("head"))
    count = _shared_turns(F.col("conv_id")).cast("int")
    sequence = F.concat(F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), count), F.slice("turns", count + 1, F.size("turns")))
    whole = own.join(heads, own["conv_id"] - own["conv_id"] % GROUP == heads["base"], "left").select("conv_id", sequence.alias("s"))
    return whole.select("conv_id", F.unhex(F.array_join(F.transform("s", lambda t: t["id"]), "")).alias("key"), F.transform("s", lambda t: t["words"]).alias("words"))


def prefix_trie(conversations: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The trie's nodes: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``conversations`` needs ``conv_id, turn, role, text``; other columns are not read. Equal conversations are members of the same nodes, equal rows are turns
    of their own. A conversation left without turns ends at the root. Without conversations there are no rows. A remainder of a negative conv_id has its sign, as in
    SQL. The turn ids of one conversation must fit in a task (36 bytes a turn).
    """
    spark = conversations.sparkSession
    whole = stage(rebuild(conversations), "rebuilt")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-whole.count() // range_rows))
    ordered = stage(whole.repartitionByRange(ranges, "key", "conv_id").withColumn("part", F.spark_partition_id()), "sorted")
    # one row a range
    by_part = W.orderBy("part")
    bounds = ordered.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).select(
        "part", F.lag("last").over(by_part).alias("before"), F.lead("first").over(by_part).alias("after"))
    found = stage(ordered.groupBy("part").cogroup(bounds.groupBy("part")).applyInArrow(_grow, _FOUND), "nodes")

    edge = found.where("node is not null")
    pieces = edge.where("piece is not null").select("node", "part", "piece").repartition("node").sortWithinPartitions("node", "part")
    ends = pieces.mapInArrow(_joined_ends, "node string, ends_sha256 string")
    sums = edge.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
                                    *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    edges = stage(sums.join(ends, "node", "left"), "edge-nodes")
    columns = [c.split()[0] for c in _NODE.split(", ")]
    merged = edges.select("parent", *[F.lit(None).cast("long").alias(c) if c == "parent_conv_id" else F.coalesce(c, F.lit(NO_IDS)).alias(c) if c == "ends_sha256" else c for c in columns])
    rows = found.where("node is null").select("parent", *columns).union(merged)
    parents = edges.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    below = rows.where("parent is not null").join(parents, "parent").withColumn("parent_conv_id", F.col("above"))
    return rows.where("parent is null").select(*columns).union(below.select(*columns))


ORACLE_SQL = rf"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, left(sha256(concat(length(coalesce(role, '')), ':', role, text)), {2 * ID_BYTES}) AS id,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS words FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT conv_id, id, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS pos FROM raw),
names AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM raw),
{crc_ctes("SELECT s FROM names")},
convs AS (SELECT conv_id, crc % {MOST_SHARED} AS h, conv_id - conv_id % {GROUP} AS base FROM names JOIN crcs USING (s)),
both_parts AS (SELECT c.conv_id, 0 AS part, pos, id, words FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= h
    UNION ALL SELECT c.conv_id, 1, pos, id, words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > h),
paths AS (SELECT conv_id, row_number() OVER o AS depth, string_agg(id, '') OVER o AS path, words FROM both_parts WINDOW o AS (PARTITION BY conv_id ORDER BY part, pos)
    UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM paths GROUP BY path, depth),
children AS (SELECT left(path, {2 * ID_BYTES} * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (SELECT nodes.path, depth, CASE WHEN n IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * words AS saved FROM nodes LEFT JOIN children USING (path)),
sums AS (SELECT left(path, {2 * ID_BYTES} * above) AS path, sum(leaf) AS n_leaves, sum(saved) AS saved FROM (SELECT *, unnest(range(depth + 1)) AS above FROM valued) GROUP BY 1),
lasts AS (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id),
ends AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM lasts GROUP BY path)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(c.n, 0) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
    CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes v LEFT JOIN nodes p ON v.depth = p.depth + 1 AND p.path = left(v.path, {2 * ID_BYTES} * (v.depth - 1))
LEFT JOIN children c ON c.path = v.path LEFT JOIN sums s ON s.path = v.path LEFT JOIN ends e ON e.path = v.path
"""
