"""Language-model scores by a hashed maximum-entropy model.

Symbols are the most frequent words of the training texts, the end of a text, and buckets of the other words by their last letters. A word's probability
is that of its symbol, by a softmax over classes of symbols and one inside the class, times its share of its bucket (counts of all
training words). Features are the last word, the last two, and the words two and three back (skips), each by the word itself, hashed to rows of the
weight tables; the number of rows grows with the cube root of the training tokens, so a task's copy of the tables stays small.

Texts are encoded once and staged as word codes. What each feature row observed is counted over all training tokens. Weights start from these counts; then
rounds follow, each over its own share of the texts (chosen by a hash of the row): all tasks add up what the present model expects in each feature row, the
sums meet block by block in a shuffle, and one step along the gradient (observed less expected) is made for the whole table. Steps are
taken between jobs and never inside a task, so scores don't depend on how rows are dealt to tasks.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import lower_words, slices

CLASSES, PER_CLASS, BUCKETS = 64, 32, 256
SYMBOLS = CLASSES * PER_CLASS
FREQUENT = SYMBOLS - BUCKETS - 1
END = SYMBOLS - 1
#: Words, at most, whose counts every task holds; counts of the others are joined.
HEAD = 200_000
#: Rounds, the parts of the first and the later steps that are taken, and the penalty on half the square of a weight.
ROUNDS, START, STEP, PENALTY = 4, 0.4, 0.4, 8.0
BATCH, BLOCK = 16384, 1024
#: Tokens whose logits are worked on at a time: few enough for them to stay in a core's cache.
CACHED = 2048
#: Features of the classes: last word, last two, second and third word back (skips); inside a class the first three of them.
_TOP_FEATURES, _INNER_FEATURES = (0, 1, 2, 3), (0, 1, 2)
#: Codes below it are head words; the end of a text; from ``_TAIL`` on bucket (8 bits) and hash (23 bits) of other words.
_END_CODE, _TAIL, _HASH_BITS = 0x7FFFFFFF, 0x80000000, 23
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def bucket(word: bytes) -> int:
    value = 0
    for c in word[-2:]:
        value = value * 131 + c
    return value % BUCKETS


def row_bits(tokens: int) -> int:
    """The tables have ``2 ** row_bits`` rows: 64 for each unit of the cube root of the training tokens, rounded up."""
    return max(10, math.ceil(math.log2(64 * max(tokens, 1) ** (1 / 3))))


class _Codes(dict):
    """Code of each word; codes of words outside the head are made when first met."""

    def __missing__(self, word: bytes) -> int:
        code = _TAIL | bucket(word) << _HASH_BITS | zlib.crc32(word) & (1 << _HASH_BITS) - 1
        self[word] = code
        return code


class Vocabulary:
    """Head words by falling count, their counts, and what all training words add up to."""

    def __init__(self, words: list[str], counts: np.ndarray, docs: int, tail: np.ndarray):
        """``tail`` holds, for each bucket, occurrences and distinct words outside the head."""
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words = [words[i].encode() for i in order]
        self.counts = np.array([counts[i] for i in order], dtype=np.float64)
        self.docs = docs
        self.symbol = np.arange(len(order))
        self.symbol[FREQUENT:] = [FREQUENT + bucket(w) for w in self.words[FREQUENT:]]
        rest = self.symbol[FREQUENT:] - FREQUENT
        buckets = tail + np.stack([np.bincount(rest, self.counts[FREQUENT:], BUCKETS), np.bincount(rest, minlength=BUCKETS)], axis=1)
        self.total = int(self.counts.sum() + tail[:, 0].sum()) + docs
        self.distinct = int(len(order) + tail[:, 1].sum()) + bool(docs)
        self.mass = np.zeros(SYMBOLS)
        self.mass[:min(FREQUENT, len(order))] = self.counts[:FREQUENT]
        self.mass[FREQUENT:END], self.mass[END] = buckets[:, 0], docs
        self.base_log = np.log10(self.total + 0.5 * (self.distinct + 1))
        self.head_log = np.log10(self.counts + 0.5)
        # a bucket's share: its words' counts, each with half a count more, and half a count for all words never seen
        self.bucket_log = np.log10(buckets[:, 0] + 0.5 * (buckets[:, 1] + 1))

    def codes(self) -> _Codes:
        return _Codes((w, i) for i, w in enumerate(self.words))


def symbols_of(codes: np.ndarray, head_symbol: np.ndarray) -> np.ndarray:
    found = np.full(len(codes), END, dtype=np.int64)
    head, tail = codes < _END_CODE, codes >= _TAIL
    found[head] = head_symbol[codes[head]]
    found[tail] = FREQUENT + (codes[tail] - _TAIL >> _HASH_BITS)
    return found


class Model:
    """The weight tables over hashed feature rows, on top of the symbols' own shares."""

    def __init__(self, mass: np.ndarray, head_symbol: np.ndarray, bits: int):
        self.bits, self.head_symbol = bits, head_symbol
        mass = (mass + 0.5).reshape(CLASSES, PER_CLASS)
        self.class_bias = np.log(mass.sum(1) / mass.sum()).astype(np.float32)
        self.inner_bias = np.log(mass / mass.sum(1, keepdims=True)).astype(np.float32)
        self.weights = [np.zeros((1 << bits, CLASSES), dtype=np.float32), np.zeros((1 << bits, PER_CLASS), dtype=np.float32)]

    def _hash(self, values: np.ndarray) -> np.ndarray:
        x = values * _GOLDEN
        return (((x ^ x >> np.uint64(29)) * _GOLDEN) >> np.uint64(64 - self.bits)).astype(np.int64)

    def features(self, codes: np.ndarray, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of both tables for each token, a row for each feature; ``starts`` are the first tokens of texts."""
        parts = list(self.parts(codes, starts, symbols))
        return np.concatenate([p[1] for p in parts], axis=1), np.concatenate([p[2] for p in parts], axis=1)

    def _shares(self, symbols: np.ndarray, rows: np.ndarray, inner_rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What probabilities are in proportion to, and its sums by token: of all classes, then of the symbols in the token's own class."""
        for table, bias, places in ((self.weights[0], self.class_bias, rows), (self.weights[1], self.inner_bias[symbols // PER_CLASS], inner_rows)):
            logits = table.take(places[0], axis=0)
            other = np.empty_like(logits)
            for r in places[1:]:
                logits += table.take(r, axis=0, out=other, mode="clip")
            logits += bias
            logits -= logits.max(axis=1, keepdims=True)
            np.exp(logits, out=logits)
            yield logits, logits.sum(axis=1, keepdims=True)

    def chances(self, symbols: np.ndarray, rows: np.ndarray, inner_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of all classes, and of the symbols in the token's own class."""
        top, inner = (np.divide(shares, sums, out=shares) for shares, sums in self._shares(symbols, rows, inner_rows))
        return top, inner

    def parts(self, codes: np.ndarray, starts: np.ndarray, symbols: np.ndarray | None = None,
              size: int = BATCH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Symbols and feature rows, some tokens at a time."""
        symbols = symbols_of(codes, self.head_symbol) if symbols is None else symbols
        since = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
        wide = np.concatenate([np.zeros(3, np.uint64), codes.astype(np.uint64) + np.uint64(1)])
        for at in range(0, len(codes), size):
            n = min(size, len(codes) - at)
            s, passed = symbols[at:at + n], since[at:at + n]
            back = [wide[at + 3 - k:at + 3 - k + n] * (passed >= k) for k in (1, 2, 3)]
            names = [back[0], back[0] * _GOLDEN + back[1], back[1], back[2]]
            marked = np.stack([x * np.uint64(8) + np.uint64(k) for k, x in enumerate(names)])
            inner = marked[list(_INNER_FEATURES)] * np.uint64(CLASSES) + ((s // PER_CLASS).astype(np.uint64) + np.uint64(1 << 50))
            yield s, self._hash(marked[list(_TOP_FEATURES)]), self._hash(inner)

    def log_scores(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 of each symbol's probability."""
        out = []
        for symbols, rows, inner_rows in self.parts(codes, starts, size=CACHED):
            i, own = np.arange(len(symbols)), (symbols // PER_CLASS, symbols % PER_CLASS)
            top, inner = (shares[i, which] / sums[:, 0] for (shares, sums), which in zip(self._shares(symbols, rows, inner_rows), own))
            out.append(np.log10(np.maximum(top.astype(float) * inner, 1e-30)))
        return np.concatenate(out)

    def observe(self, sums: list[np.ndarray], codes: np.ndarray, starts: np.ndarray) -> None:
        """Adds to ``sums``, a line for each class and a column for each row, how often feature rows met classes, and symbols of the class."""
        for symbols, rows, inner_rows in self.parts(codes, starts):
            for table, found, which in zip(sums, (rows, inner_rows), (symbols // PER_CLASS, symbols % PER_CLASS)):
                for r in found:
                    np.add.at(table.reshape(-1), (which << self.bits) + r, 1.0)

    def expect(self, sums: list[np.ndarray], codes: np.ndarray, starts: np.ndarray) -> None:
        """Adds to ``sums`` the same, as this model expects it."""
        rows = 1 << self.bits
        for symbols, *found in self.parts(codes, starts, size=min(max(BATCH, rows), 1 << 17)):
            lines = [np.empty((len(table), len(symbols))) for table in sums]
            for at in range(0, len(symbols), CACHED):
                cut = slice(at, at + CACHED)
                for into, chances in zip(lines, self.chances(symbols[cut], *(places[:, cut] for places in found))):
                    into[:, cut] = chances.T
            for table, whole, places in zip(sums, lines, found):
                for line, chance in zip(table, whole):
                    for r in places:
                        line += np.bincount(r, chance, rows)

    def start(self, observed: list[np.ndarray]) -> None:
        """The first step, from no weights: every token of a row expects the symbols' own shares."""
        inner = np.exp(self.inner_bias).mean(axis=0)
        for table, seen, share in zip(self.weights, observed, (np.exp(self.class_bias), inner)):
            table += np.float32(START) * self._gain(seen, share[None], table)

    def step(self, observed: list[np.ndarray], expected: list[np.ndarray]) -> None:
        """A step along the gradient, scaled for each weight; rows that a round has no tokens of stay."""
        for table, seen, sums in zip(self.weights, observed, expected):
            tokens = sums.sum(axis=1)
            met = np.flatnonzero(tokens > 0)
            table[met] += np.float32(STEP) * self._gain(seen[met], sums[met] / tokens[met, None], table[met])

    @staticmethod
    def _gain(seen: np.ndarray, chance: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Gradient (observed less expected counts less the penalty's pull) over the expected counts and the penalty, damped by a logarithm."""
        expected = seen.sum(axis=1, keepdims=True) * chance
        return np.log1p(np.maximum((seen - expected - PENALTY * weights) / (expected + PENALTY), -0.9)).astype(np.float32)


def _words_of(batches, limit: int = 200_000):
    """Word counts of an Arrow column of texts, emitted whenever many words are held."""
    held: Counter = Counter()

    def out():
        pairs = pa.record_batch([pa.array([w.decode() for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return pairs

    for batch in batches:
        for part in slices(batch, 0):
            held.update(chain.from_iterable(map(lower_words, part.column(0).to_pylist())))
            if len(held) > limit:
                yield out()
    if held:
        yield out()


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over a table with one text column."""
    return texts.mapInArrow(_words_of, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def vocabulary(training: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary and the staged counts of the words outside the head, from a table with one text column.

    The head takes whole levels of counts, highest first, as long as it has ``HEAD`` words at most.
    """
    counts = stage(word_counts(training).withColumn("level", F.floor(F.log2("c") * 8).cast("int")), "words")
    held, least = 0, 1 << 30
    for r in sorted(counts.groupBy("level").count().collect(), key=lambda r: -r.level):
        held += r["count"]
        if held > HEAD:
            break
        least = r.level
    head = counts.where(F.col("level") >= least).select("word", "c").toArrow()
    others = counts.where(F.col("level") < least).select("word", "c")

    def tally(batches):
        sums = np.zeros((BUCKETS, 2), dtype=np.int64)
        for batch in batches:
            which = np.fromiter((bucket(w.encode()) for w in batch.column(0).to_pylist()), dtype=np.int64)
            sums[:, 0] += np.bincount(which, batch.column(1).to_numpy(), BUCKETS).astype(np.int64)
            sums[:, 1] += np.bincount(which, minlength=BUCKETS)
        yield pa.record_batch([pa.array(np.arange(BUCKETS)), pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["b", "c", "v"])

    tail = np.zeros((BUCKETS, 2))
    for r in others.mapInArrow(tally, "b long, c long, v long").groupBy("b").agg(F.sum("c").alias("c"), F.sum("v").alias("v")).collect():
        tail[r.b] = (r.c, r.v)
    return Vocabulary(head.column("word").to_pylist(), head.column("c").to_numpy(), training.count(), tail), others


def encode(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Staged ``codes`` of each row's words and end, its counts of tokens and known head words, base score without tail words, and these words."""
    shared = rows.sparkSession.sparkContext.broadcast(vocab)
    fields = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    schema += ", codes binary, n_tokens long, head_known long, head_base double, words array<string>, times array<long>"
    place = rows.columns.index("text")

    def run(batches):
        v = shared.value
        known = v.codes()
        for batch in batches:
            for part in slices(batch, place):
                if len(known) > len(v.words) + 500_000:
                    known = v.codes()
                split = [lower_words(t) for t in part.column(place).to_pylist()]
                flat = list(chain.from_iterable(split))
                sizes = np.array([len(w) for w in split])
                ends = np.cumsum(sizes + 1)
                starts, total = ends - sizes - 1, int(ends[-1])
                codes = np.full(total, _END_CODE, dtype=np.uint32)
                inside = np.ones(total, dtype=bool)
                inside[ends - 1] = False
                codes[inside] = np.fromiter(map(known.__getitem__, flat), dtype=np.uint32, count=len(flat))
                head, tail = codes < _END_CODE, codes >= _TAIL
                base = np.full(total, -v.base_log)
                base[head] += v.head_log[codes[head]]
                base[ends - 1] += np.log10(v.docs + 0.5)
                have = head.copy()
                have[ends - 1] = v.docs > 0
                words, times = [], []
                first = ends - sizes - 1 - np.arange(len(split))
                where = np.flatnonzero(codes[inside] >= _TAIL)
                bounds = np.searchsorted(where, np.append(first, len(flat)))
                for a, b in zip(bounds, bounds[1:]):
                    tf = Counter(flat[i] for i in where[a:b]) if b > a else {}
                    words.append([w.decode() for w in tf])
                    times.append(list(tf.values()))
                offsets = pa.array(np.append(starts, total) * 4, pa.int64())
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(split), [None, offsets.buffers()[1], pa.py_buffer(codes)]).cast(pa.binary())
                kept = [c for i, c in enumerate(part.columns) if i != place]
                yield pa.record_batch([*kept, packed, pa.array(sizes + 1), pa.array(np.add.reduceat(have.astype(np.int64), starts)),
                                       pa.array(np.add.reduceat(base, starts)), pa.array(words, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))],
                                      names=[*(f.name for f in fields), "codes", "n_tokens", "head_known", "head_base", "words", "times"])

    return stage(rows.mapInArrow(run, schema), "codes")


def _codes(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with the codes of all their rows and the rows' first tokens."""
    for part in slices(batch, column, 2 << 20):
        texts = part.column(column).to_pylist()
        codes = np.frombuffer(b"".join(texts), dtype=np.uint32)
        yield part, codes, np.cumsum([0, *(len(t) // 4 for t in texts[:-1])])


def _gather(codes: DataFrame, model: Model, add: Callable[[Model, list[np.ndarray], np.ndarray, np.ndarray], None], tokens: int) -> list[np.ndarray]:
    """Sums of ``add`` over all rows of a table with one column of codes, for both tables.

    Each task sends the blocks it touched once, so tasks are few enough for the blocks to stay below the codes in size, but as many as there are cores.
    """
    context = codes.sparkSession.sparkContext
    shared = context.broadcast(model)
    cells = sum(w.size for w in model.weights)
    tasks = max(context.defaultParallelism, tokens // cells)
    per_table = -(-len(model.weights[0]) // BLOCK)

    def run(batches):
        m = shared.value
        sums = [np.zeros(w.shape[::-1]) for w in m.weights]
        for batch in batches:
            for _, found, starts in _codes(batch, 0):
                add(m, sums, found, starts)
        for t, table in enumerate(sums):
            for b in range(per_table):
                block = table[:, b * BLOCK:(b + 1) * BLOCK].T
                if block.any():
                    yield pa.record_batch([pa.array([t * per_table + b]), pa.array([block.astype(np.float32).tobytes()], pa.binary())], names=["b", "w"])

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[b] = sums.get(b, 0) + np.frombuffer(w, dtype=np.float32).astype(np.float64)
        for b, w in sums.items():
            yield pa.record_batch([pa.array([b]), pa.array([w.astype(np.float32).tobytes()], pa.binary())], names=["b", "w"])

    blocks = "b long, w binary"
    result = [np.zeros(w.shape, dtype=np.float32) for w in model.weights]
    for r in codes.coalesce(tasks).mapInArrow(run, blocks).repartition("b").mapInArrow(merge, blocks).collect():
        table, at = result[r.b // per_table], r.b % per_table * BLOCK
        table[at:at + BLOCK] = np.frombuffer(r.w, dtype=np.float32).reshape(-1, table.shape[1])
    shared.destroy()
    return result


def train(encoded: DataFrame, vocab: Vocabulary) -> Model:
    """The model of a table ``codes, round``; ``round`` deals the texts to the rounds."""
    model = Model(vocab.mass, vocab.symbol, row_bits(vocab.total))
    if not vocab.total:
        return model
    observed = _gather(encoded.select("codes"), model, Model.observe, vocab.total)
    model.start(observed)
    for r in range(ROUNDS):
        model.step(observed, _gather(encoded.where(F.col("round") == r).select("codes"), model, Model.expect, vocab.total // ROUNDS))
    return model


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row; learns from rows not held out.

    Null and empty texts are the end token alone. Repeated rows are separate texts. Without training rows all words are unknown.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    vocab, counts = vocabulary(rows.where("not held_out").select("text"))
    dealt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)).cast("int").alias("round")
    encoded = encode(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held_out", dealt, "text"), vocab)
    model = train(encoded.where("not held_out"), vocab)
    shared = spark.sparkContext.broadcast(model)
    head_log, bucket_log = vocab.head_log, vocab.bucket_log
    logs = spark.sparkContext.broadcast((head_log, bucket_log))

    def run(batches):
        m, (head_log, bucket_log) = shared.value, logs.value
        for batch in batches:
            for part, codes, starts in _codes(batch, 1):
                symbols = symbols_of(codes, m.head_symbol)
                logs_of = m.log_scores(codes, starts)
                inside = (symbols >= FREQUENT) & (symbols < END)
                logs_of[inside] -= bucket_log[symbols[inside] - FREQUENT]
                counted = inside & (codes < _END_CODE)
                logs_of[counted] += head_log[codes[counted]]
                yield pa.record_batch([*(part.column(i) for i in (0, *range(2, part.num_columns))), pa.array(np.add.reduceat(logs_of, starts))],
                                      names=["rid", "doc_id", "held_out", "n_tokens", "head_known", "head_base", "head_model"])

    kind = docs.schema[id_col].dataType.simpleString()
    heads = encoded.select("rid", "codes", "doc_id", "held_out", "n_tokens", "head_known", "head_base").mapInArrow(
        run, f"rid long, doc_id {kind}, held_out boolean, n_tokens long, head_known long, head_base double, head_model double")
    tails = encoded.select("rid", F.explode(F.arrays_zip("words", "times")).alias("t")).select("rid", F.col("t.words").alias("word"), F.col("t.times").alias("tf"))
    looked = tails.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = looked.groupBy("rid").agg(F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("tail_known"),
                                     F.sum(F.col("tf") * F.log10(F.col("c") + 0.5)).alias("tail_log"))
    all_rows = heads.join(sums, "rid", "left")
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    return all_rows.select("doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
                           F.lit(vocab.total).cast("long").alias("train_tokens"), (F.col("head_base") + tail_log).alias("base_score"),
                           (F.col("head_model") + tail_log).alias("score"))
