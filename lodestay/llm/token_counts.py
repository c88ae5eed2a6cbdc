"""Token counts by a tokenizer compiled to a deterministic transducer.

For merges by priority, the last token of every prefix of a text is determined: token ``t`` ends a prefix exactly if it is compatible with the last token of the prefix
before it, that is, if the two are what the merges make of their joined text. So a left-to-right transducer exists: its state lists the open
suffixes that may still grow into a token, each with the token before it and the tokens counted since; reading a character emits how
much the number of tokens changes. States and transitions are compiled from the vocabulary when first met and kept.

Where no token holds two neighbouring characters side by side, nothing merges across and the state is the start state again. A
text is cut into chunks that run side by side, one vector step for each character. The map of a chunk with such a reset is constant after it, so maps compose by
copying the last constant exit forward (a prefix scan); chunks without one are run again until each entry is its predecessor's exit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices

LIMIT = 4096
CHUNK = 192
#: Compiled states a worker keeps; beyond, it compiles anew what the next texts need.
MOST_STATES = 120_000
SPACE = "▁"


class Vocabulary:
    """Pieces with their priorities, what the merges make of a short text, and which characters may stand inside a token."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.prefixes = {p[:n] for p in self.score for n in range(1, len(p))}
        self.pairs = {p[i:i + 2] for p in self.score for i in range(len(p) - 1)}
        self.characters = sorted({c for p in self.score for c in p})
        self._fits: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """Highest priority first, leftmost among equals."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, before: str, token: str) -> bool:
        known = self._fits.get((before, token))
        if known is None:
            if len(self._fits) > 1_000_000:
                self._fits.clear()
            alone = not before or (before[-1] + token[0]) not in self.pairs
            known = self._fits[before, token] = self.merge(token) == [token] if alone else self.merge(before + token) == [before, token]
        return known


class Transducer:
    """``counts(texts)``: the number of tokens of each text."""

    def __init__(self, path: str):
        self.vocabulary = v = Vocabulary(path)
        # class 0 separates texts, then the characters of the vocabulary, then others by their length in UTF-8
        self.symbols = len(v.characters) + 5
        self.classes = np.zeros(0x110000, dtype=np.int32)
        for limit, size in ((0x110000, 4), (0x10000, 3), (0x800, 2), (0x80, 1)):
            self.classes[:limit] = len(v.characters) + size
        for k, c in enumerate(v.characters):
            self.classes[ord(c)] = k + 1
        self.classes[ord(" ")] = self.classes[ord(SPACE)]
        self.joins = np.zeros((self.symbols, self.symbols), dtype=bool)
        for pair in v.pairs:
            self.joins[self.classes[ord(pair[0])], self.classes[ord(pair[1])]] = True
        self.forget()

    def forget(self):
        self.number, self.states = {(("", "", 0),): 0}, [(("", "", 0),)]
        self.size, self.used = 1 << 16, 0
        self.keys = np.full(self.size, -1, dtype=np.int64)
        self.target = np.zeros(self.size, dtype=np.int32)
        self.emitted = np.zeros(self.size, dtype=np.int8)

    def _compile(self, state: int, symbol: int) -> tuple[int, int]:
        """The transition: next state, change of the token count."""
        if symbol == 0 or symbol > len(self.vocabulary.characters):
            return 0, max(0, symbol - len(self.vocabulary.characters))
        c, v = self.vocabulary.characters[symbol - 1], self.vocabulary
        for suffix, before, since in self.states[state]:
            if suffix + c in v.score and v.fits(before, suffix + c):
                last, change = suffix + c, 1 - since
                break
        else:
            raise ValueError(f"no token ends at {c!r} in {self.states[state]}")
        grown = tuple((s + c, b, n + change) for s, b, n in self.states[state] if s + c in v.prefixes) + (("", last, 0),)
        if grown not in self.number:
            self.number[grown] = len(self.states)
            self.states.append(grown)
        return self.number[grown], change

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) & (self.size - 1)

    def _insert(self, keys, target, emitted):
        at = self._slot(keys)
        for k, t, e, i in zip(keys.tolist(), target, emitted, at.tolist()):
            while self.keys[i] >= 0:
                i = (i + 1) & (self.size - 1)
            self.keys[i], self.target[i], self.emitted[i] = k, t, e
        self.used += len(keys)

    def _add(self, missing: np.ndarray):
        made = [self._compile(*divmod(k, self.symbols)) for k in missing.tolist()]
        if (self.used + len(made)) * 4 > self.size:
            full = self.keys >= 0
            old = self.keys[full], self.target[full].tolist(), self.emitted[full].tolist()
            while (self.used + len(made)) * 4 > self.size:
                self.size *= 4
            self.keys = np.full(self.size, -1, dtype=np.int64)
            self.target, self.emitted, self.used = np.zeros(self.size, np.int32), np.zeros(self.size, np.int8), 0
            self._insert(*old)
        self._insert(missing, [m[0] for m in made], [m[1] for m in made])

    def step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = states * self.symbols + symbols
        while True:
            at = self._slot(keys)
            held = self.keys[at]
            off = np.flatnonzero(held != keys)
            while len(off):
                off = off[held[off] >= 0]
                at[off] = (at[off] + 1) & (self.size - 1)
                held[off] = self.keys[at[off]]
                off = off[held[off] != keys[off]]
            if (held >= 0).all():
                return self.target[at].astype(np.int64), self.emitted[at]
            self._add(np.unique(keys[held < 0]))

    def _run(self, symbols, resets, starts, ends, entry, changes) -> np.ndarray:
        """Runs lanes from ``starts`` to ``ends``, writes the changes, returns the exit states."""
        state, exits = entry.copy(), entry.copy()
        order = np.argsort(starts - ends, kind="stable")  # longest first: lanes still running are a prefix
        lanes, left, state = starts[order], (ends - starts)[order], state[order]
        for j in range(int(left[0]) if len(left) else 0):
            active = int(np.searchsorted(-left, -j, side="left"))
            at = lanes[:active] + j
            state[:active], changes[at] = self.step(np.where(resets[at], 0, state[:active]), symbols[at])
        exits[order] = state
        return exits

    def counts(self, texts: list[str]) -> np.ndarray:
        if len(self.states) > MOST_STATES:
            self.forget()
        stream = np.frombuffer("".join("\0" + (SPACE + t if t else "") for t in texts).encode("utf-32-le", "replace"), dtype=np.uint32)
        symbols = self.classes[stream].astype(np.int64)
        sizes = np.array([len(t) + 2 if t else 1 for t in texts], dtype=np.int64)
        heads = np.cumsum(sizes) - sizes
        symbols[heads] = 0
        resets = np.ones(len(symbols), dtype=bool)
        resets[1:] = ~self.joins[symbols[:-1], symbols[1:]]
        changes = np.zeros(len(symbols), dtype=np.int8)
        starts = np.arange(0, len(symbols), CHUNK)
        ends = np.minimum(starts + CHUNK, len(symbols))
        at = np.flatnonzero(resets)
        first = at[np.minimum(np.searchsorted(at, starts), len(at) - 1)]
        constant = (first >= starts) & (first < ends)
        exits = np.zeros(len(starts), dtype=np.int64)
        exits[constant] = self._run(symbols, resets, first[constant], ends[constant], exits[constant], changes)
        entry, free = np.full(len(starts), -1), np.flatnonzero(~constant)
        while len(free):
            seen = exits[free - 1]  # the first chunk has a reset at its start
            again = free[entry[free] != seen]
            if not len(again):
                break
            entry[again] = exits[again - 1]
            exits[again] = self._run(symbols, resets, starts[again], ends[again], entry[again], changes)
        head = np.flatnonzero(constant & (first > starts))
        self._run(symbols, resets, starts[head], first[head], exits[head - 1], changes)
        return np.add.reduceat(changes, heads, dtype=np.int64) if len(heads) else np.zeros(0, np.int64)


_transducers: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _transducers:
        _transducers[path] = Transducer(path)
    return _transducers[path]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row. Null and empty texts have no bytes and no tokens."""

    def run(batch):
        machine = transducer(model_path)
        for part in slices(batch, 1):
            counts = machine.counts([t or "" for t in part.column(1).to_pylist()])
            yield pa.record_batch([part.column(0), part.column(2), pa.array(counts)], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(rows, run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
