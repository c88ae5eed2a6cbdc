"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into lanes of equal length that run side by side. One network reads forwards, one backwards; at every byte both states give
probabilities of the languages, and a document's probability is the mean over all its bytes. The network is trained by backpropagation through
time on windows of a bounded sample of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import LETTER, lean, slices

UNKNOWN = "und"
#: Training windows for each language, and their length in characters.
SAMPLE, WINDOW = 300, 160
HIDDEN, LANE, STEPS, BATCH, SPAN, RATE = 8, 96, 160, 96, 48, 0.02


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, -1, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Network:
    """Weights of both directions are stacked, so one product serves both. Gates: update, reset, candidate."""

    def __init__(self, languages: list[str], seed: int = 3):
        random, h = np.random.default_rng(seed), HIDDEN
        self.languages = languages
        self.p = {"bytes": random.normal(0, 0.3, (2, 256, 3 * h)), "gates": random.normal(0, 0.3, (2, h, 2 * h)), "state": random.normal(0, 0.3, (2, h, h)),
                  "out": random.normal(0, 0.3, (2 * h, len(languages))), "bias": np.zeros(len(languages))}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _step(self, byte: np.ndarray, state: np.ndarray):
        h, p = HIDDEN, self.p
        x = np.stack([p["bytes"][0][byte[0]], p["bytes"][1][byte[1]]])
        gates = _sigmoid(x[..., : 2 * h] + state @ p["gates"])
        update, reset = gates[..., :h], gates[..., h:]
        candidate = np.tanh(x[..., 2 * h:] + (reset * state) @ p["state"])
        return update, reset, candidate, state + update * (candidate - state)

    def states(self, lanes: np.ndarray, keep: bool = False):
        """States at every byte, (2, length, lanes, hidden), the second direction in reading order of the text; ``keep`` adds the gates."""
        length, n = lanes.shape
        both = np.stack([lanes, lanes[::-1]])
        out, state, kept = np.empty((2, length, n, HIDDEN), dtype=np.float32), np.zeros((2, n, HIDDEN), dtype=np.float32), []
        for t in range(length):
            update, reset, candidate, after = self._step(both[:, t], state)
            if keep:
                kept.append((state, update, reset, candidate))
            state = after
            out[0, t], out[1, length - 1 - t] = state[0], state[1]
        return out, both, kept

    def probabilities(self, lanes: np.ndarray) -> np.ndarray:
        """(length, lanes, languages)"""
        s, _, _ = self.states(lanes)
        logits = s[0] @ self.p["out"][:HIDDEN]
        logits += s[1] @ self.p["out"][HIDDEN:]
        logits += self.p["bias"]
        del s
        logits -= logits.max(axis=-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=-1, keepdims=True)
        return logits

    def gradients(self, lanes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over all positions."""
        p, h = self.p, HIDDEN
        s, both, kept = self.states(lanes, keep=True)
        length, n = lanes.shape
        logits = s[0] @ p["out"][:h] + s[1] @ p["out"][h:] + p["bias"]
        logits -= logits.max(axis=-1, keepdims=True)
        error = np.exp(logits)
        error /= error.sum(axis=-1, keepdims=True)
        error[:, np.arange(n), labels] -= 1
        error /= length * n
        g = {k: np.zeros_like(v) for k, v in p.items()}
        flat = error.reshape(-1, error.shape[-1])
        g["bias"] = flat.sum(axis=0)
        g["out"] = np.vstack([s[d].reshape(-1, h).T @ flat for d in (0, 1)])
        into = np.stack([error @ p["out"][:h].T, (error @ p["out"][h:].T)[::-1]])
        carried = np.zeros((2, n, h), dtype=np.float32)
        for t in range(length - 1, -1, -1):
            before, update, reset, candidate = kept[t]
            d = carried + into[:, t]
            d_candidate = d * update * (1 - candidate ** 2)
            d_update = d * (candidate - before) * update * (1 - update)
            through = d_candidate @ p["state"].transpose(0, 2, 1)
            d_reset = through * before * reset * (1 - reset)
            d_gates = np.concatenate([d_update, d_reset], axis=-1)
            g["state"] += (reset * before).transpose(0, 2, 1) @ d_candidate
            g["gates"] += before.transpose(0, 2, 1) @ d_gates
            d_x = np.concatenate([d_gates, d_candidate], axis=-1)
            for k in (0, 1):
                np.add.at(g["bytes"][k], both[k, t], d_x[k])
            carried = d * (1 - update) + through * reset + d_gates @ p["gates"].transpose(0, 2, 1)
        return g

    def train(self, windows: list[bytes], labels: np.ndarray, seed: int = 5):
        """Adam over random spans of the windows."""
        random = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for step in range(1, STEPS + 1):
            picked = random.integers(0, len(windows), BATCH)
            lanes = np.zeros((SPAN, BATCH), dtype=np.uint8)
            for j, i in enumerate(picked):
                w = windows[i]
                at = int(random.integers(0, max(1, len(w) - SPAN)))
                piece = np.frombuffer(w[at:at + SPAN], dtype=np.uint8)
                lanes[: len(piece), j] = piece
            for k, g in self.gradients(lanes, labels[picked]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                self.p[k] -= RATE * (1 - step / (STEPS + 20)) * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)

    def label(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Best language and its probability for texts that are not empty."""
        sizes = np.array([len(t) for t in texts])
        lanes_of = -(-sizes // LANE)
        data = np.frombuffer(b"".join(t + bytes(-len(t) % LANE) for t in texts), dtype=np.uint8).reshape(-1, LANE)
        real = np.full(len(data), LANE)
        ends = np.cumsum(lanes_of) - 1
        real[ends] -= lanes_of * LANE - sizes
        sums = np.empty((len(data), len(self.languages)))
        for at in range(0, len(data), 4096):
            chances = self.probabilities(np.ascontiguousarray(data[at:at + 4096].T))
            inside = np.arange(LANE)[:, None] < real[at:at + 4096]
            sums[at:at + 4096] = np.einsum("tnl,tn->nl", chances, inside.astype(np.float32))
        pooled = np.add.reduceat(sums, ends - lanes_of + 1, axis=0) / sizes[:, None]
        best = pooled.argmax(axis=1)
        return best, np.clip(pooled[np.arange(len(best)), best], 0, 1)


def fit(training: DataFrame, sample: int = SAMPLE) -> Network | None:
    """From ``id, text, lang``: windows at hashed places of the ``sample`` texts of each language whose hash is smallest. None without rows."""
    place = F.pmod(F.xxhash64("id"), F.greatest(F.length("text") - WINDOW, F.lit(1))).cast("int") + 1
    windows = training.where("lang is not null and text rlike '[A-Za-z\\u00C0-\\uFFFF]'").select(
        "lang", F.xxhash64("id", F.lit(1)).alias("rank"), F.substring("text", place, F.lit(WINDOW)).alias("piece"))
    nth = F.row_number().over(W.partitionBy("lang").orderBy("rank", "piece"))
    rows = windows.withColumn("nth", nth).where(F.col("nth") <= sample).select("lang", "piece").collect()
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    rows.sort(key=lambda r: (r.lang, r.piece))
    network = Network(languages)
    network.train([r.piece.lower().encode("utf-8", "replace") for r in rows], np.array([languages.index(r.lang) for r in rows]))
    return network


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rest: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, and a struct ``rest`` of the columns named there; learns from rows not held out.

    Null texts and texts without a letter are ``und`` with score 0, as is everything if no row can be learned from.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"), F.struct(F.lit(1).alias("_"), *[F.col(c) for c in rest]).alias("rest"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(rows.where("not held").select("id", "text", "lang")))

    def run(batches):
        network = shared.value
        for batch in batches:
            for part in slices(batch, 2, 2 << 20):
                texts = part.column(2).to_pylist()
                some = [i for i, t in enumerate(texts) if network and t and LETTER.search(t)]
                found, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                if some:
                    best, chance = network.label([texts[i].lower().encode("utf-8", "replace") for i in some])
                    scores[some] = chance
                    for i, b in zip(some, best.tolist()):
                        found[i] = network.languages[b]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(found, pa.string()), pa.array(scores), part.column(3)],
                                      names=["doc_id", "held_out", "lang_pred", "score", "rest"])

    given = rows.select("id", "held", "text", "rest")
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, lang_pred string, score double, rest {given.schema['rest'].dataType.simpleString()}"
    return given.mapInArrow(lean(run), schema).select("doc_id", "held_out", "lang_pred", "score", *(["rest"] if rest else []))
