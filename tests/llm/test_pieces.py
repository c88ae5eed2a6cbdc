"""Work arrays of the language model stay small, and its sums and scores are those of whole batches."""

import numpy as np

from lodestay.llm import language_model as lm


def test_logits_are_made_for_few_tokens_at_a_time(monkeypatch):
    rng, n, bits = np.random.default_rng(3), 5000, 10
    codes = rng.integers(0, 3000, n).astype(np.uint32)
    starts = np.arange(0, n, 50)
    codes[starts[1:] - 1] = lm._END_CODE
    head = np.concatenate([np.arange(lm.FREQUENT), lm.FREQUENT + rng.integers(0, lm.BUCKETS, 3000 - lm.FREQUENT)])
    model = lm.Model(rng.random(lm.SYMBOLS) * 100, head, bits)
    for w in model.weights:
        w += rng.normal(0, 0.5, w.shape).astype(np.float32)
    symbols = lm.symbols_of(codes, head)
    rows, inner_rows = model.features(codes, symbols, starts)
    top, inner = model.chances(symbols, rows, inner_rows)
    own = symbols // lm.PER_CLASS, symbols % lm.PER_CLASS
    seen, expected = ([np.zeros((lm.CLASSES, 1 << bits)), np.zeros((lm.PER_CLASS, 1 << bits))] for _ in range(2))
    for sums, chances, places, which in zip(range(2), (top, inner), (rows, inner_rows), own):
        for r in places:
            for token in range(n):
                seen[sums][which[token], r[token]] += 1
                expected[sums][:, r[token]] += chances[token]

    held, softmaxed = [], np.exp
    monkeypatch.setattr(lm.np, "exp", lambda x, **more: (held.append(len(x)), softmaxed(x, **more))[1])
    scores, observed, expects = model.log_scores(codes, starts), [np.zeros(w.shape[::-1]) for w in model.weights], [np.zeros(w.shape[::-1]) for w in model.weights]
    model.observe(observed, codes, starts)
    model.expect(expects, codes, starts)
    i = np.arange(n)
    assert np.array_equal(scores, np.log10(np.maximum(top[i, own[0]].astype(float) * inner[i, own[1]], 1e-30)))
    assert all(np.array_equal(a, b) for a, b in zip(observed, seen))
    assert all(np.allclose(a, b, rtol=1e-9) for a, b in zip(expects, expected))
    assert held and max(held) <= 2048
