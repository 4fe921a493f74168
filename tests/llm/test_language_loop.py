"""The language network's forward pass against a plain loop over bytes."""
import math

import numpy as np

from martkit.llm.language_id import HIDDEN, WINDOW, Model, pooled


def squash(x):
    return x / (1 + abs(x))


def run(model, d, data):
    """Hidden states of one direction, one byte at a time."""
    h, out = [0.0] * HIDDEN, []
    for byte in data:
        def gate(i):
            inner = sum(model.u[d, i, j] * h[j] for j in range(HIDDEN))
            return model.wx[d, i, byte] + model.b[d, i, 0], inner
        z = [0.5 * (squash(sum(gate(i))) + 1) for i in range(HIDDEN)]
        r = [0.5 * (squash(sum(gate(HIDDEN + i))) + 1) for i in range(HIDDEN)]
        n = []
        for i in range(HIDDEN):
            a, inner = gate(2 * HIDDEN + i)
            n.append(squash(a + r[i] * inner))
        h = [(1 - z[i]) * n[i] + z[i] * h[i] for i in range(HIDDEN)]
        out.append(h)
    return out


def loop(model, data):
    """Mean class probabilities over the positions of ``data``, a window at a time."""
    total = np.zeros(len(model.langs))
    for at in range(0, len(data), WINDOW):
        part = data[at:at + WINDOW]
        ahead, back = run(model, 0, part), run(model, 1, part[::-1])[::-1]
        for a, b in zip(ahead, back):
            score = [sum(model.wo[c, :HIDDEN] @ np.array(a) + model.wo[c, HIDDEN:] @ np.array(b) + model.bo[c])
                     for c in range(len(model.langs))]
            e = [math.exp(s - max(score)) for s in score]
            total += np.array(e) / sum(e)
    return total / max(len(data), 1)


def test_forward_pass_equals_a_plain_loop():
    rng = np.random.default_rng(4)
    model = Model(["a", "b", "c"], *[rng.normal(0, 0.5, s).astype(np.float32) for s in (
        (2, 3 * HIDDEN, 256), (2, 3 * HIDDEN, HIDDEN), (2, 3 * HIDDEN, 1), (3, 2 * HIDDEN), (3, 1))])
    texts = [b"", b"x", b"one short text", bytes(rng.integers(32, 122, WINDOW)), bytes(rng.integers(97, 122, 3 * WINDOW + 7)),
             "ñé ü".encode()]
    got = pooled(model, texts)
    want = np.array([loop(model, t.lower()) for t in texts])
    assert np.allclose(got, want, atol=1e-5)
