"""The byte network against plain loops: windows, filters, pooling, softmax, and its gradient against differences."""

import math

import numpy as np

from gridloom.llm import langid


def slow_windows(text):
    data = text.lower().encode()
    n = max(1, math.ceil(len(data) / langid.STEP))
    data = data + b"\0" * (n * langid.STEP + max(langid.WIDTHS) - 1 - len(data))
    return [data[i * langid.STEP:i * langid.STEP + langid.STEP + max(langid.WIDTHS) - 1] for i in range(n)]


def slow_probabilities(net, window):
    filters = [w for w in langid.WIDTHS for _ in range(langid.FILTERS)]
    pooled = []
    for f, w in enumerate(filters):
        best = max(sum(float(net.t[k][window[p + k], f]) for k in range(w)) for p in range(langid.STEP))
        pooled.append(max(best, 0.0))
    z = [sum(p * float(net.out[f, c]) for f, p in enumerate(pooled)) + float(net.bias[c]) for c in range(len(net.langs))]
    e = [math.exp(v - max(z)) for v in z]
    return [v / sum(e) for v in e]


def test_windows_and_probabilities_equal_loops():
    net = langid.Network(["a", "b", "c"], seed=3)
    texts = ["Grüße", "", "x" * langid.STEP, "word " * 120]
    for text in texts:
        slow = slow_windows(text)
        fast = langid.windows(text)
        assert [bytes(w) for w in fast] == slow
        want = np.array([slow_probabilities(net, w) for w in slow])
        assert np.allclose(net.probabilities(fast), want, atol=1e-5)
        if text.strip():
            (lang, score), = langid.classify([text], net)
            assert lang == net.langs[int(want.mean(0).argmax())] and abs(score - want.mean(0).max()) < 1e-5
    assert langid.classify(["", None, "12 34", "."], net) == [("und", 0.0)] * 4


def test_training_step_follows_the_gradient():
    """Adam's first step moves every weight against the sign of its gradient; differences of the loss give the sign."""
    rng = np.random.default_rng(2)
    x = np.concatenate([langid.windows("".join(rng.choice(list("abcdefgh"), 200))) for _ in range(12)])
    y = rng.integers(0, 3, len(x))
    net, moved = langid.Network(["a", "b", "c"], seed=5), langid.Network(["a", "b", "c"], seed=5)

    def loss():
        return -np.log(net.probabilities(x)[np.arange(len(x)), y]).mean()

    for n in (net, moved):  # double precision, so that differences mean something
        n.t = [t.astype(np.float64) for t in n.t]
        n.out, n.bias = n.out.astype(np.float64), n.bias.astype(np.float64)
    moved.train(x, y, epochs=1, rate=1e-3)
    checked = 0
    for before, after in zip([*net.t, net.out, net.bias], [*moved.t, moved.out, moved.bias]):
        used = np.flatnonzero(before.ravel() != after.ravel())
        for at in rng.choice(used, min(12, len(used)), replace=False):
            flat, keep = before.ravel(), before.ravel()[at]
            flat[at] = keep + 1e-6
            high = loss()
            flat[at] = keep - 1e-6
            low = loss()
            flat[at] = keep
            slope = (high - low) / 2e-6
            if abs(slope) > 1e-5:
                assert np.sign(slope) == -np.sign(after.ravel()[at] - keep)
                checked += 1
    assert checked > 30
    unused = (net.t[0] == moved.t[0]).all(1)
    assert unused[ord("z")] and not unused[ord("a")]
