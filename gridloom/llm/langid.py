"""Operator 2, language identification by a byte convolutional network.

The lower-cased text's UTF-8 bytes are cut into windows of fixed length; filters of widths 2, 3
and 4 run over every window, each keeps its maximum, and a softmax over the languages follows.  A
filter over one-hot bytes is a sum of table rows, so a batch of windows is a few gathers.  A
document's prediction is the mean of the probabilities of all its windows, the whole text.

Training (numpy, Adam, fixed seed) runs on the driver over at most ``SAMPLE_DOCS`` documents, evenly
per language over the ``SAMPLE_LANGS`` most frequent ones and chosen by a hash of id and text among those with a
lang that are not held out, with at most ``SAMPLE_WINDOWS`` evenly spaced windows each.  Only text and lang are used.

Nulls, ties and odd input: a null text or one without a letter is ``und`` with score 0; equal probabilities
go to the first language by code point; with no labelled training document every text is
``und``; repeated rows are answered each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import documents, held_out, raw, text_slices

SAMPLE_DOCS, SAMPLE_WINDOWS, SAMPLE_LANGS = 2400, 6, 300
STEP, WIDTHS, FILTERS = 256, (4, 3, 2), 16
EPOCHS, BATCH, RATE, SEED = 10, 64, 0.02, 7
_SPAN = STEP + max(WIDTHS) - 1
_LETTER = re.compile(r"[^\W\d_]")


def windows(text: str) -> np.ndarray:
    """(n, span) bytes: consecutive steps of the whole text, zero padded, overlapping by a filter's reach."""
    data = np.frombuffer(raw(text.lower()), np.uint8)
    n = max(1, -(-len(data) // STEP))
    padded = np.zeros(n * STEP + _SPAN - STEP, np.uint8)
    padded[:len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, _SPAN)[::STEP]


class Network:
    """Tables ``t[k]`` hold the k-th byte's weights of every filter at least k + 1 wide; widest filters first."""

    def __init__(self, langs: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.langs = langs
        wide = [sum(FILTERS for w in WIDTHS if w > k) for k in range(max(WIDTHS))]
        self.t = [rng.normal(0, 0.1, (256, n)).astype(np.float32) for n in wide]
        self.out = rng.normal(0, 0.1, (wide[0], len(langs))).astype(np.float32)
        self.bias = np.zeros(len(langs), np.float32)

    def _maps(self, x: np.ndarray) -> np.ndarray:
        maps = self.t[0][x[:, :STEP]]
        for k, t in enumerate(self.t[1:], 1):
            maps[..., :t.shape[1]] += t[x[:, k:k + STEP]]
        return maps

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        pooled = np.concatenate([np.maximum(self._maps(x[i:i + BATCH]).max(1), 0) for i in range(0, len(x), BATCH)])
        z = pooled @ self.out + self.bias
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        params = [*self.t, self.out, self.bias]
        m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), BATCH):
                rows = order[i:i + BATCH]
                xb = x[rows]
                maps = self._maps(xb)
                at = maps.argmax(1)
                top = np.take_along_axis(maps, at[:, None], 1)[:, 0]
                pooled = np.maximum(top, 0)
                z = pooled @ self.out + self.bias
                e = np.exp(z - z.max(1, keepdims=True))
                d = e / e.sum(1, keepdims=True)
                d[np.arange(len(rows)), y[rows]] -= 1
                d /= len(rows)
                back = (d @ self.out.T) * (top > 0)
                grads = []
                for k, t in enumerate(self.t):  # the gradient reaches only the bytes under each maximum
                    g, n = np.zeros_like(t), t.shape[1]
                    byte = np.take_along_axis(xb, at[:, :n] + k, 1)
                    np.add.at(g, (byte, np.arange(n)[None]), back[:, :n])
                    grads.append(g)
                grads += [pooled.T @ d, d.sum(0)]
                step += 1
                for p, g, a, b in zip(params, grads, m, v):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cols, texts in text_slices(batches):
        rows = []
        for doc, lang, text in zip(cols["doc_id"], cols["lang"], texts):
            if text and _LETTER.search(text):
                w = windows(text)
                pick = np.unique(np.linspace(0, len(w) - 1, SAMPLE_WINDOWS).round().astype(int))
                rows.append((doc, lang, w[pick].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 3,
                                          (pa.int64(), pa.string(), pa.binary()))], ["doc_id", "lang", "w"])


def learn(docs: DataFrame, modulus: int = 3) -> Network | None:
    """The network trained on the bounded sample; None when no document may be learnt from."""
    rest = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(modulus))
    known = documents(docs, "lang").where(F.col("lang").isNotNull() & (rest != 1))
    top = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(SAMPLE_LANGS)
    counts = {r["lang"]: r["n"] for r in top.collect()}  # SAMPLE_LANGS rows at most
    if not counts:
        return None
    per = SAMPLE_DOCS // len(counts)
    known = known.where(F.col("lang").isin(*counts))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 1.5 * (per + 8) / n))])
    h = F.xxhash64("doc_id", "text")  # rows that share an id are drawn apart
    near = known.withColumn("h", h).where(F.pmod(F.col("h"), F.lit(1 << 30)) < share[F.col("lang")] * float(1 << 30))
    near = (near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
            .where(f"r <= {per}").select("doc_id", "lang", "text"))
    rows = near.mapInArrow(_sample_windows, "doc_id long, lang string, w binary").collect()  # <= SAMPLE_DOCS x SAMPLE_WINDOWS windows
    if not rows:
        return None
    langs = sorted({r["lang"] for r in rows})
    rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], bytes(r["w"])))
    x = [np.frombuffer(r["w"], np.uint8).reshape(-1, _SPAN) for r in rows]
    y = np.concatenate([np.full(len(w), langs.index(r["lang"])) for w, r in zip(x, rows)])
    net = Network(langs)
    net.train(np.concatenate(x), y)
    return net


def classify(texts: list[str | None], net: Network | None) -> list[tuple[str, float]]:
    """(language, probability) of whole texts; windows of many texts share a batch."""
    out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
    some = [i for i, t in enumerate(texts) if net is not None and t and _LETTER.search(t)]
    for lo in range(0, len(some), 256):
        part = some[lo:lo + 256]
        cut = [windows(texts[i]) for i in part]
        p = net.probabilities(np.concatenate(cut))
        ends = np.cumsum([len(c) for c in cut])
        mean = np.add.reduceat(p, np.r_[0, ends[:-1]], axis=0) / np.diff(np.r_[0, ends])[:, None]
        for i, row in zip(part, mean):
            k = int(row.argmax())
            out[i] = (net.langs[k], float(min(1.0, row[k])))
    return out


def _predict(net: Network | None, modulus: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, texts in text_slices(batches):
            found = classify(texts, net)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols["doc_id"], pa.int64()), pa.array([held_out(d, modulus) for d in cols["doc_id"]]),
                 pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, modulus: int = 3) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    return documents(docs).mapInArrow(_predict(learn(docs, modulus), modulus),
                                      "doc_id long, held_out boolean, lang_pred string, score double")
