"""Operator 10, PII by candidate gradient boosting.

1. Generators with high recall propose spans that may overlap: the base rules' own matches and
   looser shapes (any digit group with separators, dotted numbers, words around ``@`` or a
   spelled-out "at").
2. Each candidate has format features (digits, separators, group lengths, checksums, valid parts) and context
   features (neighbouring characters and cue words); boosted depth-2 trees give a logit per kind.
3. A threshold per kind, calibrated on held-out candidates for a stated precision, selects spans;
   overlaps are settled by probability.  Spans of the base rules are always kept.

Training: labels come from the base rules themselves.  Positives are base matches of a bounded
sample of documents (``SAMPLE_DOCS``, of each ``SAMPLE_WINDOWS`` windows from anywhere in the text, chosen
by a hash of their position) and seeded rewrites of them in shapes the base rules do not
cover (other separators, missing plus sign, spelled-out at and dot); negatives are the sample's
other candidates and rewrites that break the checksum or range, plus dates, versions and amounts
generated from a seed.  Prediction never samples: every whole text is searched.

Nulls, ties and odd input: null and empty texts have no spans; equal starts are ordered by kind as listed;
repeated rows are answered each; an empty table gives no rows (and the model is trained on rewrites
alone); all patterns are linear in the text, so very long texts are searched whole; further columns are
ignored (``redact`` returns them).
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import documents, stored, text_slices

KINDS = ("email", "ip", "card", "phone")
#: bounds of the training sample: documents read for it, windows around digits and at signs used of each, candidates used per kind
SAMPLE_DOCS, SAMPLE_WINDOWS, SAMPLE_CANDIDATES = 2000, 20, 2000
PRECISION, ROUNDS, RATE, SEED = 0.98, 60, 0.3, 11

# Base rules (fixed by the contract).  Look-behinds and possessive runs keep them linear without changing a match.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Loose generators
_LOOSE_AT = re.compile(r"[\w.%+-]{1,64}(?:\s?[(\[{]\s?at\s?[)\]}]\s?|\s?@\s?)[\w-]{1,63}"
                       r"(?:(?:\s?[(\[{]\s?dot\s?[)\]}]\s?|\.)[\w-]{1,63}){1,5}", re.I)
_LOOSE_DOTS = re.compile(r"(?<![0-9.])[0-9]{1,4}(?:[.,][0-9]{1,4}){3}(?![0-9])")
_LOOSE_DIGITS = re.compile(r"(?<![\w+])[+(]{0,2}[0-9](?:[\x20().,/_-]{0,2}[0-9]){6,24}(?!\w)")
_LOOSE_SOLID = re.compile(r"(?<![\w.,/-])[0-9](?:[._-]?[0-9]){12,18}(?![\w])")  # one group between blanks, whatever stands beside it
_CUES = {"email": re.compile(r"mail|e-mail|contact|write", re.I), "ip": re.compile(r"\bip\b|host|addr|server", re.I),
         "card": re.compile(r"card|visa|credit|pay|carte|karte|tarjeta", re.I),
         "phone": re.compile(r"phone|\btel|call|mobile|fax|t[eé]l", re.I)}


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: the local part is the whole run before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            start = at
            while start > end and text[start - 1] in _LOCAL_SET:
                start -= 1
            if start < at:
                yield start, m.end()
                end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base rules, by start then kind."""
    if not text:
        return []
    out = [(a, b, "email") for a, b in _emails(text)]
    if any(d in text for d in "0123456789"):
        out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), m.end(), "card"))
        if "+" in text:
            out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str | None) -> list[tuple[int, int, str]]:
    """Proposed spans of every kind; overlapping ones are allowed."""
    if not text:
        return []
    out = set(base_spans(text))
    if "@" in text or "(" in text or "[" in text or "{" in text:
        for key in ("@", "at"):
            if key == "@" and "@" not in text:
                continue
            for m in re.finditer(re.escape(key), text, re.I):
                if key == "at" and not (text[max(0, m.start() - 2):m.start()].strip()[-1:] in ("(", "[", "{") if m.start() else False):
                    continue
                lo = max(0, m.start() - 80)
                for x in _LOOSE_AT.finditer(text, lo, min(len(text), m.end() + 400)):
                    if x.start() <= m.start() < x.end():
                        out.add((x.start(), x.end(), "email"))
                        break
    if any(d in text for d in "0123456789"):
        out.update((m.start(), m.end(), "ip") for m in _LOOSE_DOTS.finditer(text))
        out.update((m.start(), m.end(), "card") for m in _LOOSE_SOLID.finditer(text))
        for m in _LOOSE_DIGITS.finditer(text):
            n = len(_digits(m.group()))
            if 13 <= n <= 19:
                out.add((m.start(), m.end(), "card"))
            if 7 <= n <= 15:
                out.add((m.start(), m.end(), "phone"))
    return sorted(out)


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format and context features of one candidate."""
    s = text[start:end]
    d = _digits(s)
    groups = [len(g) for g in re.split(r"[^0-9]+", s) if g]
    parts = [g for g in re.split(r"[^0-9]+", s) if g]
    before, after = text[max(0, start - 32):start], text[end:end + 12]
    seps = {c for c in s if not c.isalnum()}
    return [len(s), len(d), len(groups), max(groups, default=0), min(groups, default=0), float(bool(d) and luhn(d)),
            float(len(parts) == 4 and all(int(p) <= 255 for p in parts)), float(s.startswith("+")), float("(" in s), len(seps),
            float("." in s), float("," in s or "/" in s or "_" in s), float("@" in s), float(re.search(r"at", s, re.I) is not None and "@" not in s),
            sum(c.isalpha() for c in s) / len(s), float(before[-1:].isalnum()), float(after[:1].isalnum()),
            float(before[-1:] in "$€£#" if before else False), float(_CUES[kind].search(before) is not None),
            float(any(c in before[-4:] for c in "=\"'/"))]


# ---------------------------------------------------------------- boosting

def _tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int) -> dict | float:
    """Depth-limited regression tree on gradients: every distinct value of a feature is a cut, up to 32 quantiles."""
    total_g, total_h = g[rows].sum(), h[rows].sum()
    leaf = float(-total_g / (total_h + 1.0))
    if depth == 0 or len(rows) < 8:
        return leaf
    best, gain = None, 1e-6
    for f in range(x.shape[1]):
        v = x[rows, f]
        for cut in np.unique(np.quantile(v, np.linspace(0, 1, 33)[1:-1])):
            left = v <= cut
            gl, hl = g[rows][left].sum(), h[rows][left].sum()
            gr, hr = total_g - gl, total_h - hl
            new = gl * gl / (hl + 1) + gr * gr / (hr + 1) - total_g * total_g / (total_h + 1)
            if new > gain and hl > 0.5 and hr > 0.5:
                best, gain = (f, float(cut), left), new
    if best is None:
        return leaf
    f, cut, left = best
    return {"f": f, "cut": cut, "lo": _tree(x, g, h, rows[left], depth - 1), "hi": _tree(x, g, h, rows[~left], depth - 1)}


def _leaf(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, dict):
        return np.full(len(x), tree)
    return np.where(x[:, tree["f"]] <= tree["cut"], _leaf(tree["lo"], x), _leaf(tree["hi"], x))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, depth: int = 2) -> list:
    """Logistic gradient boosting; a list of trees (the first is the prior's logit)."""
    prior = float(np.clip(y.mean(), 0.01, 0.99))
    trees: list = [float(np.log(prior / (1 - prior)))]
    logit = np.full(len(y), trees[0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-logit))
        t = _tree(x, p - y, p * (1 - p), np.arange(len(y)), depth)
        trees.append(t)
        logit += rate * _leaf(t, x)
    return trees


def predict(trees: list, x: np.ndarray, rate: float = RATE) -> np.ndarray:
    logit = np.full(len(x), trees[0]) + rate * sum((_leaf(t, x) for t in trees[1:]), np.zeros(len(x)))
    return 1 / (1 + np.exp(-logit))


def calibrate(p: np.ndarray, y: np.ndarray, precision: float = PRECISION) -> float:
    """Lowest threshold whose held-out precision reaches ``precision``, never under one half."""
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.r_[p[order][1:] != p[order][:-1], True] if len(p) else np.array([], bool)
    good = np.flatnonzero((hit >= precision) & last)
    return max(0.5, float(p[order][good[-1]])) if len(good) else 1.1


def _rewrite(rng: random.Random, kind: str, s: str) -> tuple[str, int]:
    """A seeded rewrite of a base match and its label (1 still personal data, 0 broken)."""
    d = _digits(s)
    if kind == "email":
        local, _, domain = s.partition("@")
        return rng.choice([(f"{local} (at) {domain}", 1), (f"{local}[at]{domain.replace('.', '[dot]')}", 1), (f"{local} @ {domain}", 1),
                           (f"{local} {{at}} {domain.replace('.', ' {dot} ')}", 1)])
    if kind == "ip":
        p = s.split(".")
        return rng.choice([(",".join(p), 0), (".".join([*p[:3], str(rng.randint(256, 999))]), 0),
                           (f"{rng.randint(256, 2999)}.{'.'.join(p[1:])}", 0)])
    if kind == "card":
        cut = rng.choice([" ", "-", ".", "_"])
        if rng.random() < 0.5:
            d = d[:-1] + str((int(d[-1]) + rng.randint(1, 9)) % 10)
            return cut.join(d[i:i + 4] for i in range(0, len(d), 4)) if rng.random() < 0.5 else d, 0
        return cut.join(d[i:i + 4] for i in range(0, len(d), 4)), 1
    d = d[-10:]
    return rng.choice([(f"({d[:3]}) {d[3:6]}-{d[6:]}", 1), (f"{d[:3]}-{d[3:6]}-{d[6:]}", 1), (f"+{d[:1]}.{d[1:4]}.{d[4:]}", 1),
                       (f"{d[:4]}-{d[4:6]}-{d[6:8]}", 0), (d, 0), (f"{d[:3]},{d[3:6]},{d[6:9]}", 0)])


def _seed_examples(rng: random.Random) -> list[tuple[str, int, int, str, int]]:
    """Base-shaped matches made from the seed, so that every kind has examples on any corpus."""
    out = []
    for _ in range(120):
        body = "".join(rng.choices("0123456789", k=15))
        made = {"email": f"{''.join(rng.choices('abcdefghij', k=6))}.{rng.randint(1, 99)}@{''.join(rng.choices('klmnop', k=5))}.example.org",
                "ip": ".".join(str(rng.randint(0, 255)) for _ in range(4)),
                "card": body + next(c for c in "0123456789" if luhn(body + c)),
                "phone": f"+{rng.randint(1, 99)} ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"}
        for kind, s in made.items():
            out.append((f"word {s} word", 5, 5 + len(s), kind, 1))
        for s, kind in ((f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", "phone"),
                        (f"{rng.randint(1, 99)},{rng.randint(100, 999)},{rng.randint(100, 999)}", "phone"),
                        (f"{rng.randint(1, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 999)}.{rng.randint(300, 9999)}", "ip"),
                        (f"x{rng.randint(1, 99)}(at)home.2", "email")):
            out.append((f"word {s} word", 5, 5 + len(s), kind, 0))
    return out


def train(texts: list[str], precision: float = PRECISION, seed: int = SEED) -> dict[str, tuple[list, float]]:
    """kind -> (trees, threshold) from sample texts; one example in five is held out for the threshold."""
    rng = random.Random(seed)
    examples = _seed_examples(rng)
    for text in texts:
        base = set(base_spans(text))
        for a, b, kind in candidates(text):
            examples.append((text[max(0, a - 40):b + 20], min(a, 40), min(a, 40) + b - a, kind, int((a, b, kind) in base)))
    for text, a, b, kind, label in list(examples):
        if label:
            new, y = _rewrite(rng, kind, text[a:b])
            examples.append((text[:a] + new + text[b:], a, a + len(new), kind, y))
    model = {}
    for kind in KINDS:
        mine = [e for e in examples if e[3] == kind]
        rng.shuffle(mine)
        mine = mine[:SAMPLE_CANDIDATES]
        x = np.array([features(t, a, b, kind) for t, a, b, _, _ in mine], float)
        y = np.array([e[4] for e in mine], float)
        aside = np.arange(len(mine)) % 5 == 0
        trees = fit(x[~aside], y[~aside])
        model[kind] = (trees, calibrate(predict(trees, x[aside]), y[aside], precision))
    return model


def find(text: str | None, model: dict[str, tuple[list, float]]) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans) of a text: base spans plus the selected candidates that overlap none kept before."""
    base = base_spans(text)
    known = set(base)
    extra = [c for c in candidates(text) if c not in known]
    if not extra:
        return base, base
    chosen = []
    for kind in KINDS:
        mine = [c for c in extra if c[2] == kind]
        if mine:
            trees, threshold = model[kind]
            p = predict(trees, np.array([features(text, a, b, kind) for a, b, _ in mine], float))
            chosen += [(-q, c) for q, c in zip(p.tolist(), mine) if q >= threshold]
    taken = sorted((a, b) for a, b, _ in base)
    kept = list(base)
    for _, c in sorted(chosen):
        i = bisect.bisect_left(taken, (c[0], c[1]))
        if all(not (a < c[1] and c[0] < b) for a, b in taken[max(0, i - 4):i + 1]):
            kept.append(c)
            bisect.insort(taken, (c[0], c[1]))
    return base, sorted(kept, key=lambda s: (s[0], KINDS.index(s[2])))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def sample_windows(docs: DataFrame) -> list[str]:
    """Windows of at most ``SAMPLE_DOCS`` documents with digits or an at sign, chosen by a hash of the id.

    Of a document with more than ``SAMPLE_WINDOWS`` windows, those with the smallest hash of id and position are taken.
    """
    n = docs.count()  # a share of the ids first, so that no task sends more than its part of the sample
    share = min(1.0, 40 * SAMPLE_DOCS / max(1, n))
    near = documents(docs).withColumn("h", F.xxhash64("doc_id")).where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    hit = near.where(F.col("text").rlike("[0-9@]"))
    windows = F.regexp_extract_all("text", F.lit(r"(?s)(.{0,60}[0-9@].{0,90})"), 1)
    placed = F.transform(windows, lambda w, i: F.struct(F.xxhash64("doc_id", i).alias("p"), i.alias("i"), w.alias("w")))
    taken = F.slice(F.array_sort(placed), 1, SAMPLE_WINDOWS)["w"]
    rows = hit.select("h", "doc_id", taken.alias("w")).orderBy("h", "doc_id").limit(SAMPLE_DOCS).collect()
    return [w for r in rows for w in r["w"]]


def model_for(docs: DataFrame) -> dict[str, tuple[list, float]]:
    """The model trained on the windows of a bounded sample of ``docs``."""
    return train(sample_windows(docs))


def _search(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
        for cols, texts in text_slices(batches):
            rows = []
            for doc, text in zip(cols["doc_id"], texts):
                base, spans = find(text, model)
                n = [sum(s[2] == k for s in base) for k in KINDS]
                rows.append((doc, *n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
    return run


def search(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """doc_id, the base counts, the digest of the base spans and all spans of every document."""
    return documents(docs).mapInArrow(_search(model or model_for(docs)), "doc_id long, n_email long, n_ip long, n_card long, "
                                      "n_phone long, base_sha256 string, spans string")


def _redact(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                if text is not None:
                    parts, at = [], 0
                    for a, b, kind in find(text, model)[1]:
                        if a >= at:
                            parts += [text[at:a], f"<{kind}>"]
                        at = max(at, b)
                    text = "".join([*parts, text[at:]])
                out.append(text)
            i = batch.schema.get_field_index("text")
            yield batch.set_column(i, batch.schema.field(i), pa.array(out, batch.schema.field(i).type))
    return run


def redact(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """``docs`` with every found span replaced by its kind in angle brackets (all other columns as they were)."""
    return docs.mapInArrow(_redact(model or model_for(docs)), docs.schema)
