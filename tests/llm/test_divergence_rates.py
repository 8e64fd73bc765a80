"""Distances and verdicts of whole documents against references and formulas in plain Python."""

import collections
import math
import unicodedata

from gridloom.llm import divergence as dv
from gridloom.sources.tables import read_table
from tests.conftest import SMOKE
from tests.llm.test_models import slow_base


def char_class(c):
    if c.isdecimal():
        return "digit"
    for chars, name in (("abcdefghijklmnopqrstuvwxyz", "lower"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "upper"), (" \t", "blank"),
                        ("\n\r\x0b\x0c", "break"), (".,;:!?", "stop"), ("()[]'\"-", "bracket")):
        if c in chars:
            return name
    n = ord(c)
    return "control" if n < 32 or n == 127 else "symbol" if n < 128 else "accented" if n < 1024 else "wide"


def classes_of(text):
    return collections.Counter(map(char_class, text))


def eased(classes):
    letters = sum(classes[c] for c in ("lower", "upper", "accented", "wide"))
    n = min(classes["digit"], letters, max(40, letters // 4))
    return classes + collections.Counter(lower=n) - collections.Counter(digit=n)


def distance(p, q):
    """Jensen-Shannon distance of two counters over the same names."""
    a, b = sum(p.values()), sum(q.values())
    if not a or not b:
        return 0.0
    total = 0.0
    for name in set(p) | set(q):
        x, y = p.get(name, 0) / a, q.get(name, 0) / b
        for v in (x, y):
            if v:
                total += v * math.log2(2 * v / (x + y)) / 2
    return math.sqrt(max(0.0, total))


def is_word(w):
    return w.isalpha() or (any(map(str.isalpha, w)) and all(
        c.isalpha() or c in "'’-‌‍" or unicodedata.category(c)[0] == "M" for c in w))


def bare_words(text):
    low = text.lower()
    for c in "\t\n\r\v\f":
        low = low.replace(c, " ")
    return [w.strip(dv._AROUND) for w in low.split(" ") if w]


def test_rates_equal_plain_formulas(spark):
    docs = read_table(spark, SMOKE, "documents").toPandas()
    odd = [(10 ** 6, "5551234567 " * 25, "en"), (10 ** 6 + 1, None, "de"), (10 ** 6 + 2, "xq zv " * 60, None), (10 ** 6 + 3, "Ωμέγα και λόγος " * 30, "el")]
    rows = [(d, t, lang) for d, t, lang in zip(docs.doc_id, docs.text, docs.lang)] + odd
    frame = spark.createDataFrame([(int(d), t, lang) for d, t, lang in rows], "doc_id long, text string, lang string")

    shares, words = collections.defaultdict(list), collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        if lang and text:
            words[lang].update(bare_words(text))
            if len(text) >= 100:
                c = eased(classes_of(text))
                shares[lang].append({k: round(1000 * c[k] / sum(c.values())) for k in dv.CLASSES})
    refs = {}
    for lang, counts in words.items():
        median = {k: sorted(s[k] for s in shares[lang])[(len(shares[lang]) - 1) // 2] for k in dv.CLASSES} if shares[lang] else {}
        common = sorted((w for w in counts if is_word(w)), key=lambda w: (-counts[w], w))[:40]
        ref = {w: counts[w] for w in common}
        refs[lang] = (median, common, {**ref, "": counts.total() - sum(ref.values())})

    got = {r.doc_id: r for r in dv.rate(frame).collect()}
    for doc, text, lang in rows:
        n_words, chars, *_, failed = slow_base(text)
        r, text = got[doc], text or ""
        near = (0.0, 0.0, 0.0)
        if n_words:
            c, w = classes_of(text), collections.Counter(bare_words(text))
            measured = []
            for median, common, ref in ([refs[lang]] if lang in refs else refs.values()):
                mine = {x: w[x] for x in common}
                digits = lambda k: {"d": k.get("digit", 0), "r": sum(v for x, v in k.items() if x not in ("digit", "blank", "break"))}
                measured.append((distance(eased(c), median), distance({**mine, "": w.total() - sum(mine.values())}, ref), distance(digits(c), digits(median))))
            near = min(measured, key=lambda d: d[0] + d[1])
        assert abs(r.char_distance - near[0]) < 1e-9 and abs(r.word_distance - near[1]) < 1e-9, doc
        off = (near[0] > 0.18 if chars >= 100 else near[2] > 0.5) or (n_words >= 40 and near[1] > 0.5)
        assert r.kept == (not failed and not off), doc
    assert 0.5 < sum(r.kept for r in got.values()) / len(got) < 1 and not got[10 ** 6].kept
