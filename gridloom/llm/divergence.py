"""Operator 8, quality rules by distribution divergence.

Each document has two histograms: its characters by class, and its words among its language's
common words (and the rest).  Both are compared with the language's reference, summed over the
corpus, by the Jensen-Shannon distance (square root, base 2, so 0 to 1).  A document is rejected
when it fails the base rule, or when a distance passes its threshold and the text is long enough
for that histogram to mean something (minimum-length guards).

Digits are a class of their own.  Its guard: ``FEW_DIGITS`` of a text, or one to ``LETTERS_A_DIGIT`` letters if
that is more, count as small letters, but no more than it has letters.  So phone and card numbers, years and
prices in a clean text are no other language, and numbers alone are one.
A text under ``CHAR_LEAST`` is too short for all classes, but not for two: it is rejected when its digits
against its other characters between blanks are further than ``DIGIT_LIMIT`` from the language's.

References come from all documents.  A language's class shares are the medians over its documents
(in thousandths, so junk does not bend them); its common words are the ``COMMON_WORDS`` most frequent of
all its words, of any length and in any script.  Both are exact counts, combined per task before the
shuffle and dealt by a hash of the key; the most frequent words are taken in each partition before the
partitions' lists meet.  The driver receives one number per class and the common words of each language,
nothing that grows with the rows.

A word is a run between blanks in small letters, without the punctuation around it, of letters and their
marks (apostrophes and hyphens may stand inside).  Where a script sets no blanks, such a run is a clause
and hardly any is common, so the word distance stays small and only the classes tell.

Nulls, ties and odd input: a null or empty text has no words, fails the base rule and has distance 0; a
document whose lang is null or has no reference is measured against every reference and takes the
nearest; equal word counts are ordered by the word; repeated rows count each; an empty table
gives no rows; further columns are ignored (``keep`` returns them).
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import documents, raw, stored, text_slices

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
COMMON_WORDS = 40
#: thresholds on the two distances and the least length at which each is used
CHAR_LIMIT, CHAR_LEAST = 0.18, 100
#: digits of a text that count as letters, and the threshold on digits alone for texts under CHAR_LEAST
FEW_DIGITS, LETTERS_A_DIGIT, DIGIT_LIMIT = 40, 4, 0.50
WORD_LIMIT, WORD_LEAST = 0.50, 40
#: languages kept as references (the most frequent ones), so the driver's table is bounded
MAX_LANGS = 1000
#: distinct words a task holds before it sends their counts on
HELD_WORDS = 1 << 18

CLASSES = ("lower", "upper", "blank", "break", "stop", "bracket", "symbol", "accented", "wide", "control", "digit")
LOWER, UPPER, BLANK, BREAK, ACCENTED, WIDE, DIGIT = map(CLASSES.index, ("lower", "upper", "blank", "break", "accented", "wide", "digit"))
_WHITE = " \t\n\r\x0b\x0c"
_AROUND = ".,;:!?()[]'\"-" + "¡¿«»‹›„“”‚‘’…–—·،؛؟।。、，．：；！？「」『』（）"
_WIDE_DIGIT = re.compile(r"[^\D0-9]")
_INSIDE = "'’-\u200c\u200d"


def _class_table() -> np.ndarray:
    """Class of each UTF-8 lead byte; continuation bytes have the last, uncounted class."""
    t = np.full(256, CLASSES.index("symbol"))
    t[:32] = t[127] = CLASSES.index("control")
    for chars, name in (("abcdefghijklmnopqrstuvwxyz", "lower"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "upper"), ("0123456789", "digit"),
                        (" \t", "blank"), ("\n\r\x0b\x0c", "break"), (".,;:!?", "stop"), ("()[]'\"-", "bracket")):
        t[[ord(c) for c in chars]] = CLASSES.index(name)
    t[128:192] = len(CLASSES)
    t[192:208] = CLASSES.index("accented")
    t[208:] = CLASSES.index("wide")
    return t


_TABLE = _class_table()


def char_classes(data: bytes) -> np.ndarray:
    by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    out = np.bincount(_TABLE, weights=by_byte, minlength=len(CLASSES) + 1)[:len(CLASSES)]
    if out[WIDE]:  # every decimal digit beyond ASCII is in this class
        n = len(_WIDE_DIGIT.findall(data.decode("utf-8", "replace")))
        out[WIDE] -= n
        out[DIGIT] += n
    return out


def few_as_letters(classes: np.ndarray) -> np.ndarray:
    """The classes with the digits that the guard allows among the small letters."""
    out = classes.copy()
    letters = out[[LOWER, UPPER, ACCENTED, WIDE]].sum()
    n = min(out[DIGIT], letters, max(FEW_DIGITS, letters // LETTERS_A_DIGIT))
    out[DIGIT] -= n
    out[LOWER] += n
    return out


def digits_and_rest(classes: np.ndarray) -> np.ndarray:
    return np.array([classes[DIGIT], classes.sum() - classes[[DIGIT, BLANK, BREAK]].sum()])


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two count vectors; 0 when either is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def kl(a: np.ndarray) -> float:
        on = a > 0
        return float((a[on] * np.log2(a[on] / m[on])).sum())

    return float(np.sqrt(max(0.0, (kl(p) + kl(q)) / 2)))


def words_of(text: str) -> list[str]:
    """The words in small letters, split by the same six blanks as everywhere."""
    words = raw(text.lower()).split()
    return b"\n".join(words).decode("utf-8", "replace").split("\n") if words else []


def bare(words: Counter) -> Counter:
    """Counts of the words without the punctuation around them."""
    out: Counter = Counter()
    for w, n in words.items():
        out[w.strip(_AROUND)] += n
    return out


# ---------------------------------------------------------------- references

def _spoken(word: str) -> bool:
    """Letters of any script and their marks; apostrophes, hyphens and joiners may stand between them."""
    return word.isalpha() or (any(map(str.isalpha, word)) and
                              all(c.isalpha() or c in _INSIDE or unicodedata.category(c)[0] == "M" for c in word))


def _count_rows(shares: Counter, words: dict) -> pa.RecordBatch:
    rows = [(lang, f"class {k}", str(s), n) for (lang, k, s), n in shares.items()]
    for lang, c in words.items():
        rows += [(lang, "word", w, n) for w, n in bare(c).items() if _spoken(w)] + [(lang, "all", "", sum(c.values()))]
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, kinds)],
                                      ["lang", "kind", "what", "n"])


def _reference_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: (lang, kind, what, n): shares per class in thousandths, each word, all words.

    A task whose distinct words pass ``HELD_WORDS`` sends their counts so far and goes on; the sums don't change.
    """
    shares: Counter = Counter()
    words: dict = {}
    for cols, texts in text_slices(batches):
        for lang, text in zip(cols["lang"], texts):
            data = raw(text)
            if lang is None or not data:
                continue
            if len(text) >= CHAR_LEAST:
                classes = few_as_letters(char_classes(data))
                shares.update((lang, k, s) for k, s in enumerate(np.rint(1000 * classes / classes.sum()).astype(int).tolist()))
            words.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, words.values())) > HELD_WORDS:
            yield _count_rows(Counter(), words)
            words = {}
    yield _count_rows(shares, words)


def references(docs: DataFrame) -> dict[str, dict]:
    """lang -> {"chars": median share of each class, "words": common words, "counts": theirs and the rest's}."""
    counts = stored(documents(docs, "lang").select("lang", "text")
                    .mapInArrow(_reference_counts, "lang string, kind string, what string, n long")
                    .groupBy("lang", "kind", "what").agg(F.sum("n").alias("n")), "references")
    classes = (counts.where("kind like 'class %'").withColumn("share", F.col("what").cast("int"))
               .withColumn("upto", F.sum("n").over(Window.partitionBy("lang", "kind").orderBy("share")))
               .withColumn("all", F.sum("n").over(Window.partitionBy("lang", "kind")))
               .where("2 * upto >= all").groupBy("lang", "kind").agg(F.min("share").alias("n"))
               .select("lang", "kind", F.lit("").alias("what"), F.col("n").cast("long").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "what"))
    top = counts.where("kind = 'word'").withColumn("r", rank).where(f"r <= {COMMON_WORDS}").drop("r")
    total = counts.where("kind = 'all'")
    langs = total.orderBy(F.desc("n"), "lang").limit(MAX_LANGS).select("lang")
    rows = classes.unionByName(top).unionByName(total).join(langs, "lang", "left_semi").collect()  # MAX_LANGS * 52 rows at most
    out: dict[str, dict] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], -r["n"], r["what"])):
        ref = out.setdefault(r["lang"], {"chars": np.zeros(len(CLASSES)), "words": [], "counts": []})
        if r["kind"] == "word":
            ref["words"].append(r["what"])
            ref["counts"].append(r["n"])
        elif r["kind"] == "all":
            ref["all"] = r["n"]
        else:
            ref["chars"][int(r["kind"].split()[1])] = r["n"]
    for ref in out.values():
        ref["counts"] = np.array([*ref["counts"], max(0, ref["all"] - sum(ref["counts"]))], float)
    return out


# ---------------------------------------------------------------- documents

def base_features(text: str | None) -> tuple[int, int, int, int, list[bytes]]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words and the words of one text."""
    if not text:
        return 0, 0, 0, 0, []
    words = raw(text).split()
    word_chars = len(text) - sum(map(text.count, _WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(_WHITE)]
    return word_chars, symbols, len(lines) - len(set(lines)), repeat_words(words), words


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, by doubling exact ranks (1, 2, 4, 8 words)."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    code = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    width = 1
    while width < window:
        step = min(width, window - width)
        code = code[:len(code) - step] * (int(code.max()) + 1) + code[step:]
        code = np.unique(code, return_inverse=True)[1]
        width += step
    again = np.bincount(code)[code] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def distances(classes: np.ndarray, counted: Counter, ref: dict) -> tuple[float, float, float]:
    """Distances of a text's classes, of its bare words' counts and of its digits alone."""
    mine = [counted.get(w, 0) for w in ref["words"]]
    return (js_distance(few_as_letters(classes), ref["chars"]),
            js_distance(np.array([*mine, counted.total() - sum(mine)], float), ref["counts"]),
            js_distance(digits_and_rest(classes), digits_and_rest(ref["chars"])))


def _rate(refs: dict[str, dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                 "char_distance", "word_distance", "kept"]
        for cols, texts in text_slices(batches):
            rows = []
            for doc, lang, text in zip(cols["doc_id"], cols["lang"], texts):
                chars, symbols, dup, repeat, words = base_features(text)
                failed = len(words) < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * len(words)
                dc = dw = dd = 0.0
                if words and refs:
                    classes, counted = char_classes(raw(text)), bare(Counter(words_of(text)))
                    measured = [distances(classes, counted, r) for r in ([refs[lang]] if lang in refs else refs.values())]
                    dc, dw, dd = min(measured, key=lambda d: d[0] + d[1])
                odd = (dc > CHAR_LIMIT if chars >= CHAR_LEAST else dd > DIGIT_LIMIT) or (len(words) >= WORD_LEAST and dw > WORD_LIMIT)
                rows.append((doc, len(words), chars, symbols, dup, repeat, failed, dc, dw, not failed and not odd))
            kinds = [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
    return run


def rate(docs: DataFrame) -> DataFrame:
    """One row per document: base features, both distances and the verdict ``kept``."""
    refs = references(docs)
    return documents(docs, "lang").mapInArrow(
        _rate(refs), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                     "base_failed boolean, char_distance double, word_distance double, kept boolean")


def _kept(refs: dict[str, dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = [c.cast(t) for c, t in zip((batch.column("doc_id"), batch.column("lang"), batch.column("text")),
                                              (pa.int64(), pa.string(), pa.string()))]
            verdicts = _rate(refs)(iter([pa.RecordBatch.from_arrays(part, ["doc_id", "lang", "text"])]))
            flags = [x for v in verdicts for x in v.column("kept").to_pylist()]
            yield batch.filter(pa.array(flags, pa.bool_()))
    return run


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    return docs.mapInArrow(_kept(references(docs)), docs.schema)
