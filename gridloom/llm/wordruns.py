r"""Operator 13, periodic run detection on a Re-Pair grammar of the word ids.

Words are ``[^\x20\x09-\x0D]+``.  A run is a stretch of words with smallest period q and at
least max(``least``, ``repeats`` * q) words that no neighbouring word extends with that
period.  A word is dropped if a run holds it after the run's first q words.

Documents are independent rows; a task takes them in slices of bounded text and works on all
documents of a slice at once:

* Re-Pair.  Words become ids that no other document shares.  Each round counts all adjacent
  pairs and replaces those that occur at least twice in their document, the more frequent
  pair first where two overlap, until no pair occurs twice.  What is left of a document is
  joined by a balanced tree.  The places where a pair is replaced are all derivation
  positions of its nonterminal.
* Boundary runs, once per nonterminal, on its first position.  A run of period p across the
  boundary m repeats the eight words from m or up to m at distance p (its equal stretch has
  at least max(2p, 24 - p) >= 16 places and holds m or m - p), so candidate periods are the
  distances between equal eight-word grams.  Candidates are extended exactly, clipped to the
  nonterminal; multiples of a period found are skipped.
* Translation.  Every run is shifted to all derivation positions.  The lowest nonterminal
  that holds a run whole finds it whole, so merging keeps the intervals that no other of
  their period contains, and drops those whose smallest period is a proper divisor.

Memory is about 300 bytes for each word of a slice (``common`` cuts slices at 4 MB of text;
a longer text is a slice alone).

Nulls, ties and odd input: a null, empty or blank text has no words, no run and an empty
collapsed text; runs may overlap and nest, each is reported; a null doc_id is kept and reads
as the empty text where the id is hashed; repeated rows give equal results; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import documents, raw, text_ranges

LEAST, REPEATS = 24, 3
_GRAM = 8


# -- words and ids -----------------------------------------------------------------------

def words_of(texts: pa.Array) -> pa.ListArray:
    """The words of each text; a text without words gives one empty word (see ``word_ids``)."""
    return pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))


def word_ids(words: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(ids that documents do not share, number of words of each document)."""
    flat = words.flatten()
    coded = flat.dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64)
    counts = np.diff(words.offsets.to_numpy()).astype(np.int64)
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not real.all():  # the one empty word of a text without words
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[real], minlength=len(counts))
        ids = ids[real]
    return pd.factorize(np.repeat(np.arange(len(counts)), counts) * len(coded.dictionary) + ids)[0].astype(np.int64), counts


# -- grammar -----------------------------------------------------------------------------

def grammar(ids: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(symbol, begin, middle, end) of every derivation position of nonterminals of ``least`` words or more.

    ``ids`` must not be shared between documents, so no pair across two documents occurs twice.
    """
    found, rest = [], []
    sym, beg = ids, np.arange(len(ids))
    end, own, fresh = beg + 1, doc, int(ids.max()) + 1 if len(ids) else 0
    while len(sym) > 1:
        code, pairs = pd.factorize((sym[:-1] << 32) | sym[1:])
        same = sym[:-1] == sym[1:]
        usable = np.ones(len(code), bool)
        if same.any():  # x x x holds one replaceable pair: every other place of such a stretch counts
            at = np.arange(len(code))
            first = np.maximum.accumulate(np.where(same & ~np.concatenate([[False], same[:-1]]), at, 0))
            usable = ~same | ((at - first) % 2 == 0)
        often = np.bincount(code[usable], minlength=len(pairs))
        usable &= often[code] >= 2
        busy = np.zeros(int(doc[-1]) + 1, bool)
        busy[own[:-1][usable]] = True
        stays = busy[own]
        if not stays.all():  # documents without a repeated pair are done
            rest.append((beg[~stays], end[~stays], own[~stays]))
            if not stays.any():
                sym = sym[:0]
                break
            pair_stays = stays[:-1] & stays[1:]
            edge = stays[:-1] & ~stays[1:]  # the pair of a staying symbol and a leaving one becomes a pair of two staying ones
            keep = pair_stays | edge
            code, usable = code[keep], usable[keep] & pair_stays[keep]
            sym, beg, end, own = sym[stays], beg[stays], end[stays], own[stays]
            code, usable = code[:len(sym) - 1], usable[:len(sym) - 1]
        rank = np.where(usable, often[code] * (len(pairs) + 1) - code, -1)
        wins = usable & (rank > np.concatenate([[-1], rank[:-1]])) & (rank > np.concatenate([rank[1:], [-1]]))
        wins &= np.bincount(code[wins], minlength=len(pairs))[code] >= 2
        at = np.flatnonzero(wins)
        made, names = pd.factorize(code[at])
        sym = sym.copy()
        end = end.copy()
        sym[at] = fresh + made
        end[at] = end[at + 1]
        long = end[at] - beg[at] >= least
        found.append((sym[at][long], beg[at][long], beg[at + 1][long], end[at][long]))
        fresh += len(names)
        left = np.ones(len(sym), bool)
        left[at + 1] = False
        sym, beg, end, own = sym[left], beg[left], end[left], own[left]
    if len(sym):
        rest.append((beg, end, own))
    if not rest:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    beg, end, own = (np.concatenate(x) for x in zip(*rest))
    order = np.argsort(beg, kind="stable")
    beg, end, own = beg[order], end[order], own[order]
    while True:  # balanced tree over what is left of each document
        firsts = np.searchsorted(own, own)
        even = (np.arange(len(own)) - firsts) % 2 == 0
        at = np.flatnonzero(even[:-1] & (own[:-1] == own[1:]))
        if not len(at):
            break
        long = end[at + 1] - beg[at] >= least
        found.append((fresh + np.flatnonzero(long), beg[at][long], beg[at + 1][long], end[at + 1][long]))
        fresh += len(at)
        end = end.copy()
        end[at] = end[at + 1]
        left = np.ones(len(own), bool)
        left[at + 1] = False
        beg, end, own = beg[left], end[left], own[left]
    return tuple(np.concatenate(x) for x in zip(*found)) if found else tuple(np.zeros(0, np.int64) for _ in range(4))


# -- runs --------------------------------------------------------------------------------

def grams(ids: np.ndarray) -> np.ndarray:
    """Id of the eight words from each place, equal for equal words only; the last seven places have ids of their own."""
    g, step = ids, 1
    while step < _GRAM:
        pair = (g[:-step] << 32) | g[step:] if len(g) > step else np.zeros(0, np.int64)
        g = pd.factorize(pair)[0].astype(np.int64)
        step *= 2
    top = int(g.max()) + 1 if len(g) else 0
    return np.concatenate([g, top + np.arange(len(ids) - len(g))])


def _equal_ahead(ids: np.ndarray, a: int, b: int, stop: int) -> int:
    """How many places from a and b > a on are equal, b staying below ``stop``."""
    n, step = 0, 64
    while b + n < stop:
        m = min(step, stop - b - n)
        off = np.flatnonzero(ids[a + n:a + n + m] != ids[b + n:b + n + m])
        if len(off):
            return n + int(off[0])
        n, step = n + m, step * 2
    return n


def _equal_behind(ids: np.ndarray, a: int, b: int, stop: int) -> int:
    """How many places before a and b > a are equal, a staying at ``stop`` or above."""
    n, step = 0, 64
    while a - n > stop:
        m = min(step, a - n - stop)
        off = np.flatnonzero(ids[a - n - m:a - n] != ids[b - n - m:b - n])
        if len(off):
            return n + m - 1 - int(off[-1])
        n, step = n + m, step * 2
    return n


def candidates(ids: np.ndarray, beg: np.ndarray, mid: np.ndarray, end: np.ndarray, repeats: int) -> tuple[np.ndarray, ...]:
    """(node, period, place) by node and period: places where the word equals the one a period later, at m or m - period."""
    g, n = grams(ids), len(ids)
    often = np.flatnonzero(np.bincount(g, minlength=1)[g] >= 2)
    empty = tuple(np.zeros(0, np.int64) for _ in range(3))
    if not len(often):
        return empty
    table = np.sort(g[often] * n + often)
    found = []
    for shift in (0, _GRAM - 1):
        base = mid - shift
        use = np.flatnonzero((base >= beg) & (base + _GRAM <= end))
        base, b, e = base[use], beg[use], end[use]
        reach = (e - b) // repeats
        key = g[base] * n
        lo = np.searchsorted(table, key + np.maximum(b, base - reach))
        hi = np.searchsorted(table, key + np.minimum(e - _GRAM, base + reach), "right")
        many = np.maximum(hi - lo, 0)
        node = np.repeat(np.arange(len(use)), many)
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
        other = table[at] - key[node]
        p = np.abs(other - base[node])
        place = np.minimum(other, base[node]) + shift
        ok = p > 0
        found.append((use[node[ok]], p[ok], place[ok]))
    node, p, place = (np.concatenate(x) for x in zip(*found))
    # an equal stretch of 2p places reaches p places on or back from here, so a far gram must agree as well
    far, back = np.minimum(place + p - (_GRAM - 1), n - 1), place - p
    on = g[np.maximum(far, 0)] == g[np.minimum(far + p, n - 1)]
    behind = (back >= 0) & (g[np.maximum(back, 0)] == g[place])
    ok = (p < _GRAM) | (on & (far + p < n)) | behind
    node, p, place = node[ok], p[ok], place[ok]
    order = np.lexsort((place, p, node))
    return node[order], p[order], place[order]


def boundary_runs(ids: np.ndarray, beg: np.ndarray, mid: np.ndarray, end: np.ndarray,
                  least: int, repeats: int) -> list[tuple[int, int, int, int]]:
    """(node, start, end, period) of the runs across each node's boundary, clipped to the node."""
    out, last, mine = [], -1, []
    for node, p, place in zip(*(x.tolist() for x in candidates(ids, beg, mid, end, repeats))):
        if node != last:
            last, mine = node, []
        if any(p % q == 0 and s <= place and place + p < e for s, e, q in mine):
            continue
        s = place - _equal_behind(ids, place, place + p, int(beg[node]))
        e = place + p + _equal_ahead(ids, place, place + p, int(end[node]))
        if e - s >= max(least, repeats * p):
            mine.append((s, e, p))
            out.append((node, s, e, p))
    return out


def merged(intervals: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Maximal (start, end, period) of one document by start and period, smallest periods only."""
    by_period: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for p, s, e in sorted({(p, s, -e) for s, e, p in intervals}):
        if not by_period[p] or -e > by_period[p][-1][1]:
            by_period[p].append((s, -e))
    out = []
    for p, spans in by_period.items():
        divisors = [q for q in by_period if q < p and p % q == 0]
        for s, e in spans:
            inside = False
            for q in divisors:
                k = bisect_right(by_period[q], (s, 1 << 62)) - 1
                inside = inside or (k >= 0 and by_period[q][k][1] >= e)
            if not inside:
                out.append((s, e, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(ids: np.ndarray, counts: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> dict[int, list[tuple[int, int, int]]]:
    """document -> its runs (start, end, period) by word number, for documents that have one."""
    starts = np.cumsum(counts) - counts
    long = counts >= least
    if not long.any():
        return {}
    doc = np.repeat(np.arange(len(counts)), counts)
    if not long.all():  # shorter documents have no run
        keep = long[doc]
        ids, doc = pd.factorize(ids[keep])[0].astype(np.int64), doc[keep]
        starts = np.cumsum(np.where(long, counts, 0)) - np.where(long, counts, 0)
    sym, beg, mid, end = grammar(ids, doc, least)
    if not len(sym):
        return {}
    order = np.lexsort((beg, sym))
    sym, beg, mid, end = sym[order], beg[order], mid[order], end[order]
    heads = np.flatnonzero(np.concatenate([[True], sym[1:] != sym[:-1]]))
    tails = np.append(heads[1:], len(sym))
    by_doc: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for node, s, e, p in boundary_runs(ids, beg[heads], mid[heads], end[heads], least, repeats):
        first, size, begin = int(beg[heads[node]]), e - s, s
        owner = int(doc[first])
        offset = begin - first - int(starts[owner])
        by_doc[owner] += [(b + offset, b + offset + size, p) for b in beg[heads[node]:tails[node]].tolist()]
    return {d: merged(spans) for d, spans in by_doc.items()}


# -- DataFrames --------------------------------------------------------------------------

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _detect(least: int, repeats: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_ranges(batch.column("text")):
                texts = batch.column("text").slice(a, b - a)
                words = words_of(texts)
                ids, counts = word_ids(words)
                found = runs_of(ids, counts, least, repeats)
                collapsed = pc.binary_join(words, " ")
                if found:
                    new = {d: _collapse(texts[d].as_py(), spans) for d, spans in found.items()}
                    swap = np.zeros(len(counts), bool)
                    swap[list(new)] = True
                    collapsed = pc.replace_with_mask(collapsed, pa.array(swap), pa.array([new[d] for d in sorted(new)], pa.string()))
                runs = [[{"start": s, "length": e - s, "period": p} for s, e, p in found.get(d, ())] for d in range(b - a)] \
                    if found else [[]] * (b - a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(counts), pa.array(runs, _RUNS), collapsed],
                    ["doc_id", "n_words", "runs", "collapsed"])
    return run


def _collapse(text: str, spans: list[tuple[int, int, int]]) -> str:
    words = raw(text).split()
    kept = np.ones(len(words), bool)
    for s, e, p in spans:
        kept[s + p:e] = False
    return b" ".join(w for w, k in zip(words, kept.tolist()) if k).decode("utf-8", "surrogatepass")


def find_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): every row with its runs (start, length, period) and its text without the repeats.

    ``least`` must be 24 or more and ``repeats`` 3 or more: the candidate search rests on both.
    """
    if least < 3 * _GRAM or repeats < 3:
        raise ValueError("least must be 24 or more, repeats 3 or more")
    return documents(docs).mapInArrow(
        _detect(least, repeats),
        "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find_runs``: the run of greatest exponent (earliest start, smallest period) and hashes."""
    none = F.expr("CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>)")
    best = F.aggregate("runs", none, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


def _repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        swap, new = np.zeros(len(ids), bool), []
        for i, doc_id in enumerate(ids):
            h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
            if h % 10 == 0:
                words = raw(texts[i].as_py()).split()
                n, g = len(words), h // 10
                if n:
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
                    swap[i] = True
                    new.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        out = pc.replace_with_mask(texts, pa.array(swap), pa.array(new, pa.string())) if new else texts
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), out], ["doc_id", "text"])


def with_repeats(docs: DataFrame) -> DataFrame:
    """The query's input: documents, about one in ten with a tail of repeated words as the contract lays down."""
    return documents(docs).mapInArrow(_repeat, "doc_id long, text string")


#: crc32 of a text of ASCII characters, the table made from the polynomial
CRC_SQL = """
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_of_byte)"""

ORACLE_SQL = "WITH" + CRC_SQL + r""",
d AS (
  SELECT doc_id, row_number() OVER () AS row_no, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(coalesce(doc_id::VARCHAR, '')) + 1),
          lambda k: ascii(substr(doc_id::VARCHAR, k::INT, 1))::BIGINT)),
        lambda c, b: xor(c >> 8, crc_of_byte[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM documents, crc_table),
g AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
t AS (
  SELECT doc_id, row_no, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
    CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM p),
x AS (SELECT row_no, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM t),
s AS (
  SELECT l.row_no, l.i, r.i - l.i AS q, l.i - row_number() OVER (PARTITION BY l.row_no, r.i - l.i ORDER BY l.i) AS island
  FROM x l JOIN x r ON l.row_no = r.row_no AND l.word = r.word AND r.i > l.i
  JOIN t ON t.row_no = l.row_no WHERE 3 * (r.i - l.i) <= len(t.w)),
c AS (
  SELECT row_no, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY row_no, q, island
  HAVING count(*) + q >= greatest(24, 3 * q)),
r AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c k WHERE k.row_no = c.row_no AND k.q < c.q AND c.q % k.q = 0
      AND k.start <= c.start AND k.start + k.length >= c.start + c.length)),
m AS (
  SELECT row_no, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines FROM r GROUP BY row_no),
b AS (SELECT DISTINCT ON (row_no) row_no, start, length, q FROM r ORDER BY row_no, length::DOUBLE / q DESC, start, q),
o AS (SELECT DISTINCT row_no, unnest(range(start + q, start + length)) AS i FROM r),
k AS (SELECT x.row_no, string_agg(word, ' ' ORDER BY x.i) AS kept FROM x ANTI JOIN o ON x.row_no = o.row_no AND x.i = o.i GROUP BY x.row_no)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.q AS period, 1000 * b.length // b.q AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN m USING (row_no) LEFT JOIN b USING (row_no) LEFT JOIN k USING (row_no)
"""
