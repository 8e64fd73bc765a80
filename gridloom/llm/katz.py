"""Operator 9, language-model scoring with Katz backoff.

P(w | h) = d(c) c(h w) / c(h) where the pair was seen, else alpha(h) P(w); P(w) = d(c) c(w) / N, and the mass
the discounts free belongs to the unknown word.  Discounts are Good-Turing's for counts up to
``K`` and alpha(h) makes every history sum to one exactly.  A history whose pairs are all counted more
than ``K`` times frees no mass: it keeps one extra event for the unseen (c(h) + 1).

Tokens travel as packed integer arrays, not as rows:

1. Each task turns its documents into *chunks* of at most ``CHUNK_TOKENS`` tokens (a longer text is a chunk of
   its own) and sends each bucket of words the chunk's distinct words with their training counts.
2. A word bucket adds the counts up, writes its part of the unigram table, and answers every chunk with
   the words' ids and counts.  N, V and the counts of counts are summed to a few numbers.
3. A chunk, now knowing its words, sends each bucket of histories its distinct (history, word,
   document) entries.  Histories with more than 1/(8 buckets) of all tokens, of which there are at most
   8 per bucket, are spread over all buckets by the following word.
4. A history bucket adds the pair counts up, writes its part of the bigram table, and returns per
   document the sums that need no discount, how many tokens had count 1..K, and the backoff events with the
   statistics of their history (mass freed per count, unigram mass covered).  A task works its
   buckets off one by one and sends each chunk's sums once.
5. With the bigram discounts known, alpha is computed per history and the sums of each document are added.

The driver sees counts of counts and the bounded list of heavy histories.  Words are told apart by
64-bit XXH64 values.

Nulls, ties and odd input: a null or empty text is its end token alone; a null doc_id reads as the empty text in the
training rule; repeated rows train and are scored each; without training documents every token is
unknown (P = 1, score 0) and base counts are 0; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import documents, held_out, raw, stored, text_slices

K, CHUNK_TOKENS, MODULUS = 5, 2_000_000, 5
BUCKETS_PER_PARTITION = 4  # groups smaller than a shuffle partition, as a group is unpacked in memory
_END = b"</s> "  # holds a blank, so no word equals it
_START = np.uint64((1 << 64) - 1)  # id of the empty history; word ids stay below bucket << 32
_ROW = "kind string, chunk long, bucket int, n long, blob binary"
_NAMES = ["kind", "chunk", "bucket", "n", "blob"]


# ---------------------------------------------------------------- packed arrays

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed byte planes; integers in the narrowest width that holds them."""
    out = []
    z = zstandard.ZstdCompressor(level=1)
    for a in arrays:
        if a.dtype.kind in "iu":
            top = int(a.max()) if len(a) else 0
            a = a.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if top <= np.iinfo(t).max))
        planes = z.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()) if len(a) else b""
        out.append(struct.pack("<ccII", a.dtype.kind.encode(), bytes([a.itemsize]), len(a), len(planes)) + planes)
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    out, at, z = [], 0, zstandard.ZstdDecompressor()
    while at < len(blob):
        kind, wide, n, size = struct.unpack_from("<ccII", blob, at)
        at += 10
        dtype = np.dtype(f"<{kind.decode()}{wide[0]}")
        planes = np.frombuffer(z.decompress(blob[at:at + size]), np.uint8).reshape(wide[0], n) if n else np.zeros((wide[0], 0), np.uint8)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
        at += size
    return out


def _gaps(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=np.uint64(0))


def _sums(a: np.ndarray) -> np.ndarray:
    return np.cumsum(a.astype(np.uint64), dtype=np.uint64)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, kinds)], _NAMES)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys in arrays sorted by them."""
    if not len(keys[0]):
        return np.array([], np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _mixed(a: np.ndarray) -> np.ndarray:
    """A 64-bit mixing of ids, so buckets are even."""
    a = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return a ^ (a >> np.uint64(29))


def _slot(mixed: np.ndarray, buckets: int) -> np.ndarray:
    return ((mixed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


# ---------------------------------------------------------------- 1: chunks and word requests

def _chunks(buckets: int, modulus: int):
    def build(base: int, docs: list, words: list[bytes], lengths: list[int]) -> pa.RecordBatch:
        coded = pa.array(words, pa.binary()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
        known, back = np.unique(hashes, return_inverse=True)
        stream = back[coded.indices.to_numpy()]
        held = np.array([held_out(d, modulus) for d in docs])
        train = np.repeat(~held, lengths)
        counts = np.bincount(stream[train], minlength=len(known))
        ids = np.array([d or 0 for d in docs], np.int64).view(np.uint64)
        rows = [("stream", base, -1, int(train.sum()),
                 pack(stream, np.array(lengths), ids, np.array([d is None for d in docs], np.uint8), held.astype(np.uint8)))]
        slot = _slot(known, buckets)
        cuts = np.searchsorted(slot, np.arange(buckets + 1))
        rows += [("request", base, b, 0, pack(_gaps(known[lo:hi]), counts[lo:hi]))
                 for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if hi > lo]
        return _rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        docs, words, lengths = [], [], []
        for cols, texts in text_slices(batches):
            for doc, text in zip(cols["doc_id"], texts):
                mine = raw(text).lower().split()
                if docs and len(words) + len(mine) >= CHUNK_TOKENS:
                    yield build(base, docs, words, lengths)
                    base += 1
                    docs, words, lengths = [], [], []
                words += mine
                words.append(_END)
                docs.append(doc)
                lengths.append(len(mine) + 1)
        if docs:
            yield build(base, docs, words, lengths)
    return run


# ---------------------------------------------------------------- 2: word buckets

def _of(rows: pa.Table, *kinds: str) -> list[dict]:
    """The group's rows of these kinds, by chunk and bucket."""
    return sorted((r for r in rows.to_pylist() if r["kind"] in kinds), key=lambda r: (r["chunk"], r["bucket"]))


def _count_words(heavy_from: int):
    def run(rows: pa.Table) -> pa.Table:
        asked = _of(rows, "request")
        parts = [unpack(r["blob"]) for r in asked]
        hashes = [_sums(g) for g, _ in parts]
        known, back = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(back, weights=np.concatenate([c for _, c in parts]).astype(float), minlength=len(known)).astype(np.int64)
        bucket, out, at = asked[0]["bucket"], [], 0
        for r, h in zip(asked, hashes):
            place = back[at:at + len(h)]
            at += len(h)
            out.append(("reply", r["chunk"], bucket, 0, pack(place, total[place])))
        heavy = np.flatnonzero(total >= heavy_from)
        stat = [int(total.sum()), int((total > 0).sum()), *(int((total == r).sum()) for r in range(1, K + 2))]
        out.append(("stat", 0, bucket, 0, pack(np.array(stat), (np.uint64(bucket) << np.uint64(32)) + heavy.astype(np.uint64), total[heavy])))
        out.append(("model", 0, bucket, 0, pack(_gaps(known), total)))
        return pa.Table.from_batches([_rows(out)])
    return run


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """d_0..d_K of Good-Turing with Katz's cut at ``K``; half a count is taken where those are not all inside (0, 1)."""
    n = [0, *counts_of_counts]
    if all(x > 0 for x in n[1:K + 2]):
        common = (K + 1) * n[K + 1] / n[1]
        if common != 1:
            d = [1.0] + [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, K + 1)]
            if all(0 < x < 1 for x in d[1:]):
                return np.array(d)
    return np.array([1.0] + [(r - 0.5) / r for r in range(1, K + 1)])


def unigram(total: int, counts_of_counts: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """P(w) by training count; count 0 is the unknown word, which has all the freed mass."""
    d = discounts(counts_of_counts)
    freed = sum(n * r * (1 - d[r]) for r, n in enumerate(counts_of_counts[:K], 1))
    whole, unknown = (total, freed) if freed > 0 else (total + 1, 1.0)

    def p(c: np.ndarray) -> np.ndarray:
        c = c.astype(np.int64)
        return np.where(c > 0, np.where(c <= K, d[np.minimum(c, K)], 1.0) * c, unknown) / whole
    return p


# ---------------------------------------------------------------- 3: pairs of a chunk

def _pairs(buckets: int, total: int, distinct: int, heavy: np.ndarray):
    def run(rows: pa.Table) -> pa.Table:
        stream, lengths, docs, null, held = unpack(_of(rows, "stream")[0]["blob"])
        chunk = rows.column("chunk")[0].as_py()
        ids, counts = [], []
        for r in _of(rows, "reply"):
            place, c = unpack(r["blob"])
            ids.append((np.uint64(r["bucket"]) << np.uint64(32)) + place.astype(np.uint64))
            counts.append(c.astype(np.int64))
        ids, counts = np.concatenate([*ids, [_START]]), np.concatenate([*counts, [0]])
        stream, lengths = stream.astype(np.int64), lengths.astype(np.int64)
        first = np.cumsum(lengths) - lengths
        c = counts[stream]
        base = np.add.reduceat(np.log10((c + 0.5) / (total + 0.5 * (distinct + 1))), first)
        known = np.add.reduceat((c > 0).astype(np.int64), first)
        out = [("doc", chunk, chunk % buckets, 0, pack(docs.astype(np.uint64), null, held, lengths, known, base))]
        # history of each token: the token before it, the start symbol at a document's head
        wide = len(ids)
        history = np.r_[0, stream[:-1]]
        history[first] = wide - 1
        mixed = _mixed(ids)
        slot_h = _slot(mixed, buckets)
        spread = np.isin(ids, heavy)
        spread[-1] = True
        slot = slot_h[history]
        on = np.flatnonzero(spread[history])
        slot[on] = _slot(_mixed(mixed[history[on]] + mixed[stream[on]]), buckets)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        key = (slot * wide + history) * wide + stream
        order = np.argsort(key, kind="stable")  # documents stay ascending inside a pair
        key, doc, slot = key[order], doc[order], slot[order]
        entry = _runs(key, doc)
        times = np.diff(np.r_[entry, len(key)])
        key, doc, slot = key[entry], doc[entry], slot[entry]
        pair = _runs(key)
        h, w = np.divmod(key[pair] % (wide * wide), wide)
        entries = np.diff(np.r_[pair, len(key)])
        cuts_p, cuts_e = np.searchsorted(slot[pair], np.arange(buckets + 1)), np.searchsorted(slot, np.arange(buckets + 1))
        bits = np.packbits(held.astype(bool))
        for b in range(buckets):
            p, q = cuts_p[b], cuts_p[b + 1]
            if q > p:
                e = slice(cuts_e[b], cuts_e[b + 1])
                out.append(("pairs", chunk, b, len(lengths), pack(_gaps(ids[h[p:q]]), ids[w[p:q]], counts[w[p:q]], entries[p:q], doc[e], times[e], bits)))
        return pa.Table.from_batches([_rows(out)])
    return run


# ---------------------------------------------------------------- 4: history buckets

def _count_pairs(total: int, word_counts: list[int], heavy: np.ndarray, heavy_counts: np.ndarray):
    p_of = unigram(total, word_counts)

    def one(bucket: int, mine: list[dict], totals: dict[int, list[np.ndarray]]) -> list[tuple]:
        """One bucket's rows; its documents' sums are added to ``totals`` by chunk."""
        out: list[tuple] = []
        hs, ws, cs, entry_pair, entry_chunk, entry_doc, entry_n, trains, at = [], [], [], [], [], [], [], [], 0
        for k, r in enumerate(mine):
            gaps, w, c, entries, doc, times, bits = unpack(r["blob"])
            held = np.unpackbits(bits, count=r["n"]).astype(bool)
            hs.append(_sums(gaps))
            ws.append(w.astype(np.uint64))
            cs.append(c.astype(np.int64))
            entry_pair.append(np.repeat(np.arange(at, at + len(w)), entries))
            entry_chunk.append(np.full(len(doc), k))
            entry_doc.append(doc.astype(np.int64))
            entry_n.append(times.astype(np.int64))
            trains.append(~held[entry_doc[-1]])
            at += len(w)
        h, w, c_word = map(np.concatenate, (hs, ws, cs))
        e_pair, e_chunk, e_doc, e_n, e_train = map(np.concatenate, (entry_pair, entry_chunk, entry_doc, entry_n, trains))
        order = np.lexsort((w, h))
        h, w, c_word = h[order], w[order], c_word[order]
        start = _runs(h, w)
        of = np.empty(len(order), np.int64)
        of[order] = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(order)]))
        h, w, c_word, e_pair = h[start], w[start], c_word[start], of[e_pair]
        count = np.bincount(e_pair, weights=e_n * e_train, minlength=len(h)).astype(np.int64)
        seen = count > 0
        out.append(("stat", 0, bucket, 0, pack(np.array([int((count == r).sum()) for r in range(1, K + 2)]))))
        out.append(("model", 0, bucket, 0, pack(_gaps(h[seen]), w[seen], count[seen])))
        # statistics per history
        first = _runs(h)
        hist = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(h)]))
        c_h = np.bincount(hist, weights=count, minlength=len(first)).astype(np.int64)
        by_r = np.stack([np.bincount(hist, weights=count == r, minlength=len(first)) for r in range(1, K + 1)], 1)
        p_word = p_of(c_word)
        covered = np.bincount(hist, weights=np.where(seen, p_word, 0.0), minlength=len(first))
        place = np.searchsorted(heavy, h[first])
        is_heavy = (place < len(heavy)) & (heavy[np.minimum(place, len(heavy) - 1)] == h[first]) if len(heavy) else np.zeros(len(first), bool)
        c_h[is_heavy] = heavy_counts[place[is_heavy]]
        on = np.flatnonzero(is_heavy)
        out.append(("heavy", 0, bucket, 0, pack(place[on], *by_r[on].astype(np.int64).T, covered[on])))
        full = by_r.sum(1) == 0  # no pair frees mass here; final for every history that is not spread
        # per document: what needs no discount, and how many tokens had each small count
        e_hist, e_count = hist[e_pair], count[e_pair]
        e_seen = e_count > 0
        whole = (c_h + (full & ~is_heavy))[e_hist]
        value = e_n * np.log10(np.where(e_seen, e_count, p_word[e_pair]) / np.where(e_seen, whole, 1))
        for k, r in enumerate(mine):
            of_chunk = e_chunk == k
            doc, n, cc = e_doc[of_chunk], e_n[of_chunk], e_count[of_chunk]
            plain = np.bincount(doc, weights=value[of_chunk], minlength=r["n"])
            small = [np.bincount(doc, weights=n * (cc == x), minlength=r["n"]).astype(np.int64) for x in range(1, K + 1)]
            for x, y in zip(totals.setdefault(r["chunk"], [np.zeros(r["n"])] + [np.zeros(r["n"], np.int64) for _ in small]), (plain, *small)):
                x += y
        chunks = np.array([r["chunk"] for r in mine], np.int64)
        for kind, events in (("event", ~e_seen & (c_h[e_hist] > 0)), ("full", e_seen & (is_heavy & full)[e_hist])):
            on = np.flatnonzero(events)
            used, back = np.unique(e_hist[on], return_inverse=True)
            if len(on):
                out.append((kind, 0, bucket, 0, pack(
                    c_h[used], np.where(is_heavy[used], place[used] + 1, 0), *by_r[used].astype(np.int64).T, covered[used],
                    back, chunks.astype(np.uint64), e_chunk[on], e_doc[on], e_n[on])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buckets one after the other (rows come sorted); the partition's sums leave once, at its end."""
        totals: dict[int, list[np.ndarray]] = {}
        part, bucket, mine = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["kind"] == "doc":
                    yield _rows([("doc", r["chunk"], part, 0, r["blob"])])
                    continue
                if r["bucket"] != bucket and mine:
                    yield _rows(one(bucket, mine, totals))
                    mine = []
                bucket = r["bucket"]
                mine.append(r)
        if mine:
            yield _rows(one(bucket, mine, totals))
        for chunk, sums in totals.items():
            yield _rows([("sum", chunk, part, 0, pack(*sums))])
    return run


# ---------------------------------------------------------------- 5: backoff and totals

def _back_off(d: np.ndarray, heavy_by_r: np.ndarray, heavy_covered: np.ndarray):
    """Events of a bucket to per-chunk sums of log10 alpha (or of the saturated histories' correction)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                c_h, heavy, *by_r, covered, hist, chunks, e_chunk, e_doc, e_n = unpack(r["blob"])
                by_r, covered = np.stack(by_r, 1).astype(float), covered.copy()
                on = np.flatnonzero(heavy)
                by_r[on], covered[on] = heavy_by_r[heavy[on].astype(np.int64) - 1], heavy_covered[heavy[on].astype(np.int64) - 1]
                freed = by_r @ (np.arange(1, K + 1) * (1 - d[1:]))
                full = freed <= 0
                c_h = c_h.astype(float)
                if r["kind"] == "event":
                    log = np.log10(np.where(full, 1.0, freed) / (c_h + full) / (1 - covered))
                else:  # a spread history that turned out to free no mass: its seen pairs were divided by c(h)
                    log = np.where(full, np.log10(c_h / (c_h + 1)), 0.0)
                value = log[hist] * e_n
                for k, chunk in enumerate(chunks.view(np.uint64) if chunks.dtype.itemsize == 8 else chunks):
                    of = np.flatnonzero(e_chunk == k)
                    if len(of):
                        out.append(("back", int(chunk), r["bucket"], 0, pack(np.bincount(e_doc[of], weights=value[of]))))
            yield _rows(out)
    return run


def _finish(d: np.ndarray, total: int):
    log_d = np.log10(d[1:])

    def run(rows: pa.Table) -> pa.Table:
        docs, null, held, lengths, known, base = unpack(_of(rows, "doc")[0]["blob"])
        score = np.zeros(len(docs))
        for r in _of(rows, "sum", "back"):
            plain, *small = unpack(r["blob"])
            score[:len(plain)] += plain
            for x, n in zip(log_d, small):
                score += x * n
        ids = pa.array(docs.astype(np.uint64).view(np.int64), mask=null.astype(bool))
        return pa.table({"doc_id": ids, "held_out": held.astype(bool), "n_tokens": lengths.astype(np.int64), "n_known": known.astype(np.int64),
                         "train_tokens": np.full(len(docs), total, np.int64), "base_score": base, "score": score})
    return run


class Model:
    """The trained model: written unigram and bigram tables, their totals, and every document's score."""

    def __init__(self, docs: DataFrame, modulus: int = MODULUS):
        spark = docs.sparkSession
        self.buckets = buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
        first = stored(documents(docs).mapInArrow(_chunks(buckets, modulus), _ROW), "katz-chunks", "kind")
        streams = first.where("kind = 'stream'")
        self.total = total = streams.agg(F.sum("n")).first()[0] or 0
        words = stored(first.where("kind = 'request'").groupBy("bucket")
                       .applyInArrow(_count_words(max(1, total // (8 * buckets))), _ROW), "katz-words", "kind")
        self.words = words.where("kind = 'model'")
        stats = [unpack(r["blob"]) for r in words.where("kind = 'stat'").select("blob").collect()]  # one row per bucket
        sums = np.sum([s[0].astype(np.int64) for s in stats], axis=0) if stats else np.zeros(K + 3, np.int64)
        self.distinct, self.word_counts = int(sums[1]), sums[2:].tolist()
        heavy = np.concatenate([s[1].astype(np.uint64) for s in stats] + [np.array([_START])])
        n_train = streams.mapInArrow(_train_docs, "n long").agg(F.sum("n")).first()[0] or 0
        counts = np.concatenate([s[2].astype(np.int64) for s in stats] + [np.array([n_train])])
        order = np.argsort(heavy)
        heavy, counts = heavy[order], counts[order]
        asked = streams.unionByName(words.where("kind = 'reply'"))
        pairs = asked.groupBy("chunk").applyInArrow(_pairs(buckets, total, self.distinct, heavy), _ROW)
        parts = max(1, buckets // BUCKETS_PER_PARTITION)
        counted = stored(pairs.repartition(parts, "bucket").sortWithinPartitions("bucket", "chunk")
                         .mapInArrow(_count_pairs(total, self.word_counts, heavy, counts), _ROW), "katz-pairs", "kind")
        self.pairs = counted.where("kind = 'model'")
        self.pair_counts = np.sum([np.zeros(K + 1, np.int64)] + [unpack(r["blob"])[0].astype(np.int64) for r in
                                  counted.where("kind = 'stat'").select("blob").collect()], axis=0).tolist()
        by_r, covered = np.zeros((len(heavy), K)), np.zeros(len(heavy))
        for r in counted.where("kind = 'heavy'").select("blob", "bucket").orderBy("bucket").collect():  # <= 8 buckets + 1 entries a row
            place, *n, s = unpack(r["blob"])
            np.add.at(by_r, place.astype(np.int64), np.stack(n, 1))
            np.add.at(covered, place.astype(np.int64), s)
        d = discounts(self.pair_counts)
        back = counted.where("kind in ('event', 'full')").mapInArrow(_back_off(d, by_r, covered), _ROW)
        ends = counted.where("kind in ('doc', 'sum')").select(*_NAMES).unionByName(back)
        self.scores = ends.groupBy("chunk").applyInArrow(
            _finish(d, total), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _train_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([int((unpack(b)[4] == 0).sum()) for b in batch.column("blob").to_pylist()], pa.int64())], ["n"])


def score(docs: DataFrame, modulus: int = MODULUS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    return Model(docs, modulus).scores
