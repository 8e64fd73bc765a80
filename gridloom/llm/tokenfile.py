"""Operator 3, token-id files: an adaptive context-mixing range coder.

Documents are laid out in ascending id order.  A *segment* holds whole documents; its ids are cut
into *blocks* of ``BLOCK`` ids that are reset and coded independently, so a reader can start at any
block and a damaged one is found by its checksum.  A block lists its distinct ids once and
codes each position in one arithmetic-coding step from the mixture of three id predictions: order 2 and
order 1 propose the id that followed their context, order 0 holds adaptive frequencies of all ids.
A block's ids are cut into equal *streams* (one for 128 ids), each with code words of its own; a step codes the
next id of every stream from the block's one model and then teaches the model all of them.  The proposals change with every
step; the shares of the orders (from the hit record of proposals in the same state, within the block) and the
order-0 scale are fitted anew at fixed steps.  Many blocks are coded in lockstep with numpy (one lane per stream).

Segments are rows of a Parquet table (part, seg, blob): the blob is the file format below, Parquet is the
container that gives atomic commits under retries.  All integers are little-endian.

    segment: "TIDS" | n_docs u32 | n_blocks u32 | doc ids i64* | null flags u8* | tokens per doc u64* |
             block bytes u32* | crc32 of all before u32 | blocks
    block:   n_ids u32 | n_distinct u32 | crc32 of the ids as u32 | table bytes u32 | table (gaps as u32, deflated from
             all lowest bytes to all highest) | code words per stream u16* | u16 code words

Nulls, ties and odd input: a null or empty text is its end id alone; a null doc_id sorts first; rows with equal ids are
ordered by a hash of the text and written each; a document longer than a segment's aim makes a longer
segment; an empty table writes no segment and reads back no rows; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import documents, stored, text_ranges
from gridloom.llm.tokens import encode as tokenize

END_ID, VOCABULARY = 2, "byte_bpe_50k.json"
BLOCK, SEGMENT, LANES = 4096, 131072, 1024
_STREAM, _SIDE = 128, 256  # a block has a stream for this many ids; blocks coded side by side
_SLOTS, _GAIN = 2048, 32  # order-2 slots of a block; weight of an occurrence against the 1 every id of the table has
_ORDER0, _PARTS = 1 << 15, 128  # the order-0 scale, and the parts of that size a step's range is cut into
_BIN, _BINS = 5, _ORDER0 >> 5  # log2 of the places in a bin of the order-0 scale, and the bins
_TOTAL = float(_ORDER0 * _PARTS)
#: the range lies between these and grows by words; all are whole numbers below 2**53, which floats hold and divide exactly
_BOTTOM, _FULL, _WORD = 2.0 ** 32, 2.0 ** 48, 2.0 ** 16
_SMALL_ID = 1 << 18  # ids below are numbered through a table instead of a sort
_FIT = (1, 2, 4, 8, 16, 32, 64, 96)  # steps after which the shares and the order-0 scale are fitted anew


class _Model:
    """The adaptive state of the blocks coded side by side; symbols are places in a block's table of distinct ids.

    ``follow`` holds 4 * symbol + how sure it is (1 to 3: it rises where it was right, falls where not) per context, -4
    where none was seen: first all order-1 contexts, then all of order 2.  A class says how sure the two proposals are
    and whether they agree; ``hits`` counts per block and class which order knew the id, and gives the shares of the next
    steps.  Choices are made by arithmetic, as a branch per lane costs more.
    """

    def __init__(self, distinct: np.ndarray, block: np.ndarray, n_ids: int):
        n, distinct = len(distinct), np.maximum(distinct, 1)
        self.wide = wide = int(distinct.max()) + 1
        self.base, self.slot, self.cell = block * wide, n * wide + block * _SLOTS, block * 32  # of each lane
        self.shift, self.bin = block * (2 * _ORDER0), block * _BINS
        self.follow = np.full(n * (wide + _SLOTS), -4, np.int16)
        self.distinct = distinct[:, None]
        self.seen = (np.arange(wide) < self.distinct).astype(np.int32)
        self.hits = np.zeros((n, 32, 3), np.int32)  # per class: order 0, order 1, order 2
        self.symbols, self.events = np.empty(n_ids, np.int64), np.empty(n_ids, np.int64)  # of all steps
        self.done = self.fitted = 0
        kinds = np.arange(32)
        self.has2, self.has1 = kinds >> 2 & 3 > 0, (kinds & 3 > 0) & (kinds < 16)  # agreeing proposals are order 2's
        self.at, self.before = np.stack([self.base, self.slot]), np.zeros(len(block), np.int64)
        self.fit()

    def fit(self) -> None:
        """Shares of each class and the order-0 scale from all that was coded so far."""
        if self.done > self.fitted:
            for counts, at, weight in ((self.seen, self.symbols, _GAIN), (self.hits, self.events, 1)):
                more = np.bincount(at[self.fitted:self.done], minlength=counts.size).reshape(counts.shape)
                counts += more.astype(np.int32) * np.int32(weight)
            self.fitted = self.done
        h0, h1, h2 = np.moveaxis(self.hits.astype(np.float64), 2, 0)
        h2, h1 = (h2 + 0.5) * self.has2, (h1 + 0.5) * self.has1
        rest = np.clip(np.rint(_PARTS * (h0 + 1.0) / (h0 + 1.0 + h1 + h2)), 1, _PARTS - (self.has1 | self.has2))
        both = (_PARTS - rest) * _ORDER0
        order2 = np.clip(np.floor(both * (h2 / np.maximum(h1 + h2, 0.5))), self.has2, both - self.has1)
        self.upto2, self.upto1 = order2.ravel(), both.ravel()  # where the shares of order 2 and order 1 end
        upto = np.cumsum(self.seen, axis=1, dtype=np.int32)
        start = np.empty(upto.shape, np.int32)
        start[:, 0] = 0
        start[:, 1:] = upto[:, :-1] * ((_ORDER0 - self.distinct) / upto[:, -1:])
        start += np.arange(self.wide, dtype=np.int32)
        np.copyto(start, _ORDER0, where=np.arange(self.wide) >= self.distinct)
        start += (np.arange(len(start), dtype=np.int32) * (2 * _ORDER0))[:, None]
        self.start = start.ravel()  # ascending over all blocks, for the search
        self.bins: np.ndarray | None = None

    def find(self, key: np.ndarray, base: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Where the symbols stand whose order-0 ranges hold the places ``key``, of the lanes ``new``: from the last one that
        starts no later than the key's bin two steps upwards, and by a search where that is not far enough."""
        if self.bins is None:
            n = len(self.distinct)
            self.bins = np.zeros((n, _BINS + 1), np.int16)
            place = (self.start.reshape(n, -1) & (2 * _ORDER0 - 1)) + (_ORDER0 // _BINS - 1) >> _BIN  # the first bin that starts no earlier
            place += (np.arange(n, dtype=np.int32) * (_BINS + 1))[:, None]
            inside = np.arange(self.wide) < self.distinct
            self.bins.ravel()[place[inside]] = np.broadcast_to(np.arange(self.wide, dtype=np.int16), place.shape)[inside]
            self.bins = np.maximum.accumulate(self.bins, axis=1)[:, :_BINS].ravel()
        key32 = (key + self.shift.take(new)).astype(np.int32)
        at = base + self.bins.take((key >> _BIN) + self.bin.take(new))
        at += self.start.take(at + 1) <= key32
        at += self.start.take(at + 1) <= key32
        far = np.flatnonzero(self.start.take(at + 1) <= key32)
        at[far] = self.start.searchsorted(key32[far], side="right") - 1
        return at

    def propose(self, n: int) -> None:
        """The proposals of order 1 and 2 for the first ``n`` lanes with their shares of the range."""
        self.at = self.at[:, :n]
        self.f = self.follow.take(self.at)
        self.p = self.f >> 2
        sure = self.f & 3
        kind = (sure[1] << 2) + sure[0] + ((self.p[0] == self.p[1]).view(np.int8) << np.int16(4))
        self.kind = self.cell[:n] + kind
        self.s2, self.s = self.upto2.take(self.kind), self.upto1.take(self.kind)

    def place(self, by2: np.ndarray, new: np.ndarray, at: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, width) of the symbols in the range of a step; the lanes ``new`` go by order 0, behind the shares ``s``
        of the others, and their symbols stand ``at``."""
        second, rest = by2.astype(np.float64), self.s - self.s2
        mine = self.s2 * second
        low, wide = self.s2 - mine, rest - rest * second + mine
        w = (_TOTAL - s) * (1 / _ORDER0)
        start = self.start.take(at)
        low[new] = s + (start & (2 * _ORDER0 - 1)) * w
        wide[new] = (self.start.take(at + 1) - start) * w
        return low, wide

    def learn(self, step: int, n: int, x: np.ndarray) -> None:
        f, hit = self.f, (self.p == x).view(np.int8).astype(np.int16)
        fresh = (x << 2) + np.int16(1)
        kept = np.minimum(f + (hit << 1) - np.int16(1), f | 3)
        self.follow[self.at] = fresh + ((f >> 1 & 1) | hit) * (kept - fresh)
        now = slice(self.done, self.done + n)
        np.add(self.kind * 3, np.maximum(hit[0], hit[1] << 1), out=self.events[now])
        np.add(self.base[:n], x, out=self.symbols[now])
        self.done += n
        x = x.astype(np.int64)
        self.at = np.stack([self.symbols[now], self.slot[:n] + ((x * 61 + self.before[:n]) & (_SLOTS - 1))])
        self.before = x * 1031
        if step + 1 in _FIT:
            self.fit()


def _tables(blocks: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct ids ascending, each id's place among them) of each block."""
    tops = [int(b.max()) + 1 if len(b) else 0 for b in blocks]
    small = max((t for t in tops if t <= _SMALL_ID), default=0)
    there, place = np.zeros(small, bool), np.empty(small, np.int16)
    for ids, top in zip(blocks, tops):
        if top > small:
            yield np.unique(ids, return_inverse=True)
            continue
        ids = ids.astype(np.int64)
        there[ids] = True
        table = np.flatnonzero(there[:top])
        there[table] = False
        place[table] = np.arange(len(table), dtype=np.int16)
        yield table.astype(np.uint32), place.take(ids)


def _groups(sizes: list[tuple[int, int]]) -> list[list[int]]:
    """Blocks (length, distinct ids) to code side by side: alike in distinct ids."""
    order = sorted(range(len(sizes)), key=lambda i: sizes[i][1])
    return [order[i:i + _SIDE] for i in range(0, len(order), _SIDE)]


def _lanes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(block, first place, length, number) of the streams the blocks' ids are cut into, the longest first."""
    count = np.maximum(lengths // _STREAM, 1)
    block = np.repeat(np.arange(len(lengths)), count)
    most = -(-lengths // count)[block]
    first = (np.arange(len(block)) - (np.cumsum(count) - count)[block]) * most
    size = np.clip(lengths[block] - first, 0, most)
    order = np.argsort(-size, kind="stable")
    return block[order], first[order], size[order], order


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ids (uint32) as bytes."""
    tables = list(_tables(blocks))
    result: list[bytes] = [b""] * len(blocks)
    for group in _groups([(len(b), len(t)) for b, (t, _) in zip(blocks, tables)]):
        for i, code in zip(group, _encode([tables[i][1] for i in group], np.array([len(tables[i][0]) for i in group]))):
            gaps = np.diff(tables[i][0], prepend=np.uint32(0)).astype("<u4")
            table = zlib.compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)
            ids = blocks[i].astype("<u4").tobytes()
            result[i] = struct.pack("<IIII", len(blocks[i]), len(tables[i][0]), zlib.crc32(ids), len(table)) + table + code
    return result


def _encode(symbols: list[np.ndarray], distinct: np.ndarray) -> list[bytes]:
    block, first, size, number = _lanes(np.array([len(s) for s in symbols]))
    count, longest = len(block), int(size[0])
    model = _Model(distinct, block, int(size.sum()))
    every = np.zeros((count, longest), np.int16)
    for lane, (b, a, n) in enumerate(zip(block.tolist(), first.tolist(), size.tolist())):
        every[lane, :n] = symbols[b][a:a + n]
    every = np.ascontiguousarray(every.T)
    low, wide = np.zeros(count), np.full(count, _FULL)
    room = longest * 3 // 2 + 4  # a step settles 22 bits at most
    words, begin = np.zeros(count * room, np.int32), np.arange(count) * room  # a word may hold a carry for the one before it
    end = begin.copy()
    for step in range(longest):
        n = int(np.searchsorted(-size, -step, side="left"))  # lanes that still have an id
        x = every[step, :n]
        model.propose(n)
        by2 = model.p[1] == x
        new = np.flatnonzero(~(by2 | (model.p[0] == x)))
        start, width = model.place(by2, new, model.base.take(new) + x.take(new), model.s.take(new))
        model.learn(step, n, x)
        r = np.floor(wide[:n] * (1 / _TOTAL))
        now, left = low[:n] + r * start, r * width
        small = left < _BOTTOM
        while small.any():
            word = np.floor(now * (1 / _BOTTOM))
            words[end[:n]] = word.astype(np.int32)
            full = small.astype(np.float64)
            grow = full * (_WORD - 1) + 1
            now = (now - word * full * _BOTTOM) * grow
            left *= grow
            end[:n] += small
            small = left < _BOTTOM
        low[:n], wide[:n] = now, left
    words[end] = np.ceil(low * (1 / _BOTTOM)).astype(np.int32)  # the range holds a value that ends in zeros
    counts = np.empty(count, np.int64)
    counts[number] = end - begin + 1
    words = words.reshape(count, room)[np.argsort(number)]
    words = words[np.arange(room) < counts[:, None]]
    while len(over := np.flatnonzero(words >> 16)):
        words[over - 1] += words[over] >> 16
        words[over] &= 0xFFFF
    ends, streams = np.cumsum(counts), np.cumsum(np.bincount(block))
    words, counts = words.astype("<u2"), counts.astype("<u2")
    return [counts[a:b].tobytes() + words[ends[a] - counts[a]:ends[b - 1]].tobytes()
            for a, b in zip(np.r_[0, streams[:-1]].tolist(), streams.tolist())]


def decode_blocks(blobs: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; raises ValueError where a checksum does not hold."""
    heads = [struct.unpack_from("<IIII", b) for b in blobs]
    result: list[np.ndarray] = [np.array([], np.uint32)] * len(blobs)
    for group in _groups([h[:2] for h in heads]):
        codes = [np.frombuffer(blobs[i], "<u2", (len(blobs[i]) - 16 - heads[i][3]) // 2, 16 + heads[i][3]) for i in group]
        symbols = _decode(codes, np.array([heads[i][0] for i in group]), np.array([heads[i][1] for i in group]))
        for i, x in zip(group, symbols):
            try:
                gaps = zlib.decompress(blobs[i][16:16 + heads[i][3]])
            except zlib.error as e:
                raise ValueError("damaged block: its table of ids can't be read") from e
            table = np.cumsum(np.frombuffer(gaps, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel(), dtype=np.uint32)
            if len(x) and (int(x.max()) >= len(table) or int(x.min()) < 0):
                raise ValueError("damaged block: a code points past its table of ids")
            ids = table[x]
            if zlib.crc32(ids.astype("<u4").tobytes()) != heads[i][2]:
                raise ValueError("damaged block: its ids do not have its checksum")
            result[i] = ids
    return result


def _words(codes: list[np.ndarray], streams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all streams, and each stream's first; as many zeros as a reader may look ahead follow each stream."""
    counts = [c[:k].astype(np.int64) for c, k in zip(codes, streams.tolist())]
    if any(len(n) != k or k + n.sum() != len(c) for c, n, k in zip(codes, counts, streams.tolist())):
        raise ValueError("damaged block: its streams do not have its length")
    size = np.concatenate(counts)
    first = np.cumsum(size + 3) - size - 3
    words = np.zeros(int(size.sum()) + 3 * len(size), np.uint16)
    words[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())] = np.concatenate(
        [c[k:] for c, k in zip(codes, streams.tolist())])
    return words, first


@np.errstate(over="ignore", invalid="ignore")  # a damaged code may leave its range; its checksum tells
def _decode(codes: list[np.ndarray], lengths: np.ndarray, distinct: np.ndarray) -> list[np.ndarray]:
    """Symbols of each block."""
    block, first, size, number = _lanes(lengths)
    count, longest = len(block), int(size[0])
    model = _Model(distinct, block, int(size.sum()))
    words, at = _words(codes, np.bincount(block))
    at = at[number]
    value = (words[at] * _WORD + words[at + 1]) * _WORD + words[at + 2]  # how far the code lies above the range's low end
    at += 3
    wide = np.full(count, _FULL)
    every = np.zeros((longest, count), np.int16)
    for step in range(longest):
        n = int(np.searchsorted(-size, -step, side="left"))
        model.propose(n)
        r = np.floor(wide[:n] * (1 / _TOTAL))
        v = np.minimum(np.floor(value[:n] / r), _TOTAL - 1)
        by2 = v < model.s2
        x = model.p[0] + by2.view(np.int8) * (model.p[1] - model.p[0])
        new = np.flatnonzero(v >= model.s)
        s, base = model.s.take(new), model.base.take(new)
        found = model.find(((v.take(new) - s) * _ORDER0 / (_TOTAL - s)).astype(np.int32), base, new)
        x[new] = found - base
        start, width = model.place(by2, new, found, s)
        every[step, :n] = x
        model.learn(step, n, x)
        now, left = value[:n] - r * start, r * width
        small = left < _BOTTOM
        while small.any():
            full = small.astype(np.float64)
            grow = full * (_WORD - 1) + 1
            now = now * grow + words.take(at[:n], mode="clip") * full
            left *= grow
            at[:n] += small
            small = left < _BOTTOM
        value[:n], wide[:n] = now, left
    rows, result = np.ascontiguousarray(every.T), [np.zeros(n, np.int16) for n in lengths.tolist()]
    for row, b, a, n in zip(rows, block.tolist(), first.tolist(), size.tolist()):
        result[b][a:a + n] = row[:n]
    return result


# ---------------------------------------------------------------- segments

def _segment(docs: list, ids: list[np.ndarray], blocks: list[bytes]) -> bytes:
    head = (b"TIDS" + struct.pack("<II", len(docs), len(blocks)) + np.array([d or 0 for d in docs], "<i8").tobytes()
            + bytes(d is None for d in docs) + np.array([len(x) for x in ids], "<u8").tobytes()
            + np.array([len(b) for b in blocks], "<u4").tobytes())
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(blocks)


def _open(blob: bytes) -> tuple[list, np.ndarray, list[bytes]]:
    """(doc ids, tokens per document, blocks) of a segment."""
    if blob[:4] != b"TIDS":
        raise ValueError("not a token-id segment")
    n, k = struct.unpack_from("<II", blob, 4)
    at = 12 + 17 * n
    end = at + 4 * k
    if struct.unpack_from("<I", blob, end)[0] != zlib.crc32(blob[:end]):
        raise ValueError("damaged segment: its header does not have its checksum")
    ids, null = np.frombuffer(blob, "<i8", n, 12), blob[12 + 8 * n:12 + 9 * n]
    cuts = np.r_[0, np.cumsum(np.frombuffer(blob, "<u4", k, at), dtype=np.int64)] + end + 4
    return ([None if z else int(d) for d, z in zip(ids, null)], np.frombuffer(blob, "<u8", n, 12 + 9 * n).astype(np.int64),
            [blob[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())])


def _tokens(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of every row."""
    for batch in batches:
        for a, b in text_ranges(batch.column("text")):
            yield from zip(batch.column("doc_id").slice(a, b - a).to_pylist(), tokenize(batch.column("text").slice(a, b - a), path))


def _write(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seg = TaskContext.get().partitionId(), 0
        ready: list[tuple[list, list[np.ndarray], list[np.ndarray]]] = []
        docs: list = []
        ids: list[np.ndarray] = []

        def close() -> None:
            whole = np.concatenate(ids)
            ready.append((docs[:], ids[:], [whole[i:i + BLOCK] for i in range(0, len(whole), BLOCK)]))
            docs.clear()
            ids.clear()

        def flush() -> pa.RecordBatch:
            nonlocal seg
            coded = iter(encode_blocks([b for _, _, bs in ready for b in bs]))
            blobs = [_segment(d, i, [next(coded) for _ in bs]) for d, i, bs in ready]
            out = pa.RecordBatch.from_arrays([pa.array([part] * len(blobs), pa.int32()), pa.array(range(seg, seg + len(blobs)), pa.int32()),
                                              pa.array([sum(map(len, i)) for _, i, _ in ready], pa.int64()), pa.array(blobs, pa.binary())],
                                             ["part", "seg", "n_ids", "blob"])
            seg += len(blobs)
            ready.clear()
            return out

        end, size = np.array([end_id], np.uint32), 0
        for doc, x in _tokens(batches, path):
            docs.append(doc)
            ids.append(np.concatenate([x, end]))
            size += len(x) + 1
            if size >= SEGMENT:
                close()
                size = 0
                if sum(len(b) for _, _, b in ready) >= LANES:
                    yield flush()
        if docs:
            close()
        if ready:
            yield flush()
    return run


def write_tokens(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Tokenise, lay out by doc_id and write the segments; the stored table (part, seg, n_ids, blob)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = (documents(docs).withColumn("tie", F.xxhash64("text"))
            .repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "tie")  # the tie splits rows that share an id
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").drop("tie"))
    return stored(laid.mapInArrow(_write(path, end_id), "part int, seg int, n_ids long, blob binary"), "token-files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = list(zip(batch.column("part").to_pylist(), batch.column("seg").to_pylist()))
        lo = 0
        blobs = batch.column("blob")
        while lo < len(names):
            opened, blocks = [], []
            while lo < len(names) and len(blocks) < LANES:
                d, n, b = _open(blobs[lo].as_py())
                opened.append((names[lo], d, n, len(b)))
                blocks += b
                lo += 1
            ids = decode_blocks(blocks)
            rows, at = [], 0
            for (part, seg), docs, n, k in opened:
                whole = np.concatenate(ids[at:at + k]) if k else np.array([], np.uint32)
                at += k
                ends = np.cumsum(n)
                for place, (doc, a, b) in enumerate(zip(docs, (ends - n).tolist(), ends.tolist())):
                    rows.append((part, seg, place, doc, a, b - a, whole[a:b].astype("<u4").tobytes()))
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                             ["part", "seg", "place", "doc_id", "inside", "n_tokens", "ids"])


def read_tokens(files: DataFrame) -> DataFrame:
    """part, seg, place, doc_id, inside (ids of the segment before it), n_tokens and ids (u32) from the written segments."""
    return files.select("part", "seg", "blob").mapInArrow(
        _read, "part int, seg int, place int, doc_id long, inside long, n_tokens long, ids binary")


def segment_starts(files: DataFrame) -> DataFrame:
    """(part, seg, before): ids of all segments before each; sums of the parts first, then inside each part."""
    sizes = files.select("part", "seg", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per written file
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seg")) - F.col("n_ids")
    return sizes.withColumn("inside", inside).join(parts, "part").select("part", "seg", (F.col("inside") + F.col("part_before")).alias("before"))


def digest(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""
    rows = read_tokens(files).select("part", "seg", "doc_id", "inside", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    rows = stored(rows, "token-digests")  # decoded once, however the join reads it
    return rows.join(segment_starts(files), ["part", "seg"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
