"""Operator 7, best-fit packing by bin completion branch-and-bound.

How pieces pack depends only on how many there are of each length, and there are at most
``capacity`` lengths.  So the search runs on that histogram (at most 4,096 counts, whatever
the size of the input) and its answer is a list of patterns "these lengths, m times"; Spark
then gives each piece its rank among the pieces of its length and looks its place up.  The
whole corpus is packed at once, not partition by partition.

Search: the largest remaining length opens a bin; the fillings of the rest of that bin are
enumerated lazily, a few of least waste first and then every maximal one, those dominated by an
earlier one left out (a filling is dominated when its items fit into another's items; tested up to
six items, beyond that a dominated filling only costs effort).  A filling is applied to as many
bins as its counts allow, and after all others to a single one.  Branches whose waste exceeds what
a better solution may waste are pruned; best-fit decreasing gives the first incumbent.  The search
ends with a proof, at the lower bound or when all is tried, or without one after ``nodes``
expansions and ``VISITS`` enumeration steps a node (search effort only: every piece is packed).

Nulls, ties and odd input: a null or empty text is its end token alone; repeated rows and ids
are packed each for themselves; a longer document is cut into ``capacity`` pieces, the rest
shorter; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import documents, stored, text_ranges
from gridloom.llm.tokens import encode

CAPACITY, END_ID, VOCABULARY = 4096, 1, "word_bpe_49k.json"
NODES = 20_000
VISITS = 50
_FILLINGS = 6  # fillings looked for before all others


# ---------------------------------------------------------------- search on the histogram

def _dominated(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the items of ``a`` can be packed into the items of ``b`` (both largest first)."""
    room = list(b)

    def place(i: int) -> bool:
        if i == len(a):
            return True
        for j in range(len(room)):
            if room[j] >= a[i]:
                room[j] -= a[i]
                if place(i + 1):
                    return True
                room[j] += a[i]
        return False

    return len(a) <= 6 and len(b) <= 6 and a != b and place(0)


def _largest_up_to(counts: np.ndarray) -> np.ndarray:
    """For every room x the largest available length <= x (0: none)."""
    return np.maximum.accumulate(np.where(counts > 0, np.arange(len(counts)), 0))


def _greedy(counts: np.ndarray, upto: np.ndarray, used: tuple[int, ...], room: int) -> tuple[int, ...]:
    """``used`` filled up best-fit: again and again the largest length that fits."""
    out, taken = list(used), {}
    for x in used:
        taken[x] = taken.get(x, 0) + 1
    room -= sum(used)
    top = room
    while room > 0 and (x := int(upto[min(top, room)])):
        left = int(counts[x]) - taken.get(x, 0)
        k = min(room // x, left)
        if k > 0:
            out += [x] * k
            taken[x] = taken.get(x, 0) + k
            room -= k * x
        top = x - 1
    return tuple(sorted(out, reverse=True))


def fillings(counts: np.ndarray, room: int, limit: int = _FILLINGS) -> list[tuple[int, ...]]:
    """Some undominated fillings of ``room``, least waste first, larger items first among equals."""
    upto = _largest_up_to(counts)
    if room <= 0 or not upto[room]:
        return [()]
    if upto[room] == room:
        return [(room,)]  # an exact item dominates every other filling
    found = {_greedy(counts, upto, (), room)}
    first = np.flatnonzero(counts[:room + 1])
    second = np.minimum(upto[room - first], first)
    second = np.where((second == first) & (counts[first] < 2), upto[np.maximum(first - 1, 0)], second)
    total = first + second
    best = np.lexsort((-first, -total))[:2 * limit]
    found.update(_greedy(counts, upto, (int(a), int(b)) if b else (int(a),), room) for a, b in zip(first[best], second[best]))
    if total.max() < room:  # no pair fills it: the largest few lengths with every second and a third
        for a in first[::-1][:4]:
            rest = counts.copy()
            rest[a] -= 1
            after, space = _largest_up_to(rest), room - int(a)
            b = np.flatnonzero(rest[:space + 1])
            if len(b):
                c = np.minimum(after[space - b], b)
                c = np.where((c == b) & (rest[b] < 2), after[np.maximum(b - 1, 0)], c)
                i = np.lexsort((-b, -(b + c)))[0]
                found.add(_greedy(counts, upto, tuple(x for x in (int(a), int(b[i]), int(c[i])) if x), room))
    ranked = sorted(found, key=lambda f: (-sum(f), [-x for x in f]))[:2 * limit]
    kept: list[tuple[int, ...]] = []
    for f in ranked:
        if not any(_dominated(f, g) for g in kept):
            kept.append(f)
    return kept[:limit]


def maximal_fillings(counts: np.ndarray, room: int, budget: list[int]) -> Iterator[tuple[int, ...]]:
    """Every filling of ``room`` that no further item fits into, largest items first; ``budget`` is used up step by step."""
    lengths = [int(x) for x in np.flatnonzero(counts[:room + 1])[::-1]]
    left = {x: int(counts[x]) for x in lengths}
    stack: list[tuple[int, int, int]] = [(0, room, 0)]  # next length to try, room, items taken before it
    items: list[int] = []
    while stack and budget[0] > 0:
        budget[0] -= 1
        at, space, taken = stack.pop()
        while len(items) > taken:
            left[items.pop()] += 1
        while at < len(lengths) and (lengths[at] > space or not left[lengths[at]]):
            at += 1
        if at == len(lengths):
            if not any(left[x] and x <= space for x in lengths):
                yield tuple(items)
            continue
        stack.append((at + 1, space, taken))  # later: without another of this length
        items.append(lengths[at])
        left[lengths[at]] -= 1
        stack.append((at, space - lengths[at], taken + 1))


def options(counts: np.ndarray, room: int, budget: list[int]) -> Iterator[tuple[int, ...]]:
    """All undominated fillings of ``room``, the promising ones first."""
    first = fillings(counts, room)
    yield from first
    if first == [()] or first == [(room,)]:
        return  # nothing fits, or one item fills it: no other filling is undominated
    for f in maximal_fillings(counts.copy(), room, budget):
        if f not in first and not any(_dominated(f, g) for g in first):
            yield f


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No solution has fewer bins: the volume, or bins that large items need for themselves and for what they can't take."""
    lengths = np.arange(len(counts))
    n, volume = np.cumsum(counts), np.cumsum(counts * lengths)
    bound = -(-int(volume[-1]) // capacity)
    half = capacity // 2
    for a in np.flatnonzero(counts[:half + 1]).tolist() + [0]:
        # items over capacity - a share a bin with none of length a or more; items over half share with no other of them
        alone, large = int(n[-1] - n[capacity - a]), int(n[capacity - a] - n[half])
        space = large * capacity - int(volume[capacity - a] - volume[half])
        small = int(volume[half] - (volume[a - 1] if a else 0))
        bound = max(bound, alone + large + max(0, -(-(small - space) // capacity)))
    return bound


def _times(counts: np.ndarray, items: tuple[int, ...]) -> int:
    need: dict[int, int] = {}
    for x in items:
        need[x] = need.get(x, 0) + 1
    return min(int(counts[x]) // k for x, k in need.items())


def _take(counts: np.ndarray, items: tuple[int, ...], m: int) -> None:
    for x in items:
        counts[x] -= m


def solve(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[int, tuple[int, ...]]]:
    """(m, lengths) patterns that use every counted length exactly; as few bins as the search finds."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    volume = int((counts * np.arange(capacity + 1)).sum())
    bound = lower_bound(counts, capacity)

    def largest() -> int:
        on = np.flatnonzero(counts)
        return int(on[-1]) if len(on) else 0

    best: list[tuple[int, tuple[int, ...]]] = []
    start = counts.copy()
    while big := largest():  # incumbent: best-fit decreasing
        counts[big] -= 1
        items = (big, *_greedy(counts, _largest_up_to(counts), (), capacity - big))
        counts[big] += 1
        m = _times(counts, items)
        _take(counts, items, m)
        best.append((m, items))
    fewest = sum(m for m, _ in best)
    counts[:] = start
    path: list[tuple[int, tuple[int, ...], int]] = []  # pattern and the waste before it
    waste, steps = 0, 0
    stack: list[Iterator[tuple[tuple[int, ...], int]]] = []  # patterns not tried yet, per level
    budget = [VISITS * nodes]

    def tries(big: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """(lengths, bins) of one bin; whenever it is resumed, ``counts`` are as they were when it was opened."""
        counts[big] -= 1
        rest = counts.copy()
        counts[big] += 1
        again = []
        for f in options(rest, capacity - big, budget):
            m = _times(counts, (big, *f))
            yield (big, *f), m
            if m > 1:
                again.append((big, *f))
        for items in again:
            yield items, 1

    if fewest > bound:
        stack.append(tries(largest()))
    while stack and steps < nodes and fewest > bound:
        items, m = next(stack[-1], ((), 0))
        if not m:
            stack.pop()
            if path:
                k, done, waste = path.pop()
                _take(counts, done, -k)
            continue
        steps += 1
        spoilt = waste + m * (capacity - sum(items))
        if spoilt > (fewest - 1) * capacity - volume:
            continue
        path.append((m, items, waste))
        _take(counts, items, m)
        waste = spoilt
        if big := largest():
            stack.append(tries(big))
            continue
        bins = sum(k for k, _, _ in path)
        if bins < fewest:
            fewest, best = bins, [(k, x) for k, x, _ in path]
        m, items, waste = path.pop()
        _take(counts, items, -m)
    return best


# ---------------------------------------------------------------- pieces and places

def _pieces(path: str, capacity: int, end_id: int, keep_ids: bool):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], np.uint32)
        for batch, (a, b) in ((batch, r) for batch in batches for r in text_ranges(batch.column("text"))):
            rows: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").slice(a, b - a).to_pylist(), encode(batch.column("text").slice(a, b - a), path)):
                ids = np.concatenate([ids, end]).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    data = ids[at:at + capacity].tobytes()
                    row = (doc, k, at, len(data) // 4, zlib.crc32(data))
                    rows.append((*row, data) if keep_ids else row)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + ([pa.binary()] if keep_ids else [])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document's pieces."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return documents(docs).mapInArrow(_pieces(path, capacity, end_id, keep_ids), schema)


def _places(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """Per length the rows (first rank, first sequence, offset), ranks ascending."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for m, items in patterns:
        at = 0
        for x in items:
            out.setdefault(x, []).append((rank.get(x, 0), sequence, at))
            rank[x] = rank.get(x, 0) + m
            at += x
        sequence += m
    return {x: np.array(rows, np.int64) for x, rows in out.items()}


def _place(places: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = batch.column("rank").to_numpy(), batch.column("length").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length):
                of, table = np.flatnonzero(length == x), places[int(x)]
                row = table[np.searchsorted(table[:, 0], rank[of], side="right") - 1]
                sequence[of], offset[of] = row[:, 1] + rank[of] - row[:, 0], row[:, 2]
            keep = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + [pa.array(sequence), pa.array(offset)],
                                             [*keep, "sequence_id", "offset"])
    return run


def place(cut: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """``cut`` (doc_id, piece, start, length, ids_crc32, ...) with sequence_id and offset; read it from storage."""
    cell = cut.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(4096)))
    sizes = stored(cell.groupBy("length", "cell").agg(F.count("*").alias("n")), "pack-lengths")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    places = _places(solve(histogram, capacity, nodes))
    before = sizes.select("length", "cell", (F.sum("n").over(Window.partitionBy("length").orderBy("cell")) - F.col("n")).alias("before"))
    in_cell = F.row_number().over(Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = (cell.withColumn("place", in_cell).join(before, ["length", "cell"])
              .withColumn("rank", F.col("before") + F.col("place") - 1).select(*cut.columns, "rank"))
    return ranked.mapInArrow(_place(places), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
                             + ", sequence_id long, offset long")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False,
         nodes: int = NODES) -> DataFrame:
    """Tokenise, cut and pack; with ``keep_ids`` each row carries its piece's ids (little-endian uint32)."""
    return place(stored(pieces(docs, path, capacity, end_id, keep_ids), "pieces"), capacity, nodes)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from ``pack(..., keep_ids=True)``."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.unhex(F.lit("")), lambda a, x: F.concat(a, x["ids"]))
    return parts.select("sequence_id", joined.alias("ids"))
