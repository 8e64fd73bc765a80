r"""Operator 11, conversation structure repair: a run-length min-plus DP over rows.

Rows of a conversation are taken by turn (null first), then role, then MD5 of the text.  The
first fault of a row counts: blank (no word character), duplicate (role and text seen
earlier) or truncated (the last word character is not one of ``.!?``).  Edits are Keep (0),
Rerole (3), Delete (4, required for blank and duplicate rows) and Insert (3); a truncated row
that stays adds 3.  The cheapest edits that leave the role initials ``(s?(ua)+)?`` are taken,
of equal ones the ASCII-least audit (the edits' initials).  Whatever edit is taken, the state
before it (nothing, s, u or a last) fixes the role it must give, so the audit names the repair.

How it is spread, with no conversation in one task:

* equal rows are counted behind a partial aggregate, and the first of each (role, text) is the
  smallest turn of an aggregate, so no window holds a conversation;
* the rows, without their texts, are dealt and sorted by range of (conversation, turn, role,
  text hash), which splits a long conversation, and packed into segments of at most
  ``SEGMENT`` rows: symbols (role initial and fault) with their counts, equal consecutive
  symbols collapsed to runs.  A run of n symbols is the n-th min-plus power of the symbol's
  4 x 4 matrix, put together from cached binary powers; a segment is the product of its runs;
* the segments' matrices are applied from the end of each conversation (cost to go), choices
  are unrolled per segment for every state it may be entered in, again by cached binary
  powers, and the states are then followed from the start.  Both passes stream over sorted
  segments and hold one vector;
* texts are joined by row hash to the rows that stay.

Only the digest of a whole conversation (its audit text and the hash of its repaired text)
runs through one task per conversation, streaming, since SHA-256 is sequential.

Nulls, ties and odd input: a null role or text reads as one space, a null turn comes first, a
null conv_id is a conversation; rows that agree in turn, role and text are told apart by
nothing and all but one are duplicates; other ties are settled by role and MD5; a role counts
by its initial, all but s, u and a fit nowhere; a conversation without rows or with deleted
rows only has an empty repair; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: rows (repeats counted) of one packed segment at most
SEGMENT = 4096
_FAR = 1 << 50
_BLANK = " \t\n\v\f\r"

# -- states: nothing yet, system last, user last, assistant last ---------------------------
_NONE, _S, _U, _A = range(4)
_NEXT = (_U, _U, _A, _U)  # the state an inserted or reroled row gives
_ROLE = {_U: "user", _A: "assistant"}
_TAIL = ("", "II", "I", "")  # inserts that end a conversation
_FINAL = tuple(INSERT * len(t) for t in _TAIL)
# -- symbols: role initial and fault; all rows that must go are one symbol ------------------
_INITIALS = "suax"
_GONE = 8
_LEGAL = {"su", "ua", "au"}


def _symbol(initial: str, truncated: bool) -> int:
    return _INITIALS.index(initial) * 2 + truncated


def _kept_state(symbol: int, state: int) -> int | None:
    """State after a row of this symbol keeps its role; None if it can't."""
    if symbol == _GONE:
        return None
    own = {"s": _S, "u": _U, "a": _A}.get(_INITIALS[symbol // 2])
    if own == _S:
        return _S if state == _NONE else None
    return own if own == _NEXT[state] else None


def _apply(matrix: tuple, togo: tuple) -> tuple:
    """Min-plus product of a matrix and a vector of costs to go."""
    return tuple(min(m + v for m, v in zip(row, togo)) for row in matrix)


@lru_cache(maxsize=None)  # 9 symbols x 13 powers at most
def power(symbol: int, k: int) -> tuple:
    """Transition of 2^k rows of one symbol: cost from every state to every state, inserts before each row included."""
    if k:
        half = power(symbol, k - 1)
        return tuple(tuple(min(a + half[j][t] for j, a in enumerate(row)) for t in range(4)) for row in half)
    fault = TRUNCATED if symbol != _GONE and symbol % 2 else 0
    rows = []
    for state in range(4):
        cost, at, paid = [_FAR] * 4, state, 0
        for _ in range(3):  # after two inserts the state repeats at a higher cost
            cost[at] = min(cost[at], paid + DELETE)
            if symbol != _GONE:
                cost[_NEXT[at]] = min(cost[_NEXT[at]], paid + REROLE + fault)
                if (kept := _kept_state(symbol, at)) is not None:
                    cost[kept] = min(cost[kept], paid + KEEP + fault)
            at, paid = _NEXT[at], paid + INSERT
        rows.append(tuple(cost))
    return tuple(rows)


def advance(symbol: int, count: int, togo: tuple) -> tuple:
    """Costs to go before ``count`` rows of one symbol, from those after them."""
    for k in range(count.bit_length()):
        if count >> k & 1:
            togo = _apply(power(symbol, k), togo)
    return togo


@lru_cache(maxsize=65536)
def _choices(symbol: int, k: int, state: int, togo: tuple) -> tuple[str, int]:
    """(audit, state after) of 2^k rows entered in ``state``: ASCII-least of the cheapest; togo holds after them."""
    if k:
        middle = _norm(_apply(power(symbol, k - 1), togo))
        first, state = _choices(symbol, k - 1, state, middle)
        second, state = _choices(symbol, k - 1, state, togo)
        return first + second, state
    before, letters = _apply(power(symbol, 0), togo), ""
    fault = TRUNCATED if symbol != _GONE and symbol % 2 else 0
    while True:  # letters in ASCII order: D, I, K, R
        rest = before[state]
        if DELETE + togo[state] == rest:
            return letters + "D", state
        if INSERT + before[_NEXT[state]] == rest:
            letters, state = letters + "I", _NEXT[state]
            continue
        kept = _kept_state(symbol, state)
        if kept is not None and KEEP + fault + togo[kept] == rest:
            return letters + "K", kept
        return letters + "R", _NEXT[state]


def _norm(togo: tuple) -> tuple:
    """Costs less their minimum: choices don't change, and few vectors remain to be cached."""
    least = min(togo)
    return tuple(v - least for v in togo)


def collapse(symbols: list[int], counts: list[int]) -> list[tuple[int, int]]:
    """Runs (symbol, count) of equal consecutive symbols."""
    runs: list[tuple[int, int]] = []
    for s, c in zip(symbols, counts):
        if runs and runs[-1][0] == s:
            runs[-1] = (s, runs[-1][1] + c)
        else:
            runs.append((s, c))
    return runs


def unroll(runs: list[tuple[int, int]], state: int, togo: tuple) -> tuple[str, int]:
    """(audit, state after) of the runs entered in ``state``; ``togo`` holds after the last."""
    after = [togo]
    for s, c in reversed(runs):
        after.append(advance(s, c, after[-1]))
    audit = []
    for (s, c), end in zip(runs, reversed(after[:-1])):
        for k in reversed(range(c.bit_length())):
            if c >> k & 1:
                rest = advance(s, c & ((1 << k) - 1), end)
                letters, state = _choices(s, k, state, _norm(rest))
                audit.append(letters)
    return "".join(audit), state


# -- rows, faults and segments --------------------------------------------------------------

def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) without nulls in role and text."""
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                _text("role").alias("role"), _text("text").alias("text"))


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with ``said`` (hash of conversation, role and text) and ``key`` (hash of that and the turn)."""
    said = F.md5(F.concat(_text("conv_id"), F.lit(":"), F.md5("role"), F.md5("text")))
    return rows.withColumn("said", said).withColumn("key", F.md5(F.concat("said", F.lit(":"), _text("turn"))))


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text_hash, key, n, initial, blank, truncated, first): equal rows as one with their count."""
    bare = F.rtrim(F.col("text"), F.lit(_BLANK))
    initial = F.substring("role", 1, 1)
    flagged = _keyed(rows).select(
        "conv_id", "turn", "role", F.md5("text").alias("text_hash"), "said", "key",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    counted = flagged.groupBy(*flagged.columns).agg(F.count("*").alias("n"))
    firsts = counted.groupBy("said").agg(F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("turn")).select(
        F.md5(F.concat("said", F.lit(":"), F.when(F.col("untimed"), F.lit(" ")).otherwise(_text("turn")))).alias("key"),
        F.lit(True).alias("first"))
    return counted.join(firsts, "key", "left").drop("said").withColumn("first", F.coalesce("first", F.lit(False)))


_SEGMENT = pa.schema([
    ("conv_id", pa.int64()), ("seg", pa.int64()), ("matrix", pa.list_(pa.int64())), ("first_role", pa.string()),
    ("last_role", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("symbols", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())),
    ("keys", pa.list_(pa.string()))])
_SEGMENT_DDL = ("conv_id long, seg long, matrix array<long>, first_role string, last_role string, blank long, duplicate long, "
                "truncated long, illegal long, symbols array<int>, counts array<int>, keys array<string>")


class _Segment:
    """Rows of one conversation in order, packed while they arrive."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.size, self.first, self.last = conv_id, 0, None, ""
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.symbols: list[int] = []
        self.counts: list[int] = []
        self.keys: list[str] = []

    def add(self, initial: str, symbol: int, count: int, key: str, blank: bool, duplicate: bool) -> None:
        if self.first is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _LEGAL
        self.illegal += count - 1  # equal initials side by side are never legal
        self.last = initial
        self.size += count
        self.blank += count * blank
        self.duplicate += count * duplicate
        self.truncated += symbol != _GONE and symbol % 2
        self.symbols.append(symbol)
        self.counts.append(count)
        self.keys.append(key)

    def row(self, seg: int) -> dict:
        ends = []
        for t in range(4):  # column t of the segment's matrix: costs to end in state t
            togo = tuple(0 if s == t else _FAR for s in range(4))
            for s, c in reversed(collapse(self.symbols, self.counts)):
                togo = advance(s, c, togo)
            ends.append(togo)
        return {"conv_id": self.conv_id, "seg": seg, "matrix": [min(ends[t][s], _FAR) for s in range(4) for t in range(4)],
                "first_role": self.first, "last_role": self.last, "blank": self.blank, "duplicate": self.duplicate,
                "truncated": self.truncated, "illegal": self.illegal, "symbols": self.symbols, "counts": self.counts,
                "keys": self.keys}


def _pieces(row: dict) -> Iterator[tuple[int, int, str, bool, bool]]:
    """(symbol, count, key, blank, duplicate) of a counted row: its first occurrence, then its repeats."""
    n = row["n"]
    if row["blank"]:
        yield _GONE, n, "", True, False
        return
    if row["first"]:
        yield _symbol(row["initial"], row["truncated"]), 1, row["key"], False, False
        n -= 1
    if n:
        yield _GONE, n, "", False, True


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to segments; numbers grow within a conversation (partition, then place)."""
    number = TaskContext.get().partitionId() << 36
    current, done = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if current is not None and current.conv_id != row["conv_id"]:
                done.append(current.row(number := number + 1))
                current = None
            for symbol, count, key, blank, duplicate in _pieces(row):
                while count:
                    if current is None:
                        current = _Segment(row["conv_id"])
                    take = min(count, SEGMENT - current.size)
                    current.add(row["initial"], symbol, take, key, blank, duplicate)
                    count -= take
                    if current.size == SEGMENT:
                        done.append(current.row(number := number + 1))
                        current = None
        if len(done) >= 256:
            yield pa.RecordBatch.from_pylist(done, _SEGMENT)
            done = []
    if current is not None:
        done.append(current.row(number + 1))
    if done:
        yield pa.RecordBatch.from_pylist(done, _SEGMENT)


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """(a new conversation begins, row) over rows sorted by conversation."""
    last: tuple = ()
    for batch in batches:
        for row in batch.to_pylist():
            yield last != (row["conv_id"],), row
            last = (row["conv_id"],)


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the last segment of each conversation back: costs to go before and after every segment."""
    rows, togo = [], _FINAL
    for new, row in _changes(batches):
        after = _FINAL if new else togo
        m = row["matrix"]
        togo = _apply(tuple(tuple(m[s * 4:s * 4 + 4]) for s in range(4)), after)
        rows.append({"seg": row["seg"], "togo": list(after), "is_last": new, "cost": togo[_NONE]})
        if len(rows) == 4096:
            yield pa.RecordBatch.from_pylist(rows)
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows)


_UNROLLED = pa.schema([("conv_id", pa.int64()), ("seg", pa.int64()), ("audits", pa.list_(pa.string())),
                       ("exits", pa.list_(pa.int32())), ("symbols", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())),
                       ("keys", pa.list_(pa.string()))])


def _unroll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and state after each segment, for each state it may be entered in."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            runs, togo = collapse(row["symbols"], row["counts"]), tuple(row["togo"])
            ways = [unroll(runs, s, togo) for s in range(4)]
            tails = _TAIL if row["is_last"] else ("",) * 4
            rows.append({"conv_id": row["conv_id"], "seg": row["seg"], "audits": [a + tails[e] for a, e in ways],
                         "exits": [e for _, e in ways], "symbols": row["symbols"], "counts": row["counts"], "keys": row["keys"]})
        yield pa.RecordBatch.from_pylist(rows, _UNROLLED)


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the first segment of each conversation on: the state every segment is entered in, and pairs across segments."""
    rows, state, last = [], _NONE, ""
    for new, row in _changes(batches):
        if new:
            state = _NONE
        rows.append({"seg": row["seg"], "entry": state, "is_first": new,
                     "across": int(not new and last + row["first_role"] not in _LEGAL)})
        state, last = row["exits"][state], row["last_role"]
        if len(rows) == 4096:
            yield pa.RecordBatch.from_pylist(rows)
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows)


_EDIT = pa.schema([("conv_id", pa.int64()), ("seg", pa.int64()), ("at", pa.int32()), ("key", pa.string()), ("role", pa.string())])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that stay or are inserted, in order: key of the row (null: inserted), new role (null: its own)."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            state = row["entry"]
            left = iter([(s, k) for s, c, k in zip(row["symbols"], row["counts"], row["keys"]) for _ in range(c)])
            for at, letter in enumerate(row["audits"][state]):
                symbol, key = (None, None) if letter == "I" else next(left)
                if letter != "D":
                    state = _kept_state(symbol, state) if letter == "K" else _NEXT[state]
                    rows.append({"conv_id": row["conv_id"], "seg": row["seg"], "at": at, "key": key,
                                 "role": None if letter == "K" else _ROLE[state]})
        yield pa.RecordBatch.from_pylist(rows, _EDIT)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(repaired rows, segment reports, conversation reports) of all conversations that have rows.

    Repaired rows: conv_id, seg, at, role, text in the order (conv_id, seg, at).  Segment reports: conv_id, seg,
    audit and counts.  Conversation reports: conv_id, gaps, blank, duplicate, truncated, illegal, cost.
    """
    rows = turns(conversations)
    marked = stored(faults(rows), "turns")
    order = ["conv_id", "turn", "role", "text_hash"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = stored(marked.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                      .select("conv_id", "n", "initial", "blank", "truncated", "first", "key")
                      .mapInArrow(_pack, _SEGMENT_DDL), "segments")
    summary = segments.drop("symbols", "counts", "keys")
    costs = (summary.select("conv_id", "seg", "matrix").repartition(parts, "conv_id")
             .sortWithinPartitions("conv_id", F.desc("seg")).mapInArrow(_costs, "seg long, togo array<long>, is_last boolean, cost long"))
    costs = stored(costs, "costs")
    unrolled = stored(segments.join(costs, "seg").select("conv_id", "seg", "togo", "is_last", "symbols", "counts", "keys")
                      .mapInArrow(_unroll, "conv_id long, seg long, audits array<string>, exits array<int>, "
                                           "symbols array<int>, counts array<int>, keys array<string>"), "choices")
    entries = stored(unrolled.select("seg", "exits").join(summary.select("conv_id", "seg", "first_role", "last_role"), "seg")
                     .select("conv_id", "seg", "exits", "first_role", "last_role").repartition(parts, "conv_id")
                     .sortWithinPartitions("conv_id", "seg")
                     .mapInArrow(_follow, "seg long, entry long, is_first boolean, across long"), "entries")
    edits = unrolled.join(entries, "seg").mapInArrow(_edits, "conv_id long, seg long, at int, key string, role string")
    texts = _keyed(rows).select("key", F.col("role").alias("own_role"), "text").dropDuplicates(["key"])
    edits = stored(edits, "edits")
    repaired = (edits.where("key is not null").join(texts, "key")
                .select("conv_id", "seg", "at", F.coalesce("role", "own_role").alias("role"), "text")
                .unionByName(edits.where("key is null").select("conv_id", "seg", "at", "role", F.lit("").alias("text"))))
    reports = (summary.join(entries, "seg").join(costs.select("seg", "cost"), "seg")
               .join(unrolled.select("seg", "audits"), "seg")
               .select("conv_id", "seg", F.element_at("audits", (F.col("entry") + 1).cast("int")).alias("audit"), "blank", "duplicate",
                       "truncated", (F.col("illegal") + F.col("across")).alias("illegal"),
                       F.when(F.col("is_first"), F.col("cost")).otherwise(0).alias("cost")))
    times = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    whole = (reports.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")])
             .alias("r").join(times.alias("t"), F.col("r.conv_id").eqNullSafe(F.col("t.conv_id")))
             .select("r.conv_id", "t.gaps", "r.blank", "r.duplicate", "r.truncated", "r.illegal", "r.cost"))
    return repaired, reports, whole


# -- the query ------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """The query's input: conversations with faults, as the contract lays down."""
    h = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    rows = turns(conversations).withColumn("h", h).where("h != 0")
    text = F.when(F.col("h") == 1, F.lit("")).when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.sequence(F.lit(0), F.when(F.col("h") == 3, 1).otherwise(0))).alias("copy")).drop("copy")


def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every conversation's ``role:text`` lines, sorted by conversation; only the hash state is held."""
    rows, state, conv_id = [], None, None
    for new, row in _changes(batches):
        if new:
            if state is not None:
                rows.append({"conv_id": conv_id, "repaired_sha256": state.hexdigest()})
            state, conv_id = hashlib.sha256(), row["conv_id"]
        else:
            state.update(b"\n")
        state.update(f"{row['role']}:{row['text']}".encode("utf-8", "surrogatepass"))
    if state is not None:
        rows.append({"conv_id": conv_id, "repaired_sha256": state.hexdigest()})
    yield pa.RecordBatch.from_pylist(rows, pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())]))


def digest(conversations: DataFrame) -> DataFrame:
    """The contract's columns for every conv_id of ``conversations``, after damage and repair."""
    repaired, reports, whole = repair(damaged(conversations))
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashes = (repaired.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "seg", "at")
              .select("conv_id", "role", "text").mapInArrow(_hash_texts, "conv_id long, repaired_sha256 string"))
    audits = reports.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("seg", "audit"))).alias("parts")).select(
        "conv_id", F.array_join(F.transform("parts", lambda p: p["audit"]), "").alias("audit"))
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("i")
    out = ids
    for name, other in (("w", whole), ("a", audits), ("h", hashes)):
        out = out.join(other.alias(name), F.col("i.conv_id").eqNullSafe(F.col(f"{name}.conv_id")), "left")
    zeros = [F.coalesce(f"w.{c}", F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("i.conv_id", *zeros, F.coalesce("a.audit", F.lit("")).alias("audit"),
                      F.coalesce("h.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


#: Row by row: for each state (nothing, s, u, a last) the least (cost, audit) and its repaired lines.
ORACLE_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_of_byte),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(name) + 1), lambda k: ascii(substr(name, k::INT, 1))::BIGINT)),
    lambda c, b: xor(c >> 8, crc_of_byte[xor(c & 255, b) + 1])), 4294967295) % 20 AS h FROM named, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE h <> 0),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS ini,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
faulty AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
    coalesce(lag(ini) OVER (PARTITION BY conv ORDER BY i) || ini NOT IN ('su', 'ua', 'au'), false) AS illegal FROM placed),
step AS (
  SELECT DISTINCT conv, 0::BIGINT AS i, {c: 0::BIGINT, a: '', r: ''} AS n,
    {c: 1000000::BIGINT, a: '', r: ''} AS s, {c: 1000000::BIGINT, a: '', r: ''} AS u, {c: 1000000::BIGINT, a: '', r: ''} AS z FROM faulty
  UNION ALL
  SELECT conv, i, list_sort([{c: n.c + 4, a: n.a || 'D', r: n.r}])[1],
    list_sort([{c: s.c + 4, a: s.a || 'D', r: s.r}, {c: CASE WHEN ini = 's' THEN n.c + stay ELSE 1000000 END, a: n.a || 'K', r: n.r || line}])[1],
    list_sort([{c: u.c + 4, a: u.a || 'D', r: u.r}, {c: CASE WHEN ini = 'u' THEN free.c + stay ELSE 1000000 END, a: free.a || 'K', r: free.r || line},
      {c: free.c + stay + 3, a: free.a || 'R', r: free.r || 'user:' || text || chr(10)}])[1],
    list_sort([{c: z.c + 4, a: z.a || 'D', r: z.r}, {c: CASE WHEN ini = 'a' THEN u.c + stay ELSE 1000000 END, a: u.a || 'K', r: u.r || line},
      {c: u.c + stay + 3, a: u.a || 'R', r: u.r || 'assistant:' || text || chr(10)}])[1]
  FROM (SELECT *, list_sort([n, s, z])[1] AS free FROM (
    SELECT conv, i, n, s, u, list_sort([z, {c: u.c + 3, a: u.a || 'I', r: u.r || 'assistant:' || chr(10)}])[1] AS z,
      ini, text, role || ':' || text || chr(10) AS line, stay
    FROM (
      SELECT step.conv, faulty.i, n, s, z, ini, text, role,
        CASE fault WHEN 'none' THEN 0 WHEN 'truncated' THEN 3 ELSE 1000000 END AS stay,
        list_sort([u, {c: n.c + 3, a: n.a || 'I', r: n.r || 'user:' || chr(10)}, {c: s.c + 3, a: s.a || 'I', r: s.r || 'user:' || chr(10)},
          {c: z.c + 3, a: z.a || 'I', r: z.r || 'user:' || chr(10)}])[1] AS u
      FROM step JOIN faulty ON step.conv = faulty.conv AND faulty.i = step.i + 1)))),
ends AS (
  SELECT conv, list_sort([n, z, {c: u.c + 3, a: u.a || 'I', r: u.r || 'assistant:' || chr(10)},
    {c: s.c + 6, a: s.a || 'II', r: s.r || 'user:' || chr(10) || 'assistant:' || chr(10)}])[1] AS best
  FROM (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY i DESC) AS back FROM step) WHERE back = 1),
counts AS (
  SELECT conv, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE illegal) AS illegal FROM faulty GROUP BY conv)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(left(best.r, greatest(length(best.r) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends ON ends.conv = c.conv
"""
