"""Conversation repair, line dedup and word runs against plain versions, and their odd rows."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest

from gridloom.llm import convrepair, linededup, wordruns
from gridloom.llm.queries import ORACLE, QUERIES
from tests.conftest import SMALL
from tests.oracle_check import duck, rows_of


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_line_dedup", "op13_word_runs"])
def test_sql_small(spark, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    want = duck(SMALL).execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


# -- operator 11 ------------------------------------------------------------------------------

def slow_repair(rows):
    """(cost, audit) of (initial, truncated, gone) rows: all states with their least (cost, audit), row by row."""
    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for q, (cost, audit) in list(best.items()):
                t, v = ("a" if q == "u" else "u"), (cost + 3, audit + "I")
                best[t] = min(v, best.get(t, v))
        return best

    best = {"": (0, "")}
    for initial, truncated, gone in rows:
        after = {}
        for q, (cost, audit) in inserted(best).items():
            ways = [(q, 4, "D")]
            if not gone:
                want = "a" if q == "u" else "u"
                ways.append((want, 3 + 3 * truncated, "R"))
                if initial == want or (initial == "s" and q == ""):
                    ways.append((initial, 3 * truncated, "K"))
            for t, c, letter in ways:
                v = (cost + c, audit + letter)
                after[t] = min(v, after.get(t, v))
        best = after
    best = inserted(best)
    return min(best[q] for q in ("", "a") if q in best)


def test_repair_of_random_symbols_in_segments():
    rnd = random.Random(3)
    for _ in range(1500):
        rows = [(rnd.choice("suax") if rnd.random() < .5 else rnd.choice("ua"), rnd.random() < .2, rnd.random() < .2)
                for _ in range(rnd.randint(0, 12))]
        if rnd.random() < .3:
            rows = [r for r in rows for _ in range(rnd.randint(1, 5))]
        symbols = [convrepair._GONE if gone else convrepair._symbol(i, t) for i, t, gone in rows]
        cuts = sorted({0, len(symbols), *(rnd.randint(0, len(symbols)) for _ in range(2))})
        parts = [symbols[a:b] for a, b in zip(cuts, cuts[1:])]
        togo, after = convrepair._FINAL, []
        for part in reversed(parts):
            after.append(togo)
            for s, c in reversed(convrepair.collapse(part, [1] * len(part))):
                togo = convrepair.advance(s, c, togo)
        state, audit = convrepair._NONE, ""
        for part, end in zip(parts, reversed(after)):
            letters, state = convrepair.unroll(convrepair.collapse(part, [1] * len(part)), state, end)
            audit += letters
        assert (togo[convrepair._NONE], audit + convrepair._TAIL[state]) == slow_repair(rows)


def slow_conversations(rows):
    """{conv_id: all columns} of rows that are not damaged any more."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        seen, marked = set(), []
        count = dict(blank=0, duplicate=0, truncated=0)
        for _, _, role, text in mine:
            bare = text.rstrip(" \t\n\v\f\r")
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                     else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                count[fault] += 1
            marked.append((role[:1], fault == "truncated", fault in ("blank", "duplicate")))
        pairs = [a[0] + b[0] for a, b in zip(marked, marked[1:])]
        cost, audit = slow_repair(marked)
        lines, left, state = [], iter(mine), ""
        for letter in audit:
            row = None if letter == "I" else next(left)
            if letter != "D":
                role = row[2] if letter == "K" else "assistant" if state == "u" else "user"
                state = role[0]
                lines.append(f"{role}:{row[3] if row else ''}")
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"],
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, "\n".join(lines))
    return out


def repaired(spark, rows, schema="conv_id long, turn long, role string, text string"):
    df = spark.createDataFrame(rows, schema)
    fixed, segments, whole = convrepair.repair(df)
    lines, audits = {}, {}
    for r in sorted(fixed.collect(), key=lambda r: (r.seg, r.at)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in sorted(segments.collect(), key=lambda r: r.seg):
        audits[r.conv_id] = audits.get(r.conv_id, "") + r.audit
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, audits[r.conv_id],
                        "\n".join(lines.get(r.conv_id, []))) for r in whole.collect()}


def test_repair_of_long_conversations_and_ties(spark):
    rnd = random.Random(8)
    rows = [(c, rnd.choice([None, *range(40)]), rnd.choice(["user", "assistant", "system", "tool", "", "User"]),
             rnd.choice(["", " ", "Yes.", "no", "Well?\n", "a. b", "Stop!"])) for c in (1, 2, None) for _ in range(400)]
    rows += [(3, t, ["user", "assistant"][t % 2], f"text {t}{'.' * (t % 7 > 0)}") for t in range(0, 9000)]
    rows += [(4, 1, "user", "Same.")] * 20000 + [(4, 2, "assistant", "Other.")]
    got, want = repaired(spark, rows), slow_conversations(rows)
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv


def test_repair_odd_rows(spark):
    schema = "conv_id long, turn int, key string, role string, text string, seg int"
    rows = [(None, None, "x", None, None, 1), (7, 3, "x", "assistant", "Fine.", 1), (7, None, "x", "user", "Hi.", 1)]
    got = repaired(spark, rows, schema)
    assert got == {None: (0, 1, 0, 0, 0, 4, "D", ""), 7: (0, 0, 0, 0, 0, 0, "KK", "user:Hi.\nassistant:Fine.")}
    assert convrepair.digest(spark.createDataFrame([], schema)).collect() == []
    all_gone = [(n, 0, "user", "Hello.") for n in range(200)]
    lost = [n for n in range(200) if zlib.crc32(f"{n}:0".encode()) % 20 == 0]
    df = spark.createDataFrame(all_gone, "conv_id long, turn long, role string, text string")
    by_id = {r.conv_id: r for r in convrepair.digest(df).collect()}
    assert len(by_id) == 200 and lost
    for n in lost:
        r = by_id[n]
        assert (r.gaps, r.blank, r.illegal, r.cost, r.audit) == (0, 0, 0, 0, "")
        assert r.repaired_sha256 == hashlib.sha256(b"").hexdigest()


# -- operator 12 ------------------------------------------------------------------------------

def slow_lines(rows, least_chars=10, least_docs=2):
    """One (doc_id, n_lines, n_dropped, text) per row; ids order with null last."""
    order = lambda i: (i is None, i or 0)
    holders = {}
    split = [(i, (t or "").split("\n")) for i, t in rows]
    key = lambda line: re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))
    for i, lines in split:
        for line in lines:
            if len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, lines in split:
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= least_docs
                                         and i != min(holders[key(x)], key=order))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=lambda r: (order(r[0]), r[3], r[1], r[2]))


def test_line_dedup_odd_rows(spark):
    rnd = random.Random(2)
    stock = ["A common line here", " a Common line here\t", "ünïcödé 10", "tooshort", "ÄRGER IM BÜRO", "ärger im büro", "", "Only once in this text"]
    rows = [(rnd.choice([None, *range(12)]), "\n".join(rnd.choices(stock, k=rnd.randint(0, 9)))) for _ in range(120)]
    rows += [(5, None), (None, None), (6, ""), (7, "\n\n"), (8, "long line " * 30000 + "\nA common line here"), (8, "x\ty" * 7)] + [rows[0]] * 3
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], schema + ", h1 int, pos string")
    for least_docs in (2, 4):
        got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in
                      linededup.drop_shared_lines(df, least_docs=least_docs).collect()),
                     key=lambda r: ((r[0] is None, r[0] or 0), r[3], r[1], r[2]))
        assert got == slow_lines(rows, least_docs=least_docs)
    assert linededup.drop_shared_lines(spark.createDataFrame([], schema)).collect() == []


def test_hot_line_is_salted(spark):
    rows = [(i, f"everyone has this line\nbut this is line {i}") for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_dropped, r.text) for r in linededup.drop_shared_lines(df).collect()}
    assert got[0] == (0, rows[0][1]) and all(got[i] == (1, f"but this is line {i}") for i in range(1, 9000))


# -- operator 13 ------------------------------------------------------------------------------

def slow_runs(x, least=24, repeats=3):
    n, out = len(x), []
    for p in range(1, n // repeats + 1):
        i = 0
        while i + p < n:
            if x[i] != x[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and x[j] == x[j + p]:
                j += 1
            if j - i + p >= max(least, repeats * p):
                out.append((i, j + p, p))
            i = j
    return sorted((r for r in out if not any(q < r[2] and r[2] % q == 0 and s <= r[0] and e >= r[1] for s, e, q in out)),
                  key=lambda r: (r[0], r[2]))


def random_texts(rnd):
    for _ in range(rnd.randint(1, 10)):
        n, k = rnd.randint(0, 260), rnd.choice([1, 2, 3, 5, 50])
        x = [rnd.randrange(k) for _ in range(n)]
        for _ in range(rnd.randint(0, 4) if n > 30 else 0):
            a, p = rnd.randrange(n), rnd.randint(1, 20)
            for i in range(a + p, min(n, a + rnd.randint(20, 200))):
                x[i] = x[i - p]
        yield ([0] * rnd.randint(5, 40) + [1]) * rnd.randint(2, 8) if rnd.random() < .2 else x


def test_runs_equal_brute_force():
    rnd = random.Random(11)
    for _ in range(120):
        docs = list(random_texts(rnd))
        words = wordruns.words_of(pa.array([" ".join(map(str, x)) for x in docs]))
        ids, counts = wordruns.word_ids(words)
        assert counts.tolist() == [len(x) for x in docs]
        got = wordruns.runs_of(ids, counts)
        assert [got.get(d, []) for d in range(len(docs))] == [slow_runs(x) for x in docs]


def test_grammar_derives_every_place():
    """Equal symbols derive equal words, and every nonterminal lies in its document."""
    import numpy as np
    rnd = random.Random(4)
    docs = list(random_texts(rnd)) + [[1, 2, 3, 4] * 40, [7] * 130]
    ids, counts = wordruns.word_ids(wordruns.words_of(pa.array([" ".join(map(str, x)) for x in docs])))
    doc = np.repeat(np.arange(len(counts)), counts)
    sym, beg, mid, end = wordruns.grammar(ids, doc, 2)
    assert (doc[beg] == doc[end - 1]).all() and (beg < mid).all() and (mid < end).all()
    first = {}
    for s, b, m, e in zip(sym.tolist(), beg.tolist(), mid.tolist(), end.tolist()):
        a, k = first.setdefault(s, (ids[b:e].tolist(), m - b))
        assert a == ids[b:e].tolist() and k == m - b


def test_runs_odd_rows(spark):
    loop = " ".join(["la", "le", "lu"] * 9)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, f"a  b {loop}"), (4, loop + "\n" + " ".join(["x"] * 30)), (4, loop),
            (4, loop), (5, "non breaking \x1c stays" * 3), (6, "w " * 50000), (7, "one two three")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, runs int")
    got = {}
    for r in wordruns.find_runs(df).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    assert got[1] == got[2] == got[3] == [(0, [], "")]
    assert got[None] == [(29, [(2, 27, 3)], "a b la le lu")]
    assert sorted(got[4]) == sorted([(27, [(0, 27, 3)], "la le lu")] * 2 + [(57, [(0, 27, 3), (27, 30, 1)], "la le lu x")])
    assert got[5][0][0] == len((rows[7][1]).encode().split()) and got[5][0][2] == " ".join(rows[7][1].split(" "))
    assert got[6] == [(50000, [(0, 50000, 1)], "w")] and got[7] == [(3, [], "one two three")]
    best = wordruns.digest(wordruns.find_runs(df).where("doc_id = 4 and n_words = 57")).first()
    assert (best.n_runs, best.start, best.length, best.period, best.exponent_milli) == (2, 27, 30, 1, 30000)
    assert best.runs_sha256 == hashlib.sha256(b"0,27,3\n27,30,1\n").hexdigest()
    assert wordruns.find_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        wordruns.find_runs(df, least=10)
