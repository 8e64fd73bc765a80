"""Mixing, packing and preference formatting."""

import collections
import itertools
import math
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from gridloom.llm import mixing, packing, preference, tokens
from gridloom.llm.queries import vocabulary
from gridloom.sources.tables import read_table
from tests.conftest import SMALL, SMOKE
from tests.oracle_check import duck, rows_of

DOC = "doc_id long, text string, lang string, source string, n_chars long, size string, copies string"


@pytest.mark.parametrize("name", ["op4_mixing", "op6_preference"])
@pytest.mark.parametrize("base", [SMOKE, SMALL])
def test_query_matches_oracle(spark, name, base):
    got, want = entry.queries()[name](spark, base).toPandas(), duck(base).execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


def slow_targets(sizes):
    """Clip and reshare until nothing is above twice its size."""
    keys = sorted(sizes)
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(keys)}
    left, free, out = 1.5 * sum(sizes.values()), set(keys), {}
    while free:
        share = {k: left * weight[k] / sum(weight[x] for x in free) for k in free}
        over = {k for k in free if share[k] > 2 * sizes[k]}
        if not over:
            out.update(share)
            break
        for k in over:
            out[k] = 2.0 * sizes[k]
            left -= out[k]
        free -= over
    return out


def test_mix_reaches_its_targets(spark):
    got = mixing.taken(read_table(spark, SMALL, "documents")).toPandas()
    src = read_table(spark, SMALL, "documents").select("doc_id", "source").toPandas()
    p = got.merge(src, on="doc_id")
    want = slow_targets({("0" + s): int(n) for s, n in p.groupby("source")["size"].sum().items()})
    for s, g in p.groupby("source"):
        assert math.isclose(g.target.iloc[0], want["0" + s], rel_tol=1e-12)
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max()
    assert (p.taken <= 2 * p["size"]).all()


def test_mix_odd_rows(spark):
    rows = [(i, "a b c", None, "s", None, "x", "y") for i in range(300)] + [(i, "w " * (i % 7), None, None, None, "x", "y") for i in range(40)]
    rows += [(None, None, None, "zero", 0, "x", "y"), (None, "one", None, "\U0001F600", 0, "x", "y")]
    docs = spark.createDataFrame(rows, DOC)
    got = mixing.taken(docs).toPandas()
    assert len(got) == len(rows) and (got.taken <= 2 * got["size"]).all()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and sum(len(r.text.split()) for r in mixed.collect()) == got.taken.sum()
    assert mixing.taken(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ packing

def fewest_bins(items, cap):
    """Exact optimum by trying every bin for every item."""
    best = [len(items)]

    def go(i, room):
        if len(room) >= best[0]:
            return
        if i == len(items):
            best[0] = len(room)
            return
        for j in range(len(room)):
            if room[j] >= items[i]:
                room[j] -= items[i]
                go(i + 1, room)
                room[j] += items[i]
        go(i + 1, room + [cap - items[i]])

    items = sorted(items, reverse=True)
    go(0, [])
    return best[0]


def test_search_finds_the_optimum():
    rng = np.random.default_rng(4)
    for _ in range(40):
        items = rng.integers(15, 70, 9).tolist()
        patterns = packing.solve(dict(collections.Counter(items)), 100)
        assert sum(m for m, _ in patterns) == fewest_bins(items, 100)
        assert sorted(x for m, p in patterns for x in p * m) == sorted(items) and all(sum(p) <= 100 for _, p in patterns)
    assert packing.solve({}, 100) == []
    assert packing.solve({100: 10 ** 12}, 100) == [(10 ** 12, (100,))]


def test_fillings_are_undominated():
    counts = np.bincount([50, 30, 20, 20, 10], minlength=101)
    assert packing.fillings(counts, 50) == [(50,)]
    found = packing.fillings(counts, 45)
    assert sum(found[0]) == 40 and not any(packing._dominated(a, b) for a in found for b in found)


def test_every_maximal_filling_is_enumerated():
    rng = np.random.default_rng(9)
    for _ in range(60):
        items = rng.choice([8, 12, 20, 27, 30, 33, 41], 9).tolist()
        counts = np.bincount(items, minlength=101).astype(np.int64)
        want = set()
        for r in range(len(items) + 1):
            for some in itertools.combinations(sorted(items, reverse=True), r):
                rest = collections.Counter(items) - collections.Counter(some)
                if sum(some) <= 60 and all(x > 60 - sum(some) for x in rest.elements()):
                    want.add(some)
        found = list(packing.maximal_fillings(counts, 60, [10 ** 6]))
        assert len(found) == len(set(found)) and set(found) == want
        tried = list(packing.options(counts, 60, [10 ** 6]))
        assert set(tried) <= want and all(f in tried or any(packing._dominated(f, g) for g in tried) for f in want)
        assert len(list(packing.maximal_fillings(counts, 60, [3]))) <= 3


def test_lower_bound_and_repeated_lengths():
    rng = np.random.default_rng(5)
    for _ in range(60):
        items = rng.choice([20, 30, 35, 40, 45, 50, 55, 61], rng.integers(3, 11)).tolist()
        best = fewest_bins(items, 100)
        assert packing.lower_bound(np.bincount(items, minlength=101), 100) <= best
        assert sum(m for m, _ in packing.solve(dict(collections.Counter(items)), 100)) == best
    assert packing.lower_bound(np.bincount([51] * 7 + [10], minlength=101), 100) == 7


def check_packed(rows, docs, cap, path, end=1):
    texts = {d: t for d, t in docs}
    per_doc, per_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        per_doc[r.doc_id].append(r)
        per_seq[r.sequence_id].append(r)
    assert set(per_doc) == set(texts)
    for d, pieces in per_doc.items():
        ids = tokens.tokenizer(path).encode(texts[d] or "", add_special_tokens=False).ids + [end]
        pieces.sort(key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(-(-len(ids) // cap)))
        for p in pieces:
            part = np.array(ids[p.start:p.start + p.length], "<u4")
            assert p.start == p.piece * cap and p.length == min(cap, len(ids) - p.start) and p.ids_crc32 == zlib.crc32(part.tobytes())
    for s in per_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= cap
    return len(per_seq)


def test_packing_whole_table(spark):
    path = vocabulary(packing.VOCABULARY)
    docs = read_table(spark, SMOKE, "documents")
    rows = packing.pack(docs, path).collect()
    used = check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], 4096, path)
    assert used == -(-sum(r.length for r in rows) // 4096)


def test_packing_odd_rows(spark):
    path = vocabulary(packing.VOCABULARY)
    texts = [(1, None), (2, ""), (3, "word " * 900), (4, " odd \t\n\n white  space "), (5, "a"), (6, "a")]
    docs = spark.createDataFrame([(d, t, None, None, None, "x", "y") for d, t in texts], DOC)
    check_packed(packing.pack(docs, path, capacity=64).collect(), texts, 64, path)
    assert packing.pack(docs.limit(0), path).count() == 0
    twice = packing.pack(docs.where("doc_id is not null").union(docs), path, 64).collect()
    assert len(twice) == 2 * len(packing.pack(docs, path, 64).collect()) == 2 * len({(r.doc_id, r.piece) for r in twice})
    kept = packing.pack(docs, path, 64, keep_ids=True)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(kept).collect()}
    for r in kept.collect():
        assert whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_piecewise_tokens_equal_whole_text(name):
    rng = np.random.default_rng(6)
    alphabet = [*"abC éÉ'sßΣσ 123 \n\n\t\r\x1c\x85\xa0　́ .,!👍", "'s", "'ll", "  ", "\n\n", " \n", "<|endoftext|>", "<|startoftext|>"]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 40))) for _ in range(2000)] + [None, "", "\n", " "]
    path = vocabulary(name)
    want = [tokens.tokenizer(path).encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in tokens.encode(texts, path)] == want


# ------------------------------------------------------------------ preference

def _pairs(conv):
    """Conversation 2k as the chosen and 2k + 1 as the rejected side of pair k."""
    return conv.where("conv_id is not null").selectExpr("conv_id div 2 AS pair_id", "conv_id % 2 = 0 AS chosen", "turn", "role", "text", "pos")


def test_branched_pairs_share_a_prefix(spark):
    rows = [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 2, "user", "c"), (0, 3, "assistant", "d"), (1, 0, "user", "e"),
            (1, None, "assistant", "f"), (1, 1, "assistant", "g"), (2, 0, "assistant", "h"), (4, 0, "user", "i"), (None, 0, "user", "j")]
    conv = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {}
    for r in preference.branched_pairs(conv).collect():
        got.setdefault((r.pair_id, r.chosen), []).append((r.turn, r.role, r.text))
    order = lambda t: (t[0] is not None, t[0] or 0, t[2])
    got = {k: sorted(v, key=order) for k, v in got.items()}
    assert got[(0, True)] == [(t, r, x) for c, t, r, x in rows if c == 0]
    cut = got[(0, False)][-1][0]
    assert cut in (1, 3) and got[(0, False)] == [r for r in got[(0, True)] if r[0] < cut] + [(cut, "assistant", "f")]
    assert got[(1, False)] == [(None, "assistant", "f"), (0, "user", "e"), (1, "assistant", "b")]
    assert (2, False) not in got and (4, False) not in got and {k[0] for k in got} == {0, 1, 2, 4}
    out = {r.pair_id: r.n_prompt_turns for r in preference.format_pairs(preference.branched_pairs(conv)).collect()}
    assert out == {0: cut, 1: 2, 2: 0, 4: 0}


def test_prefixes_of_several_lengths(spark):
    from gridloom.llm.queries import QUERIES
    lengths = {r.n_prompt_turns for r in QUERIES["op6_preference"](spark, SMOKE).collect()}
    assert len(lengths) >= 3


def test_preference_prefix_and_masks(spark):
    a = [("system", "s"), ("user", "hi"), ("assistant", "one"), ("user", "go"), ("assistant", "x")]
    b = [("system", "s"), ("user", "hi"), ("assistant", "two")]
    rows = [(0, i, r, t, "x") for i, (r, t) in enumerate(a)] + [(1, i, r, t, "x") for i, (r, t) in enumerate(b)]
    rows += [(2, 0, "user", None, "x"), (3, 0, "user", None, "x"), (3, 1, None, "", "x"), (5, 0, "user", "alone", "x"), (None, 0, "user", "lost", "x")]
    rows += [(6, 0, "user", "same", "x"), (7, 0, "user", "same", "x")]
    conv = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, pos string")
    got = {r.pair_id: r for r in preference.format_pairs(_pairs(conv)).collect()}
    assert sorted(got) == [0, 1, 2, 3]
    r = got[0]
    assert r.n_prompt_turns == 2 and r.prompt == "<|system|>\ns<|end|>\n<|user|>\nhi<|end|>\n"
    assert [r.chosen[slice(*map(int, s.split(":")))] for s in r.chosen_mask.split(",")] == ["one<|end|>", "x<|end|>"]
    assert [r.rejected[slice(*map(int, s.split(":")))] for s in r.rejected_mask.split(",")] == ["two<|end|>"]
    assert got[1].n_prompt_turns == 1 and got[1].chosen == "" and got[1].rejected == "<|none|>\n<|end|>\n"
    assert (got[2].prompt, got[2].chosen, got[2].chosen_mask, got[2].rejected) == ("", "", "", "<|user|>\nalone<|end|>\n")
    assert got[3].chosen == got[3].rejected == "" and got[3].n_prompt_turns == 1
    assert preference.format_pairs(_pairs(conv.limit(0))).count() == 0
