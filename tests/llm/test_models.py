"""Language id, token files, divergence, Katz scores and PII against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import divergence, katz, langid, piiboost, tokenfile, tokens
from gridloom.llm.queries import vocabulary
from gridloom.sources.tables import read_table
from tests.conftest import SMALL, SMOKE

DOC = "doc_id long, text string, lang string, source string, n_chars long, n string, kind string"
WORD = re.compile("[^\x20\x09-\x0D]+")


def odd_docs(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "Word"), (5, "a b c d e f g h i j a b c d e f g h i j"), (5, "a b c d e f g h i j a b c d e f g h i j"),
            (None, "no id here"), (7, "é" * 5000 + " x" * 20000), (8, "12 34 &&"), (9, "line\nline\n\nline ")]
    return spark.createDataFrame([(d, t, "en" if (d or 0) % 2 else None, None, None, "x", "y") for d, t in rows], DOC), rows


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# ------------------------------------------------------------------ language

def test_language_accuracy_on_held_out(spark):
    docs = read_table(spark, SMALL, "documents")
    got = langid.identify(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 3 == 1)).all()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97


def test_language_odd_rows(spark):
    docs, rows = odd_docs(spark)
    got = langid.identify(docs).toPandas()
    assert len(got) == len(rows)
    assert set(got.lang_pred[got.doc_id.isin([1, 2, 3, 8])]) == {"und"}
    unlabelled = docs.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0
    long = langid.windows("ab" * 1000)
    assert len(long) == 8 and bytes(long[1][:4]) == b"abab"


# ------------------------------------------------------------------ token files

def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    blocks = [rng.integers(0, 50257, n).astype(np.uint32) for n in (0, 1, 2, 31, 32, 33, 900)]
    blocks += [np.zeros(700, np.uint32), np.tile(np.arange(40, dtype=np.uint32), 30), rng.integers(0, 2 ** 32, 64, dtype=np.uint32)]
    coded = tokenfile.encode_blocks(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, tokenfile.decode_blocks(coded)))
    assert len(coded[8]) < 400  # the contexts learn a repetition
    damaged = bytearray(coded[6])
    damaged[-200] ^= 0x55
    with pytest.raises(ValueError):
        tokenfile.decode_blocks([bytes(damaged)])


def test_block_is_coded_in_streams(monkeypatch):
    rng = np.random.default_rng(2)
    steps = []
    learn = tokenfile._Model.learn
    monkeypatch.setattr(tokenfile._Model, "learn", lambda self, *a: (steps.append(1), learn(self, *a)))
    blocks = [rng.zipf(1.4, 4096).clip(0, 50256).astype(np.uint32) for _ in range(3)]
    coded = tokenfile.encode_blocks(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, tokenfile.decode_blocks(coded)))
    assert len(steps) <= 2 * 4096 // 32  # not one step an id
    for n in (127, 128, 255, 256, 257, 385, 4000, 4095):  # streams of unequal length, alone and side by side
        block = rng.zipf(1.4, n).clip(0, 50256).astype(np.uint32)
        assert np.array_equal(tokenfile.decode_blocks(tokenfile.encode_blocks([block]))[0], block)
        blocks.append(block)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, tokenfile.decode_blocks(tokenfile.encode_blocks(blocks))))


def test_damaged_block_is_found():
    rng = np.random.default_rng(3)
    block = rng.zipf(1.4, 1500).clip(0, 50256).astype(np.uint32)
    coded = tokenfile.encode_blocks([block])[0]
    for at in range(8, len(coded), 37):
        damaged = bytearray(coded)
        damaged[at] ^= 1 + at % 255
        try:
            got = tokenfile.decode_blocks([bytes(damaged)])[0]
        except ValueError:
            continue
        assert np.array_equal(got, block)  # a byte that no id depends on
    with pytest.raises(ValueError):
        tokenfile.decode_blocks([coded[:-2]])


def test_bits_an_id_of_documents(spark):
    texts = [r.text for r in read_table(spark, SMOKE, "documents").orderBy("doc_id").collect()]
    ids = np.concatenate(tokens.encode(texts, vocabulary(tokenfile.VOCABULARY)))
    blocks = [ids[i:i + tokenfile.BLOCK] for i in range(0, len(ids), tokenfile.BLOCK)]
    assert 8 * sum(map(len, tokenfile.encode_blocks(blocks))) / len(ids) < 9.1


def check_digest(rows, docs, path):
    want = sorted(((d is not None, d, t) for d, t in docs), key=lambda x: (x[0], x[1] or 0))
    got = sorted(rows, key=lambda r: r.start)
    start = 0
    assert [r.doc_id for r in got] == [d for _, d, _ in want]
    for r, (_, _, text) in zip(got, want):
        ids = np.array(tokens.tokenizer(path).encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_round_trip(spark):
    path = vocabulary(tokenfile.VOCABULARY)
    docs = read_table(spark, SMOKE, "documents")
    check_digest(tokenfile.digest(tokenfile.write_tokens(docs, path)).collect(), [(r.doc_id, r.text) for r in docs.collect()], path)
    docs, rows = odd_docs(spark)
    check_digest(tokenfile.digest(tokenfile.write_tokens(docs, path)).collect(), rows, path)
    assert tokenfile.digest(tokenfile.write_tokens(docs.limit(0), path)).count() == 0


# ------------------------------------------------------------------ divergence

def slow_base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed)


@pytest.mark.parametrize("base", [SMOKE, None])
def test_quality_base_equals_brute_force(spark, base):
    docs = read_table(spark, base, "documents") if base else odd_docs(spark)[0]
    want = sorted(slow_base(r.text) for r in docs.collect())
    got = divergence.rate(docs).collect()
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_quality_keeps_clean_and_drops_junk(spark):
    docs = read_table(spark, SMALL, "documents")
    got = divergence.rate(docs).toPandas().merge(read_table(spark, SMALL, "labels").toPandas(), on="doc_id")
    got = got[~got.base_failed]
    assert got.kept[got.quality == 1].mean() > 0.99 and got.kept[got.quality == 0].mean() < 0.1
    kept = divergence.keep(docs)
    assert kept.columns == docs.columns and kept.count() == divergence.rate(docs).where("kept").count()
    assert divergence.rate(docs.limit(0)).count() == 0 and divergence.keep(docs.limit(0)).count() == 0


RUSSIAN = "и в не на что он с как это по но они мы за все она так его только когда"
POLISH = "się że być może także więc już są dość który również będzie zależy między przed"


def common_text(rng, common, letters, n=60):
    """Two words in three are common ones, the others random letters."""
    return " ".join(rng.choice(common) if rng.random() < 0.67 else "".join(rng.choices(letters, k=7)) for _ in range(n))


@pytest.mark.parametrize("common", [RUSSIAN, POLISH])
def test_quality_words_of_any_script(spark, monkeypatch, common):
    rng, words = random.Random(5), common.split()
    letters = sorted(set(common) - {" "})
    good = [common_text(rng, words, letters).capitalize() + ("." if i % 2 else "»") for i in range(60)]
    salad = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 8))) for _ in range(60)) for _ in range(4)]
    docs = spark.createDataFrame([(i, t, "xx", None, None, "x", "y") for i, t in enumerate(good + salad)], DOC).repartition(3)
    ref = divergence.references(docs)["xx"]
    counts = Counter(w.lower().strip(".»") for t in good + salad for w in t.split())
    want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:divergence.COMMON_WORDS]
    assert list(zip(ref["words"], ref["counts"])) == want and set(words) <= set(ref["words"])
    assert sum(ref["counts"]) == sum(counts.values()) and any(len(w) > 4 for w in ref["words"])
    got = {r.doc_id: r for r in divergence.rate(docs).collect()}
    assert all(got[i].kept for i in range(60)) and not any(got[i].kept or got[i].base_failed for i in range(60, 64))
    batches = [pa.RecordBatch.from_pylist([{"doc_id": i, "text": t, "lang": "xx"}]) for i, t in enumerate(good)]
    whole = list(divergence._reference_counts(iter(batches)))
    monkeypatch.setattr(divergence, "HELD_WORDS", 50)
    parts = list(divergence._reference_counts(iter(batches)))
    sums = [Counter() for _ in range(2)]
    for total, sent in zip(sums, (whole, parts)):
        for r in (r for b in sent for r in b.to_pylist()):
            total[r["lang"], r["kind"], r["what"]] += r["n"]
    assert len(parts) > len(whole) == 1 and sums[0] == sums[1]


def test_quality_numbers_alone(spark):
    rng, words = random.Random(6), "the of and to in is that it for was".split()
    clean = [common_text(rng, words, "abcdefghijklmnopqrstuvwxyz", 30) for _ in range(60)]
    held = [f"{common_text(rng, words, 'abcdefghijklmnopqrstuvwxyz', n)} +1 (555) 123-4567, 4111 1111 1111 1111 {rng.choice(words)}"
            for n in (16, 20, 25, 30) for _ in range(4)]
    held += [common_text(rng, words, "abcdefghijklmnopqrstuvwxyz", 38).replace(" the ", " 1694893019727317 ", 3) + " 2024" for _ in range(4)]
    numbers = [" ".join(str(rng.randrange(10 ** (size - 1), 10 ** size)) for _ in range(n)) for size in (1, 2, 3, 4, 6, 8) for n in (20, 25, 30, 39)]
    numbers += [" ".join("".join(rng.choices("٠١٢٣٤٥٦٧٨٩", k=6)) for _ in range(30)), " ".join(f"{rng.randrange(100, 999)}.{i}," for i in range(25)),
                "the " + " ".join(str(rng.randrange(1000, 9999)) for _ in range(29))]
    texts = clean + held + numbers
    docs = spark.createDataFrame([(i, t, "en", None, None, "x", "y") for i, t in enumerate(texts)], DOC)
    got = sorted(divergence.rate(docs).collect())
    assert not any(r.base_failed for r in got[80:-3]) and all(r.n_words < 40 for r in got[80:])
    assert [r.doc_id for r in got if r.kept] == list(range(80))


def test_js_distance():
    assert divergence.js_distance(np.array([1.0, 0]), np.array([0, 1.0])) == 1.0
    assert divergence.js_distance(np.array([2.0, 2]), np.array([1.0, 1])) == 0.0
    assert divergence.js_distance(np.zeros(2), np.array([1.0, 1])) == 0.0


# ------------------------------------------------------------------ Katz

def slow_katz(docs):
    sent = [[*WORD.findall(lower(t)), " end"] for _, t in docs]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in docs]
    uni, bi, hist = Counter(), Counter(), Counter()
    for s, out in zip(sent, held):
        if not out:
            uni.update(s)
            bi.update(zip([" start", *s], s))
            hist.update([" start", *s[:-1]])
    total, size = sum(uni.values()), len(uni)
    d1 = katz.discounts([list(uni.values()).count(r) for r in range(1, 7)])
    d2 = katz.discounts([list(bi.values()).count(r) for r in range(1, 7)])
    cut = lambda d, c: c * (d[c] if c <= 5 else 1.0)
    freed = total - sum(cut(d1, c) for c in uni.values())
    all_seen = not any(c <= 5 for c in uni.values())

    def p1(w):
        if all_seen:
            return (uni[w] or 1.0) / (total + 1)
        return (cut(d1, uni[w]) if uni[w] else freed) / total

    after = {}
    for (h, w), c in bi.items():
        after.setdefault(h, {})[w] = c

    def p2(h, w):
        if not hist[h]:
            return p1(w)
        whole = hist[h] + (not any(c <= 5 for c in after[h].values()))
        if bi[h, w]:
            return cut(d2, bi[h, w]) / whole
        return (1 - sum(cut(d2, c) for c in after[h].values()) / whole) / (1 - sum(map(p1, after[h]))) * p1(w)

    out = []
    for (d, _), s, o in zip(docs, sent, held):
        base = sum(math.log10((uni[w] + 0.5) / (total + 0.5 * (size + 1))) for w in s)
        out.append((d, o, len(s), sum(uni[w] > 0 for w in s), total, base, sum(math.log10(p2(h, w)) for h, w in zip([" start", *s], s))))
    # each history's distribution over the words and the unknown one sums to one
    for h in list(after)[:20]:
        assert abs(sum(p2(h, w) for w in uni) + p2(h, " unknown") - 1) < 1e-9
    return out


@pytest.mark.parametrize("which", ["table", "odd", "saturated"])
def test_katz_equals_brute_force(spark, which, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 5000)
    if which == "table":
        docs = read_table(spark, SMOKE, "documents")
    elif which == "odd":
        docs = odd_docs(spark)[0]
    else:
        docs = spark.createDataFrame([(i, "a b a b c" if i % 9 else "a c b z a a") for i in range(200)] + [(200 + i, "a b a b c") for i in range(60)],
                                     "doc_id long, text string")
    want = sorted(slow_katz([(r.doc_id, r.text) for r in docs.collect()]), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    got = sorted(map(tuple, katz.score(docs).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


def test_katz_edges(spark):
    assert katz.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    only_held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = katz.score(spark.createDataFrame([(only_held, "a b")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (3, 0, 0, 0.0)
    a = [np.array([5, 1 << 40, 0], np.uint64), np.array([0.5, -2.0]), np.array([], np.int64)]
    assert all(np.array_equal(x, y) for x, y in zip(a, katz.unpack(katz.pack(*a))))
    d = katz.discounts([1000, 400, 220, 140, 100, 75])
    assert (d[1:] > 0).all() and (d[1:] < 1).all()


# ------------------------------------------------------------------ PII

def slow_spans(t):
    t = t or ""
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        s = sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and s % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], piiboost.KINDS.index(s[2])))


def test_base_spans_equal_plain_patterns():
    rng = np.random.default_rng(5)
    for _ in range(8000):
        t = "".join(rng.choice(list("aZ9.12 -+@()_%5\n0é"), rng.integers(0, 60)))
        assert piiboost.base_spans(t) == slow_spans(t)


def test_pii_query_and_redaction(spark):
    docs = read_table(spark, SMALL, "documents")
    got = {r.doc_id: r for r in piiboost.search(docs).collect()}
    import hashlib

    for r in docs.collect():
        base, g = slow_spans(r.text), got[r.doc_id]
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(s[2] == k for s in base) for k in piiboost.KINDS]
        assert g.base_sha256 == hashlib.sha256(piiboost.listed(base).encode()).hexdigest()
        assert set(filter(None, piiboost.listed(base).split(","))) <= set(filter(None, g.spans.split(",")))
    clean = piiboost.redact(docs)
    assert clean.columns == docs.columns and not any(slow_spans(r.text) for r in clean.collect())
    odd, rows = odd_docs(spark)
    assert piiboost.search(odd).count() == len(rows) and piiboost.search(odd.limit(0)).count() == 0
    assert [r.text for r in piiboost.redact(odd).collect()].count(None) == 1


def test_training_windows_come_from_the_whole_text(spark):
    docs = spark.createDataFrame([(d, " ".join(f"{'word ' * 60}{i}" for i in range(100, 300)), None, None, None, "x", "y") for d in range(5)]
                                 + [(9, "call 555", None, None, None, "x", "y")], DOC)
    windows = piiboost.sample_windows(docs)
    at = [int(re.search("[0-9]+", w).group()) for w in windows]
    assert len(windows) == 5 * piiboost.SAMPLE_WINDOWS + 1 and "call 555" in windows
    assert sum(150 < i < 300 for i in at) > 50 and windows == piiboost.sample_windows(docs)


def test_boosted_candidates_generalise():
    model = piiboost.train([])
    found = lambda t: [(t[a:b], k) for a, b, k in piiboost.find(t, model)[1]]
    assert found("write to john.doe (at) example.com now") == [("john.doe (at) example.com", "email")]
    assert found("call (555) 123-4567 today") == [("(555) 123-4567", "phone")]
    assert found("card 4111.1111.1111.1111 ok") == [("4111.1111.1111.1111", "card")]
    assert found("555-3296 4524132264652876 and") == [("4524132264652876", "card")]
    assert found("on 2024-10-12 paid 1,234,567 for v1.2.3.4000") == []
