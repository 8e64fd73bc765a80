"""SimHash and embedding near-dedup against brute force."""

import numpy as np
import xxhash
from pyspark.sql import types as T

from gridloom.llm import embeddup, simhash
from gridloom.llm.common import components
from gridloom.sources.tables import read_table
from tests.conftest import SMALL


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = sorted((find(a), find(b)))
        parent[rb] = ra
    return [find(i) for i in range(n)]


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark):
    docs = read_table(spark, SMALL, "documents")
    text = docs.orderBy("doc_id").toPandas()
    got = simhash.dedup(docs).toPandas().sort_values("doc_id")
    fp = [slow_fingerprint(t) for t in text.text]
    assert got.fingerprint.tolist() == [f"{f:016x}" for f in fp]
    a = np.array(fp, np.uint64)
    near = np.argwhere(np.bitwise_count(a[:, None] ^ a[None]) <= 4)
    want = roots(len(fp), [(i, j) for i, j in near if i < j])
    assert got.component_id.tolist() == [int(text.doc_id[r]) for r in want]
    assert len(set(want)) < len(want)


def test_simhash_odd_rows(spark):
    schema = "doc_id long, fp int, text string, lang string, source string, n_chars long, component_id string"
    rows = [(5, 1, None, None, None, None, "x"), (3, 1, "", None, None, None, "x"), (9, 1, " \n ", None, None, None, "x"),
            (7, 1, "one two three four five", None, None, None, "x"), (7, 1, "one two three four five", None, None, None, "x"),
            (None, 1, "ONE two three four five", None, None, None, "x"), (8, 1, "other words stand here now " * 30000, None, None, None, "x")]
    docs = spark.createDataFrame(rows, schema)
    got = {(r.doc_id, r.component_id) for r in simhash.dedup(docs).collect()}
    assert got == {(5, 3), (3, 3), (9, 3), (7, 7), (None, 7), (8, 8)}
    kept = simhash.keep_first(docs).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [3, 7, 8] and kept[0].asDict().keys() == rows_names(schema)
    assert simhash.dedup(docs.limit(0)).count() == 0 and simhash.keep_first(docs.limit(0)).count() == 0


def test_one_row_a_component_with_repeated_and_null_ids(spark):
    rng = np.random.default_rng(3)
    base = [" ".join(rng.choice(list("abcdefghij"), (400, 5)).view("<U5").ravel().tolist()) for _ in range(4)]
    near = [b + " end" for b in base]
    assert all((slow_fingerprint(b) ^ slow_fingerprint(n)).bit_count() <= 4 and b != n for b, n in zip(base, near))
    rows = [(1, base[0]), (5, base[1]), (5, near[1]), (2, near[0]), (5, base[0]), *[(None, base[2])] * 40, (None, near[2]), (None, near[1]), (6, base[3]), (None, near[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_first(docs).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert [r[0] for r in kept] == [1, 5, 6, None]
    assert kept[0][1] == base[0] and kept[1][1] in (base[1], near[1]) and kept[3][1] in (base[2], near[2])


def test_fingerprints_without_ids_link_and_bridge(spark):
    """Distances 3 and 3 over a text that no named row has; the ends are 6 apart."""
    fps = spark.createDataFrame([(5, 0b000000), (None, 0b000111), (9, 0b111111), (None, 1 << 40), (None, (1 << 40) | 1)], "doc_id long, fp long")
    reps = fps.groupBy("fp").agg({"doc_id": "min"}).selectExpr("fp", "fp AS rep")
    classes = {r.node: r.component for r in components(simhash.links(reps, 4), "a", "b").collect()}
    assert classes[0] == classes[7] == classes[63] and classes[1 << 40] == classes[(1 << 40) | 1]
    rng = np.random.default_rng(3)
    base = " ".join(rng.choice(list("abcdefghij"), (400, 5)).view("<U5").ravel().tolist())
    assert (slow_fingerprint(base) ^ slow_fingerprint(base + " end")).bit_count() <= 4
    docs = spark.createDataFrame([(5, base), (None, base + " end"), (None, "some other words that stand alone here")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.dedup(docs).collect()), key=str)
    assert got == [(5, 5), (None, 5), (None, None)]
    named = docs.selectExpr("doc_id", "text", "1 AS _copy_key")
    assert [r._copy_key for r in simhash.keep_first(named).collect()] == [1, 1]


def rows_names(schema):
    return {c.split()[0]: 0 for c in schema.split(", ")}.keys()


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(900, 960)] + [(5000 - i, 6000) for i in range(50)]
    edges += [tuple(map(int, rng.integers(10000, 10400, 2))) for _ in range(250)] + [(42, 42)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    ids = sorted({x for e in edges for x in e if e[0] != e[1]})
    at = {x: i for i, x in enumerate(ids)}
    want = roots(len(ids), [(at[a], at[b]) for a, b in edges if a != b])
    assert got == {x: ids[w] for x, w in zip(ids, want)}


def brute_vectors(ids, vectors):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    links, pairs = [0] * len(ids), []
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if o else None for v, o in zip(vectors, ok)]
    for i in range(len(ids)):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    return links, roots(len(ids), pairs)


def test_embeddings_equal_brute_force(spark):
    emb = read_table(spark, SMALL, "embeddings")
    p = emb.orderBy("vec_id").toPandas()
    links, want = brute_vectors(p.vec_id.tolist(), p.embedding.tolist())
    got = embeddup.dedup(emb).toPandas().sort_values("vec_id")
    assert got.n_links.tolist() == links and got.component_id.tolist() == [int(p.vec_id[r]) for r in want]
    assert got.kept.tolist() == (got.vec_id == got.component_id).tolist()


def test_embeddings_large_buckets_and_copies(spark, monkeypatch):
    """Tiles smaller than the buckets, a dense cluster, exact copies and bad vectors."""
    monkeypatch.setattr(embeddup, "TILE", 16)
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    rows = [(base + rng.normal(scale=0.15, size=8)).tolist() for _ in range(120)] + [rng.normal(size=8).tolist() for _ in range(200)]
    rows += [rows[0]] * 30 + [None, [], [0.0] * 8, [float("nan")] * 8, [None] * 8, [float("inf")] * 8, [1.0, 2.0], [2.0, 4.0], [1e300, 0.0], [1e-300, 0.0]]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("rep", T.StringType())])
    got = embeddup.dedup(spark.createDataFrame([(i, v, "x") for i, v in enumerate(rows)], schema)).toPandas().sort_values("vec_id")
    rows = [[1.0, 0.0] if v and max(map(abs, filter(None, v)), default=0) in (1e300, 1e-300) else v for v in rows]
    links, want = brute_vectors(list(range(len(rows))), rows)
    assert got.component_id.tolist() == want and got.n_links.tolist() == links
    empty = spark.createDataFrame([], schema)
    assert embeddup.dedup(empty).count() == 0


def test_recall_plan():
    for n in (10, 10 ** 5, 10 ** 9):
        bits, tables = embeddup.plan(n)
        assert (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** tables <= 0.001
