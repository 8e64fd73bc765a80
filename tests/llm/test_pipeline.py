"""Every stage of the corpus pipeline against a plain version on its own input."""

import collections

import numpy as np

import corpus_pipeline as cp
from gridloom.llm import divergence, mixing, packing
from gridloom.llm.common import stored
from gridloom.llm.queries import vocabulary
from gridloom.sources.tables import read_table
from tests.conftest import SMOKE
from tests.llm.test_dedup import roots, slow_fingerprint
from tests.llm.test_mix_pack import slow_targets
from tests.llm.test_models import WORD, slow_base, slow_spans


def test_stages(spark):
    docs = read_table(spark, SMOKE, "documents")
    columns, results = docs.columns, {}
    for name, stage in cp.STAGES:
        results[name] = (docs, out := stored(stage(spark, docs, SMOKE), f"t-{name}"))
        docs = out
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "simhash_dedup", "pii", "mixing", "packing"]
    assert all(out.columns == columns for name, (_, out) in results.items() if name != "packing")

    before, after = (d.toPandas() for d in results["quality_rules"])
    verdict = divergence.rate(results["quality_rules"][0]).toPandas().set_index("doc_id")
    assert set(after.doc_id) == set(verdict.index[verdict.kept]) and len(after) < len(before)
    assert not any(slow_base(t)[-1] for t in after.text)

    before, after = (d.toPandas().sort_values("doc_id") for d in results["simhash_dedup"])
    fp = np.array([slow_fingerprint(t) for t in before.text], np.uint64)
    near = np.argwhere(np.bitwise_count(fp[:, None] ^ fp[None]) <= 4)
    ids = before.doc_id.tolist()
    assert after.doc_id.tolist() == sorted({ids[r] for r in roots(len(ids), [(i, j) for i, j in near if i < j])})

    before, after = (d.toPandas().sort_values("doc_id") for d in results["pii"])
    assert before.doc_id.tolist() == after.doc_id.tolist() and (after.n_chars == after.text.str.len()).all()
    for a, b in zip(before.text, after.text):
        assert not slow_spans(b)
        assert a == b or slow_spans(a) or "<" in b

    before, after = (d.toPandas() for d in results["mixing"])
    size = dict(zip(before.doc_id, (len(WORD.findall(t)) for t in before.text)))
    source = dict(zip(before.doc_id, before.source))
    totals = collections.Counter()
    for d, n in size.items():
        totals["0" + source[d]] += n
    times = collections.Counter(after.doc_id)
    assert max(times.values()) <= 2 and set(times) <= set(size)
    taken = mixing.taken(results["mixing"][0]).toPandas().set_index("doc_id")
    assert all(taken.taken[d] == size[d] * times.get(d, 0) for d in size)
    for s, target in slow_targets(totals).items():
        mine = [d for d in size if "0" + source[d] == s]
        assert abs(sum(size[d] * times.get(d, 0) for d in mine) - target) <= max(size[d] for d in mine)

    rows = results["packing"][1].collect()
    path = vocabulary(packing.VOCABULARY)
    pieces = packing.pieces(results["packing"][0], path).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == collections.Counter(map(tuple, pieces))
    at = collections.defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 4096 and len(at) <= -(-sum(at.values()) // 4096) + 1
    assert sorted(map(tuple, cp.run(spark, SMOKE).collect())) == sorted(map(tuple, rows))
