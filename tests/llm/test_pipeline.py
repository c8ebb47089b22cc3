"""The stages in order: columns kept, decisions that take effect, nothing clean lost."""

from __future__ import annotations

import corpus_pipeline
from brute import base_counts, base_secrets, near_components, table

from churnlens.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, "documents")
    columns = docs.schema.simpleString()
    numbers = [n for n, _ in corpus_pipeline.STAGES]
    assert len(numbers) == 5
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), "test")
        assert docs.schema.simpleString() == columns
        kept[name] = before, {r["doc_id"]: r["text"] for r in docs.collect()}
    before, after = kept["quality rules"]
    failed = {i for i, t in before.items() if base_counts(t)[0] < 10 or 5 * base_counts(t)[4] > base_counts(t)[0]}
    assert not failed & set(after)
    good = {r["doc_id"] for r in table(spark, "labels").where("quality = 1").collect()} - failed
    assert len(good - set(after)) <= 0.02 * len(good)
    before, after = kept["MinHash near-dedup"]
    assert set(after) == {c for _, c in near_components(before, size=5).values()}
    before, after = kept["secret scans"]
    assert set(before) == set(after)
    assert all(not base_secrets(t) for t in after.values())
    assert all(after[i] == t for i, t in before.items() if not base_secrets(t))
    before, after = kept["mixing sources"]
    assert before == after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() and last.where("NOT round_trip").count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "doc_id" in out.columns
