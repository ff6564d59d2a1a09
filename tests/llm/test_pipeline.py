"""The pipeline against brute force, stage by stage, on a given table."""

import corpus_pipeline
from edgeloom.llm.common import table
from edgeloom.plans.rounds import written
from tests.llm import helpers as h


def test_stages(spark):
    docs = table(spark, h.SMALL, "documents")
    columns = docs.columns
    items = [tuple(r) for r in table(spark, h.SMALL, "benchmark").select("item_id", "text").collect()]
    marks = {r.doc_id: r.quality for r in table(spark, h.SMALL, "labels").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs, _ = written(stage(spark, docs, h.SMALL))
        after = {r.doc_id for r in docs.collect()}
        if name != "sharding":
            assert docs.columns == columns
        if name == "quality":
            marked = [d for d, _ in before if d in marks]
            right = sum((d in after) == (marks[d] == 1) for d in marked)
            assert right >= 0.9 * len(marked)
        elif name == "near_duplicates":
            assert after == {d for d, _, c in h.simhash_groups(before) if d == c}
        elif name == "decontamination":
            assert after == {d for d, t in before if not h.contamination(t, items)[1]}
        elif name == "mixing":
            assert after < {d for d, _ in before} and len(after) > 10
        else:
            assert after == {d for d, _ in before}
