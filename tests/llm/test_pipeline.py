"""The pipeline's stages against brute force over what each predecessor kept."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute as B  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from riskspark.llm.common import materialize, table  # noqa: E402


def test_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    items = [tuple(r) for r in table(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]
    for name, stage in P.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        docs = materialize(stage(spark, docs, SF_SMALL), f"test-{name}")
        after = [tuple(r) for r in docs.select(*(["doc_id", "text"] if name != "mixing" else ["doc_id", "taken"])).collect()]
        if name != "mixing":
            assert docs.columns == columns
        if name == "quality_rules":
            kept = {d for d, _ in after}
            for d, t in before:
                c = B.base_counts(t)
                if c[0] < 50 or 100 * c[4] > 50 * c[0]:
                    assert d not in kept
            lab = {r.doc_id: r.quality for r in table(spark, SF_SMALL, "labels").collect()}
            good = [d for d, t in before if lab.get(d) == 1 and len(B.words(t)) >= 50]
            assert sum(d in kept for d in good) >= 0.95 * len(good)
        elif name == "line_dedup":
            assert sorted(after) == sorted((d, t) for d, _, _, t in B.dedup_lines(before))
            assert all(r.n_chars == len(r.text or "") for r in docs.collect())
        elif name == "near_duplicates":
            comps = B.jaccard_components(before)
            assert sorted(d for d, _ in after) == sorted({c for _, n, c in comps if n} | {d for d, n, _ in comps if not n})
        elif name == "decontamination":
            assert sorted(d for d, _ in after) == [r[0] for r in B.contamination(before, items) if not r[5]]
        else:
            assert sorted(d for d, _ in after) == sorted(d for d, _ in before)
    assert docs.agg({"taken": "sum"}).first()[0] > 0
