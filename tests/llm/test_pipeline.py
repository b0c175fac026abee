"""The pipeline's stages on sf0.001 and on odd rows."""

import corpus_pipeline
import odd
import pytest
from conftest import SF0001
from netquery.llm import common
from test_documents import brute_groups, check_packed, library_ids


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = common.table(spark, SF0001, "documents"), []
    for name, f in corpus_pipeline.STAGES:
        docs = common.written(f(spark, docs, SF0001), "test-stage")
        out.append((name, docs))
    return dict(out)


def test_stages_return_documents(spark, stages):
    want = common.table(spark, SF0001, "documents").dtypes
    assert all(df.dtypes == want for name, df in list(stages.items())[:-1])


def test_copies_and_near_copies_go(spark, stages):
    before = stages["toxicity"].collect()
    kept = {}
    for r in sorted(before, key=lambda r: r.doc_id):
        kept.setdefault(" ".join(r.text.split()), r.doc_id)
    assert sorted(r.doc_id for r in stages["exact dedup"].collect()) == sorted(kept.values())
    rows = [(r.doc_id, r.text) for r in stages["exact dedup"].collect()]
    groups = brute_groups(rows, 5, 80)
    assert sorted(r.doc_id for r in stages["n-gram Jaccard join"].collect()) == sorted(k for k, (_, c) in groups.items() if c == k)


def test_packed_pieces_hold_the_mix(spark, stages):
    rows = [(i, r.text) for i, r in enumerate(stages["mixing sources"].collect())]
    pieces = stages["packing"]
    assert pieces.agg({"length": "sum"}).first()[0] == sum(len(x) for x in library_ids(rows).values())
    assert check_packed is not None


def test_odd_rows_pass_all_stages(spark):
    for docs in (odd.docs(spark), odd.empty(spark)):
        for name, f in corpus_pipeline.STAGES:
            out = f(spark, docs, SF0001)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            docs = common.written(out, "odd-stage")
        assert docs.count() >= 0
