"""Odd rows through the whole chain: nulls, blanks, repeats and clashing columns at every stage."""

import collections

import corpus_pipeline
from hopscope.sources.staging import stage
from tests.llm.conftest import odd_rows, sentence

SF = "/root/testdata/sf0.001"


def test_each_stage_takes_odd_rows(spark, odd):
    """Each stage is given all odd rows, whatever the one before it dropped."""
    rows = collections.Counter((r[0], r[1]) for r in odd_rows())
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, odd, SF)
        assert kept.columns == odd.columns, name
        found = collections.Counter((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect())
        if name == "secret_scans":
            assert sum(found.values()) == sum(rows.values())
        else:
            assert not found - rows, name
        # Clean long texts stay.
        assert (13, sentence(30000, 1, 10**6)) in found, name
    last = corpus_pipeline.STAGES[-1][1](spark, odd, SF)
    assert last.count() == sum(rows.values())


def test_the_chain_takes_odd_rows(spark, odd):
    docs = odd
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, SF), name)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    ids = [r.doc_id for r in out]
    assert 13 in ids and not {1, 2, 3, 4, 5, 11, 12, 14} & set(ids)
    # One of the equal texts and of the near copy stays, and it is the least key.
    assert 6 in ids and 7 not in ids and 8 not in ids
    assert all(r.n_tokens == len(r.ids) and r.n_tokens > 0 for r in out)
