"""Batches that reach Python hold a bounded number of bytes, also in a stage called alone."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from hopscope.llm import near_copies
from hopscope.session import ARROW_BYTES, SETTINGS, tune

SF = "/root/testdata/sf0.001"


def largest_batch(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    texts = spark.range(0, 9000, 1, 1).selectExpr("repeat('abcdefgh', 250) as text")
    return texts.mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0]


@pytest.fixture
def plain(spark):
    """A session that bounds the rows of a batch only."""
    spark.conf.set(ARROW_BYTES, "1g")
    yield spark
    tune(spark)


@pytest.mark.parametrize("step", [step for _, step in corpus_pipeline.STAGES], ids=[name for name, _ in corpus_pipeline.STAGES])
def test_stage_called_alone(plain, empty, step):
    assert largest_batch(plain) > 16 << 20
    step(plain, empty, SF)
    assert plain.conf.get(ARROW_BYTES) == SETTINGS[ARROW_BYTES]


def test_batches_are_bounded(plain):
    assert largest_batch(tune(plain)) < 5 << 20


def test_block_against_itself(monkeypatch):
    """Laid out once: the matrix has a row for each set, not two."""
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 300, n).astype(np.uint64)) for n in (0, 1, 40, 90, 200, 200)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    made, zeros = [], np.zeros
    monkeypatch.setattr(near_copies.np, "zeros", lambda shape, kind: made.append(shape) or zeros(shape, kind))
    assert near_copies.overlaps(sets, sets).tolist() == want
    assert {rows for rows, _ in made} == {len(sets)}
    assert near_copies.overlaps(sets, list(sets)).tolist() == want
