"""The toxicity model's shared counts are those of the whole corpus."""

import collections

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hopscope.llm import toxicity


@pytest.mark.parametrize("most", [1 << 21, 40])
def test_pairs_of_rows_without_a_label_count(small, monkeypatch, most):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"{chr(97 + k)}word" for k in rng.integers(0, 12, 60))) for i in range(30)] + [(99, None)]
    role = {"0": (0, False), "1": (1, False), "2": (0, True)}
    docs = small(rows).select(F.col("doc_id").cast("string").alias("id"), "text")
    monkeypatch.setattr(toxicity, "_MOST_HELD", most)
    model = toxicity.count_model(docs, role)
    counts = [collections.Counter() for _ in range(3)]
    for i, text in rows:
        stem, before, _ = toxicity.slots(pa.array([text], pa.string()))
        found = list(zip(before.tolist(), stem.tolist(), strict=True))
        counts[2].update(found)
        if i in (0, 1):
            counts[i].update(found)
    for c, count in enumerate(counts):
        after, left = collections.Counter(), collections.Counter()
        pair = np.zeros(1 << toxicity.PAIR_BITS)
        for (b, s), n in count.items():
            after[b] += n
            left[b] += min(n, toxicity.PAIR_DISCOUNT)
            pair[toxicity.pair_slot(np.array([b]), np.array([s]))[0]] += max(n - toxicity.PAIR_DISCOUNT, 0)
        assert {b: n for b, n in enumerate(model.after[c].tolist()) if n} == after
        assert {b: n for b, n in enumerate(model.left[c].tolist()) if n} == left
        assert np.array_equal(model.pair[c], pair)
