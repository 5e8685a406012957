"""Families of several blocks: counts and classes are exact, and edges don't grow with the pairs."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hopscope.llm import near_copies
from tests.llm.conftest import sentence
from tests.llm.test_repeats_near import brute_classes


def family(seed, n, most=4):
    rng, base, rows = random.Random(seed), [f"w{i}" for i in range(100)], []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(100)] = f"v{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("block", [7, 40])
def test_several_blocks_match_brute_force(small, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rows = family(block, 150) + [(1000 + i, sentence(100, 1, 1000 * i + 5000)) for i in range(5)]
    rows += [(2000 + i, rows[i][1]) for i in range(20)]
    found = near_copies.near_copies(small(rows)).select("doc_id", "class_id", "n_links").collect()
    assert collections.Counter(map(tuple, found)) == brute_classes(rows)


def test_blocks_are_bounded_by_bytes_too(small, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK_BYTES", 8 * 96 * 10)
    rows = family(5, 60)
    found = near_copies.near_copies(small(rows)).select("doc_id", "class_id", "n_links").collect()
    assert collections.Counter(map(tuple, found)) == brute_classes(rows)


def test_one_of_each_class_over_blocks(small, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 16)
    rows = family(9, 80) + [(500, None), (501, ""), (502, ""), (503, "alone in the world")]
    kept = near_copies.keep_one(small(rows))
    want = {c for _, c, _ in brute_classes(rows)}
    assert {r.doc_id for r in kept.collect()} == want and kept.count() == len(want)


def test_edges_join_roots_only():
    rng = np.random.default_rng(1)
    good = rng.random((40, 50)) < 0.5
    root = [b"a"] * 40 + [b"b"] * 50
    assert list(near_copies.cross_links(root, np.arange(40), np.arange(40, 90), good)) == [(b"a", b"b")]
    root = [bytes([i % 3]) for i in range(40)] + [bytes([10 + i % 2]) for i in range(50)]
    assert len(list(near_copies.cross_links(root, np.arange(40), np.arange(40, 90), good))) == 4
    assert not list(near_copies.cross_links(root, np.arange(40), np.arange(40, 90), np.zeros((40, 50), bool)))


def test_roots_of_a_path():
    linked = np.zeros((6, 6), bool)
    for i, j in ((0, 3), (3, 5), (2, 4)):
        linked[i, j] = linked[j, i] = True
    assert near_copies.roots(linked).tolist() == [0, 1, 2, 0, 2, 0]


def test_edges_grow_with_blocks_and_not_with_members(small, monkeypatch):
    """The edges between blocks of one connected family: one for each pair of blocks at most."""
    monkeypatch.setattr(near_copies, "BLOCK", 32)
    seen = []
    components = near_copies.components
    monkeypatch.setattr(near_copies, "components", lambda edges: seen.append(edges.select(F.count("*")).first()[0]) or components(edges))
    near_copies.near_copies(small(family(3, 256, 1))).collect()
    assert seen[-1] <= 8 * 7 / 2 + 8
