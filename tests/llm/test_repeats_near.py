import collections
import random

import numpy as np
import pytest

from hopscope.llm import near_copies, repeats, words
from hopscope.llm.components import components
from tests.llm.conftest import WORD, odd_rows, sentence


def cut(texts, length):
    split = [WORD.findall(t or "") for t in texts]
    count = collections.Counter(tuple(w[i : i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for w in split:
        keep = [True] * len(w)
        for i in range(len(w) - length + 1):
            if count[tuple(w[i : i + length])] > 1:
                keep[i : i + length] = [False] * length
        rest = [x for x, k in zip(w, keep, strict=True) if k]
        out.append((len(w), len(w) - len(rest), " ".join(rest)))
    return out


def test_repeats_match_brute_force(odd, empty):
    found = repeats.remove_repeats(odd).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    rows = odd_rows()
    want = collections.Counter((r[0], *c) for r, c in zip(rows, cut([r[1] for r in rows], 35), strict=True))
    assert collections.Counter(map(tuple, found)) == want
    assert repeats.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_of_few_words(small, seed):
    """Few different words, so that windows repeat within and across texts with ties everywhere."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("ab" if i % 3 else "abcdefgh") for _ in range(rng.randint(1, 70))) for i in range(60)]
    block = " ".join(rng.choice("abcdefgh") for _ in range(20))
    texts += [f"{' '.join(rng.choice('xyz') for _ in range(rng.randint(0, 12)))} {block} z{i}" for i in range(30)]
    found = repeats.remove_repeats(small(list(enumerate(texts))), length=12).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in found} == dict(enumerate(cut(texts, 12)))


def test_short_window_is_refused(odd):
    with pytest.raises(ValueError):
        repeats.remove_repeats(odd, length=5)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 35])
def test_window_hashes(size):
    h = np.random.default_rng(1).integers(0, 3, 200).astype(np.uint64)
    got = words.windows(h, size)
    assert len(got) == 201 - size
    first = {}
    for i, x in enumerate(got.tolist()):
        assert first.setdefault(tuple(h[i : i + size]), x) == x
    assert len(set(got.tolist())) == len(first)


def shingles(text):
    w = WORD.findall(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_classes(rows):
    """{row number: (class id, links)} over rows (key, text)."""
    sets = [None if t is None else shingles(t) for _, t in rows]
    links, root = collections.Counter(), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a is not None and b is not None and (a == b or len(a & b) / len(a | b) >= 0.8):
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    return collections.Counter((key, least.get(top(i)), links[i]) for i, (key, _) in enumerate(rows))


def test_classes_match_brute_force(odd, empty):
    found = near_copies.near_copies(odd).select("doc_id", "class_id", "n_links").collect()
    assert collections.Counter(map(tuple, found)) == brute_classes([r[:2] for r in odd_rows()])
    assert near_copies.near_copies(empty).count() == 0


def test_spread_family(small):
    """One large family whose members are partly above and partly below the threshold, over several blocks."""
    rng, base = random.Random(3), [f"w{i}" for i in range(100)]
    rows = []
    for i in range(600):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(100)] = f"v{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, sentence(100, 1, 1000 * i + 5000)) for i in range(20)]
    found = near_copies.near_copies(small(rows)).select("doc_id", "class_id", "n_links").collect()
    assert collections.Counter(map(tuple, found)) == brute_classes(rows)


def test_one_of_each_class_stays(odd, empty):
    kept = near_copies.keep_one(odd)
    assert kept.columns == odd.columns
    rows = [r[:2] for r in odd_rows()]
    classes = {k[1] for k in brute_classes(rows) if k[1] is not None}
    nameless = [t for k, t in rows if k is None and t not in (None, sentence(120))]
    keyed = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None and r.text is not None)
    assert len(keyed) == len(set(keyed)) or keyed.count(2) == 2
    found = near_copies.near_copies(kept).filter("n_links > 0")
    assert found.count() == 0
    assert classes <= {r.doc_id for r in kept.select("doc_id").collect()}
    assert kept.filter("doc_id is null and text is not null").count() == len(nameless)
    assert near_copies.keep_one(empty).count() == 0


def test_bands_reach_the_recall():
    bands, rows = near_copies.choose_bands(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 128


def test_overlaps_are_exact():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 500, 200).astype(np.uint64)) for _ in range(12)]
    got = near_copies.overlaps(sets[:5], sets[5:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(150)] + [(1000, 1001), (1002, 1001)]
    found = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(151)}, 1000: 1000, 1001: 1000, 1002: 1000}
