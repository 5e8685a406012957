"""The masks of the decontamination against enumeration and a brute force without seeds."""

import itertools
import random

import pytest

from hopscope.llm import decontaminate
from tests.llm.test_queries import plain


@pytest.mark.parametrize("length, replaced", [(13, 2), (15, 3), (20, 4), (25, 5)])
def test_masks_hit_every_stretch(length, replaced):
    seen = [
        {at + i for i, c in enumerate(shape) if c == "1"}
        for shape in decontaminate.MASKS
        for at in range(length - len(shape) + 1)
    ]
    seen = [sum(1 << i for i in places) for places in seen]
    for gone in itertools.combinations(range(length), replaced):
        away = sum(1 << i for i in gone)
        assert any(not places & away for places in seen), gone


@pytest.mark.parametrize("size", range(3, 13))
def test_masks_hit_every_short_item(size):
    shapes = decontaminate.whole_masks(size)
    assert all(len(s) == size and s[0] == s[-1] == "1" for s in shapes)
    for gone in itertools.combinations(range(1, size - 1), size // 5):
        assert any(all(s[i] == "0" for i in gone) for s in shapes), gone


def leaks(words, item):
    for shift in range(-len(item) + 1, len(words)):
        lo, hi = max(0, shift), min(len(words), shift + len(item))
        equal = [words[i] == item[i - shift] for i in range(lo, hi)]
        places = [i for i, x in enumerate(equal) if x]
        for a, b in itertools.combinations_with_replacement(places, 2):
            if b + 1 - a >= min(13, len(item)) and 5 * sum(equal[a : b + 1]) >= 4 * (b + 1 - a):
                return True
    return False


def test_leaks_match_brute_force_without_seeds(spark, small):
    rng = random.Random(8)
    items = [(i, " ".join(f"q{i}x{k}" for k in range(n))) for i, n in enumerate([*range(3, 13), 13, 15, 16, 20, 40])]
    rows = []
    for i, text in items:
        item = text.split()
        for _ in range(12):
            w = list(item)
            for k in rng.sample(range(len(w)), rng.choice([len(w) // 5, len(w) // 5, len(w) // 5 + 1]) % (len(w) + 1)):
                w[k] = "other"
            rows.append((len(rows), " ".join(["before"] * rng.randint(0, 3) + w + ["after"] * rng.randint(0, 3))))
        rows.append((len(rows), " ".join("other" if k % 5 == 4 else x for k, x in enumerate(item))))
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, int(x.item)) for r in decontaminate.mark_leaks(small(rows), frame).collect() for x in r.leaks}
    want = {(d, i) for d, text in rows for i, item in items if leaks(plain(text), plain(item))}
    assert got == want
    assert {i for _, i in want} == {i for i, _ in items}
    kept = decontaminate.drop_leaks(small(rows), frame)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in want}
