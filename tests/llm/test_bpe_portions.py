"""The registered path feeds texts in portions, whose size bounds what it holds besides the ids."""

import random
import tracemalloc

import pyarrow as pa
import pytest

from hopscope.llm import bpe
from hopscope.llm.queries import tokenizer_path
from tests.llm.test_bpe import ALPHABET, library, vocabulary  # noqa: F401

tokenizers = pytest.importorskip("tokenizers")


def test_small_portions_match_the_library(vocabulary, library, monkeypatch):  # noqa: F811
    monkeypatch.setattr(bpe, "PORTION", 5)
    monkeypatch.setattr(bpe, "_MEMO", 20)
    rng, encoder = random.Random(8), bpe.Encoder(vocabulary, 8)
    texts = [None, "", *("".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 80))) for _ in range(300)), "ab" * 3000, " " * 999 + "x"]
    got = bpe._encoded(encoder, pa.array(texts)).to_pylist()
    assert got == [library(t or "") for t in texts]
    assert bpe._decoded(bpe.Decoder(vocabulary), pa.array(got, pa.list_(pa.int32()))).to_pylist() == [t or "" for t in texts]


def test_every_text_goes_through_feed(vocabulary, monkeypatch):  # noqa: F811
    fed = []
    feed = bpe.Encoder.feed
    monkeypatch.setattr(bpe.Encoder, "feed", lambda self, text: fed.append(len(text)) or feed(self, text))
    bpe._encoded(bpe.Encoder(vocabulary), pa.array(["some words", "x" * 200_000]))
    assert fed == [10, *[bpe.PORTION] * 3, 200_000 - 3 * bpe.PORTION]


def test_memory_does_not_follow_the_text(vocabulary):  # noqa: F811
    """What is held besides the ids is that of a portion: the peak above them is the same for four times the text."""
    rng = random.Random(1)
    some = ["".join(rng.choice("abcdefgh éß,.") for _ in range(rng.randint(1, 9))) for _ in range(500)]

    def above_ids(n):
        text = " ".join(rng.choice(some) for _ in range(n))
        encoder = bpe.Encoder(vocabulary)
        encoder.encode(text[:1000])
        tracemalloc.start()
        encoder.prime([text])
        primed = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        ids = encoder.encode(text)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        # The array of ids grows by copies, so up to three times itself.
        return primed, peak - 3 * ids.itemsize * len(ids), len(text)

    small, large = above_ids(100_000), above_ids(400_000)
    assert large[2] > 3 * small[2]
    assert large[0] < 1.5 * small[0] + (1 << 20) and large[1] < small[1] + (3 << 20)
