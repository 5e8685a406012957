import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hopscope.llm import bpe
from hopscope.llm.queries import tokenizer_path
from tests.llm.conftest import odd_rows

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def vocabulary():
    with open(tokenizer_path(), encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


@pytest.fixture(scope="module")
def library():
    made = tokenizers.Tokenizer.from_file(tokenizer_path())
    made.no_truncation()
    made.no_padding()
    return lambda text: made.encode(text, add_special_tokens=False).ids


def in_portions(encoder, text, rng, most):
    out, at = [], 0
    while at < len(text):
        n = rng.randint(1, most)
        out += encoder.feed(text[at : at + n])
        at += n
    return out + list(encoder.finish())


ALPHABET = [*"abcdeéèß  \n\tsrtvldm0123.,!?'", "\x1c", "\x85", "　", "日", "\U0001f600", "<|endoftext|>", "<|", "'re", "\r\n", "Ⅷ"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=60), st.integers(0, 1000))
def test_portions_match_the_library(vocabulary, library, parts, seed):
    text, encoder = "".join(parts), bpe.Encoder(vocabulary, 8)
    want = library(text)
    assert list(encoder.encode(text)) == want
    assert in_portions(encoder, text, random.Random(seed), 7) == want


def test_long_pieces_stream_in_bounded_memory(vocabulary, library):
    rng, encoder = random.Random(4), bpe.Encoder(vocabulary, 8)
    for letters in ("ab", "!?=-", " \n", "01", "étà", "a"):
        text = rng.choice(["", " ", "x "]) + "".join(rng.choice(letters) for _ in range(6000)) + rng.choice(["", " b", "'s", "!"])
        want = library(text)
        assert in_portions(encoder, text, rng, 500) == want
        got = []
        for i in range(0, len(text), 100):
            got += encoder.feed(text[i : i + 100])
            assert len(encoder.text) + len(encoder.open) <= 3 * encoder.window
        assert got + list(encoder.finish()) == want


def test_many_texts_at_once(vocabulary, library):
    rng = random.Random(6)
    texts = [None, "", *("".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 50))) for _ in range(300)), "a" * 5000]
    for encoder in (bpe.Encoder(vocabulary), bpe.Encoder(vocabulary, 8)):
        ids, offsets = encoder.encode_many(texts)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library(t or "") for t in texts]


def test_decoder_portions(vocabulary):
    text = "日本 \U0001f600 é <|endoftext|> plain"
    ids = list(bpe.Encoder(vocabulary).encode(text))
    decoder = bpe.Decoder(vocabulary)
    assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == text
    for portion in (1, 2, 100):
        assert decoder.decode_many(np.array(ids * 3), np.array([0, len(ids), 2 * len(ids), 3 * len(ids)]), portion) == [text] * 3
    assert decoder.decode(ids[1:2]) == "�" or decoder.decode(ids[1:2])


def test_lookahead_of_small_merge_lists():
    assert bpe.sufficient_lookahead([(b"a", b"b")]) == 2
    # "bc" is older than "ab": whether "a" takes "b" depends on the "c" behind it.
    assert bpe.sufficient_lookahead([(b"b", b"c"), (b"a", b"b")]) == 3
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([(b"ab", b"c"), (b"a", b"b")])


def test_round_trip_of_odd_rows(odd, empty, library):
    encoded = bpe.encode(odd, tokenizer_path(), carry=["doc_id", "text"])
    rows = bpe.decode(encoded, tokenizer_path(), keep_ids=True).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r.decoded == (r.text or "") and list(r.ids) == library(r.text or "")
    assert bpe.encode(empty, tokenizer_path()).count() == 0
    assert bpe.encode(odd, tokenizer_path()).columns == [*odd.columns, "ids"]
