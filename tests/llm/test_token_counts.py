import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hopscope.llm import queries, token_counts
from tests.llm.conftest import documents

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [
    "'s", "'re", "'", "a", "Z", "é", "́", "é", "İ", ".", "1", "٣", "½", " ", "\n", "　", "。", "漢", "カ", "゙",
    "<|endoftext|>", "<|startoftext|>", "<|", "|>", "ᅡ", "가", "x", "-", "_", "😀", "क़", "\x1c", "\x85", "Σ", "ς", "!", "<",
]


@pytest.fixture(scope="module")
def whole():
    model = Tokenizer.from_file(PATH)
    model.no_truncation()
    model.no_padding()
    return lambda text: len(model.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def source():
    with open(PATH, encoding="utf-8") as file:
        return file.read()


def test_cuts_change_no_count(whole, source):
    rnd = random.Random(12)
    counter = token_counts.Counter(source, batch=64)
    assert counter.splits
    parts = 0
    for _ in range(1500):
        text = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(1, 300)))
        counter.chunk = rnd.randint(1, 40)
        cut = list(counter.parts(text))
        parts += len(cut)
        assert "".join(cut) == text
        assert counter.count([text])[0] == whole(text), text
    assert parts > 10000


def test_added_tokens_stay_whole(source):
    counter = token_counts.Counter(source, chunk=3)
    assert any("<|endoftext|>" in p for p in counter.parts("ab<|endoftext|>cd ef<|endoftext|>"))


def test_parts_are_bounded_where_there_are_boundaries(source):
    counter = token_counts.Counter(source, chunk=100)
    assert max(map(len, counter.parts("word " * 5000))) < 110
    assert list(counter.parts("x" * 5000)) == ["x" * 5000]


def test_other_rules_are_not_split(source):
    other = json.loads(source)
    other["normalizer"] = None
    assert not token_counts.can_split(other)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        counter = token_counts.Counter(file.read(), chunk=5)
    assert not counter.splits
    assert list(counter.parts("some words of text")) == ["some words of text"]


def test_batches_hold_about_equal_bytes(source, monkeypatch):
    counter = token_counts.Counter(source, chunk=200, batch=1000)
    sizes = []
    model = counter.model

    class Spy:
        def encode_batch_fast(self, batch, add_special_tokens):
            sizes.append(sum(len(x.encode()) for x in batch))
            return model.encode_batch_fast(batch, add_special_tokens=add_special_tokens)

    counter.model = Spy()
    counter.count(["é " * 3000, "a", None, "", "b c " * 700])
    assert all(1000 <= s < 1500 for s in sizes[:-1])


def test_odd_rows(odd, empty, whole):
    got = token_counts.count_tokens(odd, PATH, carry=["doc_id", "text", "row_key", "size"])
    assert got.columns == ["doc_id", "text", "row_key", "size", "n_bytes", "n_tokens", "over_limit"]
    rows = got.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r["n_tokens"] == whole(r["text"]) and r["n_bytes"] == len((r["text"] or "").encode())
        assert r["over_limit"] == (r["n_tokens"] > 2048)
    assert token_counts.count_tokens(empty, PATH).count() == 0


def test_query_against_the_library(spark, tmp_path, whole):
    rnd = random.Random(4)
    texts = [None, "", "  ", "<|endoftext|> <|startoftext|>x", "long text. " * 20000, "x" * 60000, "Über-Größe: 12,5 %"]
    texts += ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(1, 3000))) for _ in range(60)]
    documents(spark, [(i, t) for i, t in enumerate(texts)]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in queries.op12_token_counts(spark, str(tmp_path)).collect()}
    assert got == {(i, len((t or "").encode()), whole(t), whole(t) > 2048) for i, t in enumerate(texts)}
