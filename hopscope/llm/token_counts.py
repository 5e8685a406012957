"""Token counts of whole texts: batches balanced by bytes, long texts split at safe boundaries.

A tokenizer file is read with its own library, once for each Python worker. The
tasks encode batches of about ``BATCH_BYTES`` and keep only the lengths. A text
over ``CHUNK_CHARS`` is cut where both sides are encoded alike with and without
the cut, so its count is the sum over the parts and no batch grows with a text.

Where a cut is safe follows from the file (normaliser: NFC, white space to one
space, lower case; pieces: contractions, runs of letters, single numbers, runs
of other characters; white space is dropped). No piece holds white space, and a
number is always a piece of its own, so a text may be cut before ASCII white
space and beside an ASCII digit; a run of letters always ends before another
kind of character, so it may be cut between an ASCII letter and ASCII
punctuation, and between an ideograph or kana and CJK punctuation. None of the characters
after a cut ever composes with one before it, and none of those before it
changes its kind in lower case. Added tokens are matched in the raw text, so no cut
falls inside one. A stretch without any such place (one unbroken word) goes to
the library whole; files with other rules are not split at all.

Defined cases: a null text counts as empty and has 0 tokens and 0 bytes;
repeated rows are counted one by one; an empty table gives an empty result;
strings of added tokens in a text count as one token, as by the library's
default; extra columns are carried as asked, whatever their names; there are no ties.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from hopscope.llm import words

BATCH_BYTES = 1 << 20
CHUNK_CHARS = 1 << 15
LIMIT = 2048

# The rules for which the boundaries below are safe.
SPLIT_RULES = {
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
    "pieces": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}
SAFE = re.compile(
    r"(?=[\t-\r 0-9])"
    r"|(?<=[0-9])(?=[A-Za-z])"
    r"|(?<=[A-Za-z0-9])(?=[!-/:-@\[-`{-~])"
    "|(?<=[ぁ-ゖァ-ヺ一-龥])(?=[、。！，：；？])"
)


def can_split(spec: dict) -> bool:
    """Whether the boundaries of ``SAFE`` hold for a tokenizer file."""
    normalizer, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers") or [{}]
    first = steps[0]
    rest = [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
    return (
        normalizer.get("normalizers") == SPLIT_RULES["normalizers"]
        and first.get("pattern", {}).get("Regex") == SPLIT_RULES["pieces"]
        and (first.get("behavior"), first.get("invert")) == ("Removed", True)
        and steps[1:] == rest
        and not any(t.get(k) for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word", "normalized"))
    )


class Counter:
    """Numbers of tokens of texts, from one loaded tokenizer file."""

    def __init__(self, source: str, chunk: int = CHUNK_CHARS, batch: int = BATCH_BYTES):
        # One thread for each task: Spark deals out the cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(source)
        self.model = Tokenizer.from_str(source)
        self.model.no_truncation()
        self.model.no_padding()
        self.chunk, self.batch = chunk, batch
        self.splits = can_split(spec)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.reach = max(map(len, self.added), default=0)

    def _inside_added(self, text: str, at: int) -> bool:
        around = text[max(0, at - self.reach) : at + self.reach]
        place = at - max(0, at - self.reach)
        for token in self.added:
            found = around.find(token)
            while found >= 0:
                if found < place < found + len(token):
                    return True
                found = around.find(token, found + 1)
        return False

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts whose counts add up to its own."""
        start = 0
        while self.splits and len(text) - start > self.chunk:
            at = start + self.chunk
            while (found := SAFE.search(text, at)) is not None and self._inside_added(text, found.start()):
                at = found.start() + 1
            if found is None or found.start() >= len(text):
                break
            yield text[start : found.start()]
            start = found.start()
        yield text[start:]

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Numbers of tokens, in batches of about equal bytes."""
        out = np.zeros(len(texts), np.int64)
        batch: list[str] = []
        owners: list[int] = []
        size = 0

        def settle():
            nonlocal size
            made = self.model.encode_batch_fast(batch, add_special_tokens=False)
            np.add.at(out, owners, np.fromiter(map(len, made), np.int64, len(made)))
            batch.clear()
            owners.clear()
            size = 0

        for i, text in enumerate(texts):
            for part in self.parts(text) if text else ():
                batch.append(part)
                owners.append(i)
                size += len(part) if part.isascii() else len(part.encode())
                if size >= self.batch:
                    settle()
        if batch:
            settle()
        return out


_LOADED: dict[str, Counter] = {}


def _counter(source: str) -> Counter:
    if source not in _LOADED:
        _LOADED.clear()
        _LOADED[source] = Counter(source)
    return _LOADED[source]


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", carry: list[str] | None = None, limit: int = LIMIT
) -> DataFrame:
    """The carried columns with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    with open(path, encoding="utf-8") as file:  # a few megabytes whatever the data
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    names = [c for c in (docs.columns if carry is None else carry) if c not in ("n_bytes", "n_tokens", "over_limit")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in words.slices(batches, "text"):
            counts = counter.count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(counts)], names=["row", "n_tokens"])

    # The carried columns travel in a struct, so they may have any name.
    n_bytes = F.coalesce(F.octet_length(docs[f"`{text}`"]), F.lit(0)).cast("long")
    row = F.struct(n_bytes.alias("n_bytes"), F.struct(F.lit(1).alias("none"), *(docs[f"`{c}`"] for c in names)).alias("own"))
    packed = docs.select(row.alias("row"), docs[f"`{text}`"].alias("text"))
    made = packed.mapInArrow(run, StructType([*packed.select("row").schema.fields]).add("n_tokens", LongType()))
    return made.select(
        *(F.col("row.own")[c].alias(c) for c in names),
        F.col("row.n_bytes").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
