"""Words of texts as arrays, for use inside tasks.

A word is a run without ASCII white space. Arrow splits the texts and finds the
distinct words of a slice; each of those is hashed once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4 << 20
_EDGE = " \t.,;:!?\"'()[]{}«»“”„¿¡*#$%&|<>-_"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds one text or a few megabytes, whatever the batch size."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def split(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts in order, dictionary-encoded, and offsets of each text (null: none)."""
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    trimmed = pc.if_else(pc.equal(pc.binary_length(trimmed), 0), pa.scalar(None, trimmed.type), trimmed)
    parts = pc.ascii_split_whitespace(trimmed)
    counts = np.asarray(pc.fill_null(pc.list_value_length(parts), 0), dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    words = pc.list_flatten(parts)
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    return words.dictionary_encode(), offsets


def raw(dictionary: pa.Array) -> list[bytes]:
    return dictionary.cast(pa.large_binary() if pa.types.is_large_string(dictionary.type) else pa.binary()).to_pylist()


def hashed(texts: pa.Array, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and offsets of each text."""
    words, offsets = split(texts)
    each = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in raw(words.dictionary)), np.uint64, len(words.dictionary))
    if not len(words):
        return np.zeros(0, np.uint64), offsets
    return each[np.asarray(words.indices)], offsets


def plain(words: pa.Array) -> pa.Array:
    """Lower case without punctuation at the ends; words of punctuation alone become empty."""
    return pc.utf8_trim(pc.utf8_lower(words), _EDGE)


def plain_hashes(texts: pa.Array, first: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the plain words, or of their ``first`` characters, and offsets of each text."""
    found, offsets = split(texts)
    if not len(found):
        return np.zeros(0, np.uint64), offsets
    form = plain(found.dictionary)
    if first is not None:
        form = pc.utf8_slice_codeunits(form, 0, first)
    each = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in raw(form)), np.uint64, len(form))
    return each[np.asarray(found.indices)], offsets


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a hash so that all its bits depend on all bits of ``x``."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def windows(hashes: np.ndarray, size: int, factor: np.uint64 = _ODD) -> np.ndarray:
    """Hash of the ``size`` words from each position, as a polynomial; the last ``size - 1`` positions are left out."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # Doubling: windows of length 2k are made of two of length k.
    done, length, power = np.zeros(len(hashes), np.uint64), 0, np.uint64(1)
    block, block_len, block_power = hashes, 1, factor
    left = size
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                m = len(hashes) - length - block_len + 1
                done = done[:m] + block[length : length + m] * power if length else block[:m].copy()
                length += block_len
                power = power * block_power
            left >>= 1
            if left:
                m = len(block) - block_len
                block = block[:m] + block[block_len:] * block_power
                block_power = block_power * block_power
                block_len *= 2
    return done[:n]
