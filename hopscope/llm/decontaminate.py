"""Benchmark decontamination by spaced seeds.

A seed looks at the words of a text through a fixed mask that ignores some
places, so words replaced there don't hide a passage. Test and training hashes
are joined on (mask, hash), and each hit is verified: along its diagonal the
words around it are compared with the item's, and a stretch of at least
``span`` words (or the whole item, if that is shorter) in which ``share`` of the
words agree, the first and last among them, is a leak.

The masks miss no leak. A stretch of 13 words or more, 80 % equal, holds one of
13, 15, 20 or 25 words with at most 2, 3, 4 or 5 replaced, and ``MASKS`` hit each
of those wherever the replaced words stand (the tests enumerate them). An item of
fewer words is a leak as a whole only, and its masks are as long as itself.

Words are compared in lower case without punctuation at their ends. Defined
cases: a null or blank text has no hits; items of one or two words
(``SHORTEST``) are everyday phrases and left out; repeated rows are judged one by
one; empty tables give rows without leaks; extra columns are not looked at.

Scale: training hashes that can't be in the test set are dropped inside the
scan by a bit table of fixed size, built with partial sums over the test
hashes; if it fills up, more rows reach the join, which decides. Text is never
shuffled. A hot passage is a hot join key on the training side only, which AQE
splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopscope.llm import words
from hopscope.llm.rows import keyed
from hopscope.sources.staging import stage

# Places that count (1) and places that don't (0).
MASKS = ("11101011", "11001000111", "1101000001101", "110001100011")
SPAN = 13
SHARE = 0.8
SHORTEST = 3


def whole_masks(size: int, share: float = SHARE) -> list[str]:
    """Masks of a whole item: its inner words in one block more than words may be replaced; each mask looks at one block."""
    inner = np.arange(size - 2)
    blocks = int(size * (1 - share) + 1e-9) + 1
    block = inner * blocks // len(inner)
    return ["1" + "".join("01"[int(x)] for x in block == k) + "1" for k in range(blocks)]


# Those of whole items of fewer words than ``SPAN`` follow.
SHAPES = (*MASKS, *(shape for size in range(SHORTEST, SPAN) for shape in whole_masks(size)))
FILTER_BITS = 22
AROUND = 24  # words kept on both sides of a hit; ``span`` is at most this
_SLOT = np.uint64(64 - FILTER_BITS)


def seed_hashes(tokens: np.ndarray, mask: int) -> np.ndarray:
    """Hash of the places of a mask from each start at which the whole mask fits."""
    shape = SHAPES[mask]
    n = len(tokens) - len(shape) + 1
    out = np.full(max(n, 0), mask + 1, np.uint64)
    for k, mark in enumerate(shape):
        if mark == "1" and n > 0:
            out = out * np.uint64(0x9E3779B97F4A7C15) + tokens[k : k + n]
    return words.mix(out)


def _around(tokens: np.ndarray, offsets: np.ndarray, at: np.ndarray, row: np.ndarray, width: int) -> pa.Array:
    """The words of the mask at each place and ``AROUND`` on both sides; 0 outside the text."""
    padded = np.concatenate([np.zeros(AROUND, np.uint64), tokens, np.zeros(AROUND + width, np.uint64)])
    place = at[:, None] + np.arange(-AROUND, width + AROUND)
    near = padded[place + AROUND]
    near[(place < offsets[row][:, None]) | (place >= offsets[row + 1][:, None])] = 0
    ends = pa.array(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32))
    return pa.ListArray.from_arrays(ends, pa.array(near.view(np.int64).ravel()))


def _places(tokens: np.ndarray, offsets: np.ndarray, mask: int, there: np.ndarray | None):
    """(hashes, places, rows) of a mask within the texts; with ``there``, of hashes in the bit table only."""
    hashes = seed_hashes(tokens, mask)
    at = np.arange(len(hashes)) if there is None else _may_occur(there, hashes)
    row = np.searchsorted(offsets, at, side="right") - 1
    inside = at + len(SHAPES[mask]) <= offsets[row + 1]  # not over the end of its text
    return hashes[at[inside]], at[inside], row[inside]


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each mask and start in an item, with the words around it and the length of the item."""
    for batch in words.slices(batches, "text"):
        tokens, offsets = words.plain_hashes(batch.column("text"))
        sizes = np.diff(offsets)
        for mask, shape in enumerate(SHAPES):
            hashes, at, row = _places(tokens, offsets, mask, None)
            fits = sizes[row] >= SPAN if mask < len(MASKS) else sizes[row] == len(shape)
            hashes, at, row = hashes[fits], at[fits], row[fits]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item").take(pa.array(row)),
                    pa.array(np.full(len(at), mask, np.int32)),
                    pa.array(hashes.view(np.int64)),
                    pa.array(sizes[row]),
                    _around(tokens, offsets, at, row, len(shape)),
                ],
                names=["item", "mask", "hash", "size", "words"],
            )


def _bit_table(seeds: DataFrame) -> np.ndarray:
    """Which hashes can occur, two bits each of 2**FILTER_BITS, so at most 2**(FILTER_BITS - 6) longs reach the driver."""
    both = F.array(
        F.shiftrightunsigned("hash", 64 - FILTER_BITS),
        F.shiftrightunsigned(F.shiftleft("hash", FILTER_BITS), 64 - FILTER_BITS),
    )
    rows = (
        seeds.select(F.explode(both).alias("slot"))
        .select(
            F.shiftright("slot", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit")
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[np.asarray(rows.column("word"))] = np.asarray(rows.column("bits"))
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


def _may_occur(there: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes whose two bits are set."""
    at = np.flatnonzero(there[(hashes >> _SLOT).astype(np.int64)])
    second = (hashes[at] << np.uint64(FILTER_BITS)) >> _SLOT
    return at[there[second.astype(np.int64)]]


def _last(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The last place of each hash in each row."""
    order = np.lexsort((hashes, row))
    end = np.ones(len(order), bool)
    end[:-1] = (np.diff(row[order]) != 0) | (np.diff(hashes[order]) != 0)
    return np.sort(order[end])


def _hits(shared, used: list[int]):
    """Training hashes of the used masks that pass the bit table, with the words around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = shared.value
        for batch in words.slices(batches, "text"):
            tokens, offsets = words.plain_hashes(batch.column("text"))
            for mask in used:
                shape = SHAPES[mask]
                hashes, at, row = _places(tokens, offsets, mask, there)
                if mask >= len(MASKS) and "0" not in shape:  # a whole item word for word: once a row is enough
                    one = _last(hashes, row)
                    hashes, at, row = hashes[one], at[one], row[one]
                if not len(at):
                    continue
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(take),
                        batch.column("h").take(take),
                        pa.array(np.full(len(at), mask, np.int32)),
                        pa.array(hashes.view(np.int64)),
                        pa.array(at - offsets[row]),
                        _around(tokens, offsets, at, row, len(shape)),
                    ],
                    names=["id", "h", "mask", "hash", "place", "near"],
                )

    return run


def best_stretch(near: np.ndarray, item: np.ndarray, size: int, span: int, share: float) -> tuple[int, int, int]:
    """(words, words that agree, start relative to the hit) of the longest good stretch around a hit; zeros if none.

    Both sides are laid out as by ``_around``. A stretch starts and ends with
    words that agree, holds the places of the mask and is at least ``span``
    words, or the whole item if that is shorter (``size``).
    """
    equal = (near == item) & (item != 0)
    sums = np.concatenate([[0], np.cumsum(equal)])
    starts = np.flatnonzero(equal[: AROUND + 1])
    ends = np.flatnonzero(equal[len(equal) - AROUND - 1 :]) + len(equal) - AROUND
    if not len(starts) or not len(ends):
        return 0, 0, 0
    long = ends[None, :] - starts[:, None]
    agree = sums[ends][None, :] - sums[starts][:, None]
    good = np.where((long >= min(span, size)) & (agree >= share * long - 1e-9), long, 0)
    i, j = np.unravel_index(np.argmax(good), good.shape)
    return (int(long[i, j]), int(agree[i, j]), int(starts[i]) - AROUND) if good[i, j] else (0, 0, 0)


def _verify(span: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, item = batch.column("near"), batch.column("words")
            n_near, n_item = near.offsets.to_numpy(), item.offsets.to_numpy()
            near, item = near.values.to_numpy(), item.values.to_numpy()
            size, place = batch.column("size").to_numpy(), batch.column("place").to_numpy()
            keep, found = [], []
            for i in range(batch.num_rows):
                best = best_stretch(
                    near[n_near[i] : n_near[i + 1]], item[n_item[i] : n_item[i + 1]], int(size[i]), span, share
                )
                if best[0]:
                    keep.append(i)
                    found.append((best[0], best[1], int(place[i]) + best[2]))
            columns = list(zip(*found, strict=True)) if found else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(keep, pa.int64())) for c in ("id", "h", "item")]
                + [pa.array(c, pa.int64()) for c in columns],
                names=["id", "h", "item", "n_words", "n_equal", "start"],
            )

    return run


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    span: int = SPAN,
    share: float = SHARE,
) -> DataFrame:
    """(id, h, item, n_words, n_equal, start): the longest leak of each item in each row (``rows.keyed``)."""
    if not SPAN <= span <= AROUND or share < SHARE:
        raise ValueError(f"the masks find stretches from {SPAN} words and a share of {SHARE} on; span is at most {AROUND} words")
    spark = docs.sparkSession
    rows = items.select(items[f"`{item_key}`"].cast("string").alias("item"), items[f"`{item_text}`"].alias("text"))
    seeds = stage(rows.mapInArrow(_item_seeds, "item string, mask int, hash bigint, size bigint, words array<bigint>"), "test-seeds")
    shared = spark.sparkContext.broadcast(_bit_table(seeds))
    used = sorted(r.mask for r in seeds.select("mask").distinct().collect())
    texts = keyed(docs, text, key).select("id", "h", "text")
    hits = texts.mapInArrow(_hits(shared, used), "id string, h bigint, mask int, hash bigint, place bigint, near array<bigint>")
    pairs = hits.join(seeds, ["mask", "hash"]).select("id", "h", "item", "size", "place", "near", "words")
    leaks = pairs.mapInArrow(
        _verify(span, share), "id string, h bigint, item string, n_words bigint, n_equal bigint, start bigint"
    )
    best = F.max(F.struct("n_equal", "n_words", "start")).alias("best")
    return leaks.groupBy("id", "h", "item").agg(best).select("id", "h", "item", "best.n_words", "best.n_equal", "best.start")


def mark_leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """(``key``, leaks): for each row the leaks as an array of item, n_words, n_equal, start; empty if none."""
    leaks = stage(find_leaks(docs, items, text, key, **options), "leaks")
    per_row = leaks.groupBy("id", "h").agg(F.array_sort(F.collect_list(F.struct("item", "n_words", "n_equal", "start"))).alias("leaks"))
    rows = keyed(docs, text, key).select("key", "id", "h")
    joined = rows.join(per_row, ["id", "h"], "left")
    none = F.array().cast("array<struct<item:string,n_words:bigint,n_equal:bigint,start:bigint>>")
    return joined.select(F.col("key").alias(key), F.coalesce("leaks", none).alias("leaks"))


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The documents without any leak, with their own columns only."""
    leaks = stage(find_leaks(docs, items, text, key, **options).select("id", "h").distinct(), "leaks")
    packed = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("doc"),
        F.coalesce(docs[f"`{key}`"].cast("string"), F.lit("\0")).alias("id"),
        F.xxhash64(docs[f"`{text}`"]).alias("h"),
    )
    return packed.join(leaks, ["id", "h"], "left_anti").select("doc.*")
