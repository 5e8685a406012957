"""Removal of repeated word sequences: winnowed seeds, extended both ways.

Every window of ``length`` words holds one selected anchor, the least hash of
its ``SEED``-word grams (the last of equal ones), at a place that depends on the
words of the window alone. Two equal windows so share an anchor at the same
place. Anchors found once are dropped. The others are extended both ways by the
words that windows around them can reach, their context: where a whole context
occurs again, all its windows do. Where only the anchor does, the windows are
compared one by one, each distinct context once. Windows that start anywhere
else too grow together into the maximal repeats that are removed.

Defined cases: null and blank texts have no words; a text shorter than the
window keeps all its words; repeated rows repeat each other's windows; an empty
table gives an empty result; other columns are not looked at. Sequences are
compared by 128 bits (anchor, and context or window).

Scale: anchors are counted with partial sums, so a passage in a third of all
rows is one row a task; joins on hot anchors are plain equality joins, which AQE
splits. Text is shuffled once whole, and once for rows with open windows.
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

LENGTH = 35
SEED = 8
_FACTOR = np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))


def anchors_of(hashes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of each selected anchor in order: its place, the first and last window start that select it, its hash."""
    starts = len(hashes) - length + 1
    if starts <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    grams = words.mix(words.windows(hashes, SEED))
    span = length - SEED + 1
    at, width = np.arange(len(grams)), 1
    while width < span:  # the last least gram of the next ``width`` ones
        step = min(width, span - width)
        right = at[step:]
        left = at[: len(right)]
        at = np.where(grams[right] <= grams[left], right, left)
        width += step
    at = at[:starts]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:] - 1, [starts - 1]])
    return at[first], first, last, grams[at[first]]


def _range_hashes(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the words in each [lo, hi), by prefix sums of word * factor**place."""
    n = len(hashes)
    powers, back = np.full(n + 1, _FACTOR), np.full(n + 1, _INVERSE)
    powers[0] = back[0] = 1
    powers, back = np.multiply.accumulate(powers), np.multiply.accumulate(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(hashes * powers[:n])])
    return (sums[hi] - sums[lo]) * back[lo]


def _anchor_rows(length: int, with_context: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            hashes, offsets = words.hashed(batch.column("text"))
            rows, parts = [], []
            for i in np.flatnonzero(np.diff(offsets) >= length):
                own = hashes[offsets[i] : offsets[i + 1]]
                at, first, last, anchor = anchors_of(own, length)
                if with_context:
                    lo, hi = np.maximum(0, first), np.minimum(len(own), last + length)
                    # What a context covers follows from its windows; their places in it belong to it.
                    place = ((at - lo) * 4099 + (last - first)).astype(np.uint64)
                    context = words.mix(_range_hashes(own, lo, hi) + words.mix(place))
                    parts.append((anchor, context, first, last))
                    rows.append(np.full(len(at), i))
                else:
                    parts.append((anchor,))
            if not parts:
                continue
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
            if with_context:
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(take),
                        batch.column("h").take(take),
                        pa.array(columns[0].view(np.int64)),
                        pa.array(columns[1].view(np.int64)),
                        pa.array(columns[2].astype(np.int32)),
                        pa.array(columns[3].astype(np.int32)),
                    ],
                    names=["id", "h", "anchor", "context", "first", "last"],
                )
            else:
                anchor, times = np.unique(columns[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(times.astype(np.int32))], names=["anchor", "times"]
                )

    return run


def _window_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            hashes, offsets = words.hashed(batch.column("text"))
            rows, parts = [], []
            for i, spots in enumerate(batch.column("spots").to_pylist()):
                own = hashes[offsets[i] : offsets[i + 1]]
                for spot in spots:
                    start = np.arange(spot["first"], spot["last"] + 1)
                    win = words.mix(_range_hashes(own[start[0] : start[-1] + length], start - start[0], start - start[0] + length))
                    parts.append((np.full(len(start), spot["anchor"], np.int64), win.view(np.int64), start))
                    rows.append(np.full(len(start), i))
            if parts:
                take = pa.array(np.concatenate(rows))
                anchor, win, start = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(take),
                        batch.column("h").take(take),
                        pa.array(anchor),
                        pa.array(win),
                        pa.array(start.astype(np.int32)),
                    ],
                    names=["id", "h", "anchor", "win", "start"],
                )

    return run


def find_repeats(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, h, spans): the word ranges, end exclusive, covered by windows that also start elsewhere.

    ``rows`` as from ``rows.keyed``. A row is listed only if it has such a window.
    """
    texts = rows.select("id", "h", "text")
    again = (
        texts.select("text")
        .mapInArrow(_anchor_rows(length, False), "anchor bigint, times int")
        .groupBy("anchor")
        .agg(F.sum("times").alias("times"))
        .filter("times > 1")
        .select("anchor")
    )
    # Stored, as the other key sides below, so that the join deals both sides anew and can split a hot anchor.
    again = stage(again, "again")
    anchors = texts.mapInArrow(
        _anchor_rows(length, True), "id string, h bigint, anchor bigint, context bigint, first int, last int"
    )
    seeds = stage(anchors.join(again, "anchor", "left_semi"), "seeds")

    spot = F.struct("id", "h", "first", "last")
    contexts = stage(
        seeds.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("times"), F.min(spot).alias("spot")), "contexts"
    )
    whole = seeds.join(contexts.filter("times > 1").select("anchor", "context"), ["anchor", "context"], "left_semi")
    whole = whole.select("id", "h", F.col("first").alias("lo"), (F.col("last") + length).alias("hi"))

    # Anchors with several contexts: compare the windows of one occurrence of each.
    several = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    several = stage(several, "several")
    open_ = contexts.join(several, "anchor", "left_semi").select("spot.id", "spot.h", "anchor", "spot.first", "spot.last")
    spots = stage(
        open_.groupBy("id", "h").agg(F.collect_list(F.struct("anchor", "first", "last")).alias("spots")), "spots"
    )
    windows = stage(
        texts.join(spots, ["id", "h"]).mapInArrow(
            _window_rows(length), "id string, h bigint, anchor bigint, win bigint, start int"
        ),
        "windows",
    )
    twice = windows.groupBy("anchor", "win").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor", "win")
    twice = stage(twice, "twice")
    single = windows.join(twice, ["anchor", "win"], "left_semi")
    single = single.select("id", "h", F.col("start").alias("lo"), (F.col("start") + length).alias("hi"))
    return whole.unionByName(single).groupBy("id", "h").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in words.slices(batches, "text"):
        found, offsets = words.split(batch.column("text"))
        known, index = words.raw(found.dictionary), np.asarray(found.indices) if len(found) else np.zeros(0, np.int32)
        spans = batch.column("spans")
        total, removed, kept = [], [], []
        for i in range(batch.num_rows):
            own = index[offsets[i] : offsets[i + 1]]
            if spans[i].is_valid:
                ranges = spans.slice(i, 1).flatten()
                edge = np.zeros(len(own) + 1, np.int64)
                np.add.at(edge, np.asarray(ranges.field("lo")), 1)
                np.add.at(edge, np.asarray(ranges.field("hi")), -1)
                rest = own[np.cumsum(edge[:-1]) == 0]
            else:
                rest = own
            total.append(len(own))
            removed.append(len(own) - len(rest))
            kept.append(b" ".join([known[j] for j in rest.tolist()]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                pa.array(total, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["key", "n_words", "n_removed", "kept_text"],
        )


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """(``key``, n_words, n_removed, kept_text): the words left, joined by one space."""
    if length < SEED:
        raise ValueError(f"a window has at least {SEED} words")
    rows = keyed(docs, text, key)
    spans = stage(find_repeats(rows, length), "repeats")
    # A left join keeps rows without repeats; a repeated row meets its spans twice over nothing else.
    joined = rows.join(spans, ["id", "h"], "left").select("key", "text", "spans")
    kind = docs.schema[key].dataType.simpleString()
    return joined.mapInArrow(_cut, f"key {kind}, n_words bigint, n_removed bigint, kept_text string").withColumnRenamed("key", key)
