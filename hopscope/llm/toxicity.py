"""Toxicity by two class-conditional Kneser-Ney bigram models over word stems.

An expression is a pair of stems, the first letters of words. Each class counts
its pairs; a pair backs off to the pair's counts in the whole corpus, labelled or
not, weighted by the stem's own ratio, and a stem backs off to how many different
stems it follows there. The classes are counted on equally many rows,
so that their backoff weights are alike. A text's score rests on the difference
of the two log-likelihoods, of both orders, less the median over its words,
which language and topic add to every word alike; it is divided by the number of
words and by its root. A logistic curve fitted to labelled rows that took no part
in the counts makes it a probability.

Stems live in ``2**STEM_BITS`` hashed slots, pairs in ``2**PAIR_BITS``, so the
model has a fixed size whatever the corpus. Class counts come from at most
``labels.MOST_PER_CLASS`` rows of each class, the backoff of pairs and stems from
all rows: each task adds up its pairs, Spark the sums of the tasks.

Defined cases: null and blank texts get the score of a mean difference of 0;
without labels of both classes every score is 0.5; repeated rows are scored
one by one; an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopscope.llm import labels as lab
from hopscope.llm import words
from hopscope.sources.staging import stage

STEM_BITS = 18
PAIR_BITS = 20
_LEVELS, _CELLS = 8, 16  # of the sketch of a stem's different left neighbours
THRESHOLD = 0.3
STEM = 4
PAIR_DISCOUNT, PAIR_STRENGTH = 2.0, 50.0
_START = 0  # slot of the start of a text
_ALONE = -1  # in place of a neighbour: rows of single stems
_CLASSES = ("ordinary", "toxic")
_POOL = len(_CLASSES)  # for rows that count in the shared counts only
_MOST_HELD = 1 << 21  # words, and different pairs, that a task adds up before it hands them on


def slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stem slots, slots of the stems before them, and offsets of each text."""
    hashes, offsets = words.plain_hashes(texts, STEM)
    stem = (hashes >> np.uint64(64 - STEM_BITS)).astype(np.int64)
    before = np.concatenate([[_START], stem[:-1]]) if len(stem) else stem.copy()
    before[offsets[:-1][np.diff(offsets) > 0]] = _START
    return stem, before, offsets


def pair_slot(before: np.ndarray, stem: np.ndarray) -> np.ndarray:
    return (words.mix((before << STEM_BITS | stem).astype(np.uint64)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def _cells(before: np.ndarray, stem: np.ndarray) -> np.ndarray:
    """Sketch cell of a pair: each level holds a quarter of the pairs of the level before."""
    h = words.mix((before << STEM_BITS | stem).astype(np.uint64) + np.uint64(1))
    zeros = np.zeros(len(h), np.int64)
    rest = h >> np.uint64(8)
    for level in range(1, _LEVELS):
        zeros += (rest & np.uint64((1 << 2 * level) - 1)) == 0
    return (stem * _LEVELS + zeros) * _CELLS + (h & np.uint64(_CELLS - 1)).astype(np.int64)


def different(sketch: np.ndarray) -> np.ndarray:
    """Estimate of how many different pairs a sketch has seen, from its first level that isn't nearly full."""
    filled = sketch.reshape(-1, _LEVELS, _CELLS).sum(axis=2)
    level = np.argmax(filled <= 0.75 * _CELLS, axis=1)
    level = np.where((filled > 0.75 * _CELLS).all(axis=1), _LEVELS - 1, level)
    f = np.minimum(filled[np.arange(len(filled)), level], _CELLS - 0.5)
    share = np.where(level < _LEVELS - 1, 0.75, 1.0) * 0.25**level
    return -_CELLS * np.log(1 - f / _CELLS) / share


def _gather(shared):
    """Corpus counts: sketches and pair counts of all rows, and pair counts of the sampled rows of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        role = shared.value
        seen = np.zeros((1 << STEM_BITS) * _LEVELS * _CELLS, bool)
        alone = np.zeros((2, 1 << STEM_BITS), np.int64)
        sums = np.zeros(0, np.int64), np.zeros(0, np.int64)  # pairs with their class, times
        pairs: list[np.ndarray] = []

        def add():
            code, times = np.unique(np.concatenate(pairs) if pairs else np.zeros(0, np.int64), return_counts=True)
            pairs.clear()
            code, at = np.unique(np.concatenate([sums[0], code]), return_inverse=True)
            total = np.zeros(len(code), np.int64)
            np.add.at(total, at, np.concatenate([sums[1], times]))
            return code, total

        def rows_of(code, times):
            of, pair = code & 3, code >> 2
            return _rows(pair >> STEM_BITS, pair & (1 << STEM_BITS) - 1, times * (of == 0), times * (of == 1), times)

        held = 0
        for batch in words.slices(batches, "text"):
            stem, before, offsets = slots(batch.column("text"))
            seen[_cells(before, stem)] = True
            known = [role.get(k, (0, True)) for k in batch.column("id").to_pylist()]
            of = np.repeat(np.array([_POOL if c else v for v, c in known], np.int64), np.diff(offsets))
            pairs.append((before << STEM_BITS | stem) << 2 | of)
            use = np.flatnonzero(of != _POOL)
            np.add.at(alone, (of[use], stem[use]), 1)
            held += len(stem)
            if held > _MOST_HELD:
                sums, held = add(), 0
                if len(sums[0]) > _MOST_HELD:
                    yield rows_of(*sums)
                    sums = sums[0][:0], sums[1][:0]
        sums = add()
        yield rows_of(*sums)
        packed = np.packbits(seen, bitorder="little").view(np.int64).reshape(1 << STEM_BITS, 2)
        some = np.flatnonzero(packed.any(axis=1))
        none = np.zeros(len(some), np.int64)
        yield _rows(np.full(len(some), _ALONE), some, *alone[:, some], none, packed[some, 0], packed[some, 1])

    return run


def _rows(before, stem, ordinary, toxic, pool, low=None, high=None) -> pa.RecordBatch:
    none = np.zeros(len(stem), np.int64)
    columns = (ordinary, toxic, pool, none if low is None else low, none if high is None else high)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(x).astype(np.int32)) for x in (before, stem)] + [pa.array(np.asarray(x).astype(np.int64)) for x in columns],
        names=["before", "stem", *_CLASSES, "pool", "low", "high"],
    )


class Model(NamedTuple):
    """Arrays by slot; where there are two, the first is of the ordinary class."""

    pair: np.ndarray  # discounted counts of pairs: both classes, then the whole corpus
    after: np.ndarray  # words after a stem, both classes, then the whole corpus
    left: np.ndarray  # of these, what the discounts leave to the backoff
    ratio: np.ndarray  # share of a stem in a class, by its shared share
    shared: np.ndarray  # share of a stem in the backoff of both classes
    curve: tuple[float, ...] = (0.0,) * 5

    def features(self, texts: pa.Array) -> np.ndarray:
        """Per text, for stems and pairs: the centred difference of the log-likelihoods, over words and over their root."""
        stem, before, offsets = slots(texts)
        lens = np.diff(offsets)
        at = pair_slot(before, stem)
        after = np.maximum(self.after[:, before], 1e-9)
        pooled = (self.pair[2][at] + np.where(self.after[2][before] > 0, self.left[2][before], 1e-9) * self.shared[stem]) / after[2]
        logs = []
        for c in (0, 1):
            backed = (self.left[c][before] + PAIR_STRENGTH) * pooled * self.ratio[c][stem]
            logs.append(np.log(self.pair[c][at] + backed) - np.log(self.after[c][before] + PAIR_STRENGTH))
        out = [_centred(np.log(self.ratio[1] / self.ratio[0])[stem], lens), _centred(logs[1] - logs[0], lens)]
        size = np.maximum(lens, 1)
        return np.stack([x / f for x in out for f in (size, np.sqrt(size))], axis=1)

    def score(self, features: np.ndarray) -> np.ndarray:
        return lab.sigmoid(features @ np.array(self.curve[:-1]) + self.curve[-1])


def _centred(values: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Sum for each text, less its median for each word; 0 for a text without words."""
    out = np.zeros(len(lens))
    full = np.flatnonzero(lens)
    if len(full):
        first = (np.cumsum(lens) - lens)[full]
        ordered = values[np.lexsort((values, np.repeat(np.arange(len(lens)), lens)))]
        out[full] = np.add.reduceat(values.astype(np.float64), first) - lens[full] * ordered[first + (lens[full] - 1) // 2]
    return out


def count_model(texts: DataFrame, role: dict[str, tuple[int, bool]]) -> Model:
    """The model without its curve, from one pass over all texts (``id``, ``text``).

    What reaches the driver is bounded by the slots.
    """
    shared = texts.sparkSession.sparkContext.broadcast(role)
    rows = texts.mapInArrow(_gather(shared), "before int, stem int, ordinary bigint, toxic bigint, pool bigint, low bigint, high bigint")
    counts = stage(
        rows.groupBy("before", "stem").agg(
            *(F.sum(c).alias(c) for c in (*_CLASSES, "pool")), *(F.bit_or(c).alias(c) for c in ("low", "high"))
        ),
        "lm-counts",
    )
    size = 1 << STEM_BITS
    rows = counts.filter(F.col("before") == _ALONE).toArrow()
    at, packed, alone = np.asarray(rows["stem"]), np.zeros((size, 2), np.int64), np.zeros((2, size))
    packed[at] = np.stack([np.asarray(rows["low"]), np.asarray(rows["high"])], axis=1)
    follows = different(np.unpackbits(packed.view(np.uint8), bitorder="little")) + 0.5
    shared_stem = follows / follows.sum()
    ratio = np.zeros((2, size))
    for i, c in enumerate(_CLASSES):
        alone[i, at] = np.asarray(rows[c])
        once, twice = (alone[i] == 1).sum(), (alone[i] == 2).sum()
        cut = np.maximum(alone[i] - (once / (once + 2 * twice) if once and twice else 0.5), 0) / max(alone[i].sum(), 1.0)
        ratio[i] = cut / shared_stem + 1 - cut.sum()

    pairs = counts.filter(F.col("before") != _ALONE)
    kinds = (*_CLASSES, "pool")
    kept = {c: F.greatest(F.col(c) - F.lit(PAIR_DISCOUNT), F.lit(0.0)) for c in kinds}
    sums = pairs.groupBy("before").agg(
        *(F.sum(c).alias(c) for c in kinds), *(F.sum(kept[c]).alias(f"kept_{c}") for c in kinds)
    ).toArrow()
    hashed = pairs.filter(F.col("pool") > PAIR_DISCOUNT).select("before", "stem", *(kept[c].alias(c) for c in kinds))
    hashed = hashed.mapInArrow(_to_slots, "slot int, ordinary double, toxic double, pool double")
    hashed = hashed.groupBy("slot").agg(*(F.sum(c).cast("float").alias(c) for c in kinds)).toArrow()
    pair = np.zeros((3, 1 << PAIR_BITS), np.float32)
    after, left = np.zeros((3, size), np.float32), np.zeros((3, size), np.float32)
    before = np.asarray(sums["before"])
    for i, c in enumerate(kinds):
        pair[i, np.asarray(hashed["slot"])] = np.asarray(hashed[c])
        after[i, before] = np.asarray(sums[c])
        left[i, before] = np.asarray(sums[c]) - np.asarray(sums[f"kept_{c}"])
    return Model(pair, after, left, ratio.astype(np.float32), shared_stem.astype(np.float32))


def _to_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slot of each pair, by the same function as in the scoring tasks."""
    for batch in batches:
        before, stem = (np.asarray(batch.column(c)).astype(np.int64) for c in ("before", "stem"))
        slot = pa.array(pair_slot(before, stem).astype(np.int32))
        kinds = (*_CLASSES, "pool")
        yield pa.RecordBatch.from_arrays([slot, *(batch.column(c) for c in kinds)], names=["slot", *kinds])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Model | None:
    """The fitted model, or None without labelled rows of both classes."""
    role = lab.balanced(lab.sample(labels, label, key))
    if {v for v, _ in role.values()} != {0, 1}:
        return None
    texts = docs.select(docs[f"`{key}`"].cast("string").alias("id"), docs[f"`{text}`"].alias("text"))
    model = count_model(texts, role)
    spark = docs.sparkSession
    names = ("stem_mean", "stem_root", "pair_mean", "pair_root")
    shared, known = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(role)

    def calibrating(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [known.value.get(k, (0, False)) for k in batch.column("id").to_pylist()]
            batch = batch.append_column("label", pa.array([v for v, _ in found], pa.int32())).filter(pa.array([c for _, c in found]))
            for part in words.slices(iter([batch]), "text"):
                columns = [pa.array(np.ascontiguousarray(x)) for x in shared.value.features(part.column("text")).T]
                yield pa.RecordBatch.from_arrays([part.column("label"), *columns], names=["label", *names])

    # At most a quarter of the bounded sample.
    points = texts.mapInArrow(calibrating, "label int, " + ", ".join(f"{c} double" for c in names)).toArrow()
    y, x = np.asarray(points["label"]).astype(float), np.stack([np.asarray(points[c]) for c in names], axis=1)
    if len(set(y.tolist())) < 2:
        return model._replace(curve=(0.0, 1.0, 0.0, 1.0, 0.0))
    middle, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    w = lab.fit_logistic(np.column_stack([(x - middle) / spread, np.ones(len(x))]), y)
    slope = w[:-1] / spread
    return model._replace(curve=(*map(float, slope), float(w[-1] - slope @ middle)))


def score(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(``key``, mean_difference, score, predicted) of each row."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[f"`{key}`"].alias("key"), docs[f"`{text}`"].alias("text"))
    if model is None:
        scored = rows.select("key", F.lit(0.0).alias("mean_difference"), F.lit(0.5).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in words.slices(batches, "text"):
                found = shared.value.features(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array(np.ascontiguousarray(found[:, 2])), pa.array(shared.value.score(found))],
                    names=["key", "mean_difference", "score"],
                )

        scored = rows.mapInArrow(run, f"key {kind}, mean_difference double, score double")
    return scored.select(F.col("key").alias(key), "mean_difference", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
