"""Quality by Bradley-Terry ranking: scores learnt from preference pairs.

A pair is a good and a bad labelled text. Its logistic loss is taken on the
difference of their features, so only what sets the two apart counts and no
intercept is learnt. Pairs come from a Spark join on pair numbers, in which
every labelled row takes part. The score of a text is the logistic of its rank
value, set so that the ``threshold`` falls on the quantile that the share of
bad labels gives.

Features are shares of characters and words, so that long and short texts
compare; the length itself enters as a logarithm. The fit uses all labelled
rows outside the held-out fold: the tasks add up the loss and its slopes over
the pairs, and only these sums and the counts of the quantile reach the driver.

Defined cases: null and blank texts have features of 0; without labels of both
classes every score is 0.5; repeated rows are scored one by one; an empty table
gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hopscope.llm import labels as lab
from hopscope.llm import words
from hopscope.sources.staging import stage

NUMBER_BUCKETS = 4096
QUANTILE_BINS = 1024
THRESHOLD = 0.7
FEATURES = (
    "upper", "digit", "mark", "symbol", "bar", "bang", "other_ascii", "long_words", "short_words", "word_chars",
    "distinct_words", "line_words", "repeated_lines", "marked_words", "log_words", "few_words",
)
_BYTES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "mark": b".,;:?'\"-()",
    "symbol": b"#*$%&<>^~@+=_/\\{}[]`",
    "bar": b"|",
    "bang": b"!",
}


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_KINDS = {name: _table(chars) for name, chars in _BYTES.items()}


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def measure(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    texts = pc.fill_null(texts, "")
    found, offsets = words.split(texts)
    index = np.asarray(found.indices) if len(found) else np.zeros(0, np.int64)
    forms = found.dictionary
    data = words.raw(forms)
    flat = np.frombuffer(b"".join(data), np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(w) for w in data])]).astype(np.int64)
    per_form = {name: _sums(kind[flat], ends) for name, kind in _KINDS.items()}
    per_form["other_ascii"] = _sums(flat < 32, ends)
    chars = np.asarray(pc.utf8_length(forms)).astype(float) if len(forms) else np.zeros(0)
    lens = np.diff(offsets).astype(float)
    n = np.maximum(lens, 1)
    total = _float_sums(chars[index], offsets)
    size = np.maximum(total, 1)
    out = {name: _float_sums(x[index], offsets) / size for name, x in per_form.items()}
    out["long_words"] = _float_sums((chars > 12)[index], offsets) / n
    out["short_words"] = _float_sums((chars <= 3)[index], offsets) / n
    out["word_chars"] = total / n / 10
    odd = (per_form["symbol"] + per_form["bar"] + per_form["bang"]) > 0
    out["marked_words"] = _float_sums(odd[index], offsets) / n
    row = np.repeat(np.arange(len(lens)), np.diff(offsets))
    distinct = np.unique(row.astype(np.int64) * max(1, len(forms)) + index) // max(1, len(forms))
    out["distinct_words"] = np.bincount(distinct, minlength=len(lens)) / n
    lines = pc.split_pattern(texts, "\n")
    filled = pc.list_flatten(lines)
    of_line = np.asarray(pc.list_parent_indices(lines))
    there = np.asarray(pc.greater(pc.binary_length(pc.ascii_trim_whitespace(filled)), 0))
    code = np.asarray(filled.dictionary_encode().indices) if len(filled) else np.zeros(0, np.int64)
    of_line, code = of_line[there], code[there].astype(np.int64)
    n_lines = np.bincount(of_line, minlength=len(lens)).astype(float)
    unique = np.unique(of_line.astype(np.int64) * (len(filled) + 1) + code) // (len(filled) + 1)
    repeated = n_lines - np.bincount(unique, minlength=len(lens))
    out["repeated_lines"] = repeated / np.maximum(n_lines, 1)
    out["line_words"] = np.minimum(lens / np.maximum(n_lines, 1), 100) / 100
    out["log_words"] = np.log1p(lens) / 10
    out["few_words"] = (lens < 50).astype(float)
    return np.stack([np.where(lens > 0, out[name], 0.0) for name in FEATURES], axis=1)


def _float_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


class Ranking(NamedTuple):
    middle: np.ndarray
    spread: np.ndarray
    weight: np.ndarray
    cut: float = 0.0  # rank value at the quantile
    scale: float = 1.0

    def value(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.middle) / self.spread, -8, 8) @ self.weight

    def score(self, features: np.ndarray, threshold: float) -> np.ndarray:
        shift = np.log(threshold / (1 - threshold))
        return lab.sigmoid((self.value(features) - self.cut) / self.scale + shift)


def labelled_features(docs: DataFrame, known: DataFrame, text: str, key: str) -> DataFrame:
    """(id, label, features) of all labelled rows; the narrow features meet the labels, not the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in words.slices(batches, "text"):
            features = pa.array(measure(part.column("text")).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("id"), features], names=["id", "features"])

    texts = docs.select(docs[f"`{key}`"].cast("string").alias("id"), docs[f"`{text}`"].alias("text"))
    texts = texts.filter(F.col("id").isNotNull() & ~lab.held_out(F.col("id")))
    measured = texts.mapInArrow(run, "id string, features array<double>")
    return measured.join(known.withColumnRenamed("key", "id"), "id").select("id", "label", "features")


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with their ``number``, gapless from 0 within each label, by buckets of a hash."""
    hashed = rows.withColumn("_hash", F.xxhash64("id", "features"))
    hashed = hashed.withColumn("_bucket", F.pmod("_hash", F.lit(NUMBER_BUCKETS)))
    before = Window.partitionBy("label").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hashed.groupBy("label", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    # One row for each bucket, a fixed number whatever the table.
    starts = sizes.select("label", "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("label", "_bucket").orderBy("_hash", "id", "features"))
    joined = hashed.withColumn("_place", place).join(starts, ["label", "_bucket"])
    return joined.select("label", "features", (F.col("_start") + F.col("_place") - 1).alias("number"))


def preference_pairs(rows: DataFrame) -> DataFrame:
    """(good, bad) features: every row is in a pair, by number.

    Row i of the smaller class meets the rows i, i + n, i + 2n, ... of the
    larger one, so each row of the larger class is used once.
    """
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    small, large = sorted((0, 1), key=lambda v: counts.get(v, 0))
    n = max(1, counts.get(small, 0))
    by_number = numbered(rows)
    few = by_number.filter(F.col("label") == small).select("number", F.col("features").alias("few"))
    many = by_number.filter(F.col("label") == large).select(F.pmod("number", F.lit(n)).alias("number"), F.col("features").alias("many"))
    good, bad = ("few", "many") if small == 1 else ("many", "few")
    return few.join(many, "number").select(F.col(good).alias("good"), F.col(bad).alias("bad"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(FEATURES))


def middle_and_spread(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each feature over both sides of all pairs."""
    size = range(len(FEATURES))
    found = [F.array(*[f(F.get(side, F.lit(i))) for i in size]) for side in ("good", "bad") for f in (F.avg, F.var_pop)]
    good, good_var, bad, bad_var = (np.array(x) for x in pairs.agg(*[x.alias(f"x{k}") for k, x in enumerate(found)]).first())
    spread = np.sqrt((good_var + bad_var) / 2 + ((good - bad) / 2) ** 2)
    return (good + bad) / 2, np.maximum(spread, 1e-6)


def fit_pairs(pairs: DataFrame, middle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Weights by Newton's method: a pass over all pairs adds up the loss, its slope and its curve."""
    size = len(FEATURES)

    def sums(w: np.ndarray) -> tuple[int, float, np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(2 + size + size * size)
            for batch in batches:
                good, bad = (np.clip((_matrix(batch.column(c)) - middle) / spread, -8, 8) for c in ("good", "bad"))
                ones = np.ones(len(good))
                n, loss, slope, curve = lab.logistic_sums(good - bad, ones, ones, w)
                total += np.concatenate([[n, loss], slope, curve.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])

        parts = pairs.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("at", "part"))
        total = np.zeros(2 + size + size * size)
        for row in parts.groupBy("at").agg(F.sum("part").alias("part")).collect():
            total[row["at"]] = row["part"]
        return int(total[0]), float(total[1]), total[2 : 2 + size], total[2 + size :].reshape(size, size)

    return lab.newton(sums, size)


def at_rank(values: DataFrame, rank: int) -> float:
    """The ``value`` with exactly ``rank`` rows before it in order: counts in bins, again within the bin that holds it."""
    value = F.col("value")
    low, high = values.agg(F.min(value), F.max(value)).first()
    before = 0
    while low < high:
        place = F.least(F.floor((value - low) / (high - low) * QUANTILE_BINS), F.lit(QUANTILE_BINS - 1))
        inside = values.filter(value.between(low, high)).groupBy(place.alias("bin"))
        for row in sorted(inside.agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).collect()):
            if before + row.n > rank:
                break
            before += row.n
        low, high = row.low, row.high
    return low


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality") -> Ranking | None:
    """The fitted ranking over all labelled rows, or None without such rows of both classes."""
    known = lab.known(labels, label, key)
    if known.select("label").distinct().count() < 2:
        return None
    rows = stage(labelled_features(docs, known, text, key), "labelled-features")
    if rows.select("label").distinct().count() < 2:
        return None
    pairs = stage(preference_pairs(rows), "preference-pairs")
    middle, spread = middle_and_spread(pairs)
    ranking = Ranking(middle, spread, fit_pairs(pairs, middle, spread))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = pa.array(ranking.value(_matrix(batch.column("features"))))
            yield pa.RecordBatch.from_arrays([batch.column("label"), value], names=["label", "value"])

    values = stage(rows.select("label", "features").mapInArrow(run, "label int, value double"), "rank-values")
    bad, deviation = values.agg(F.count_if(F.col("label") == 0), F.stddev_pop("value")).first()
    # Middle of the step at which as many values lie below as there are rows of label 0.
    cut = (at_rank(values, bad - 1) + at_rank(values, bad)) / 2
    return ranking._replace(cut=cut, scale=max(1e-6, deviation / 4))


def score(docs: DataFrame, ranking: Ranking | None, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(``key``, rank_value, score, predicted) of each row."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[f"`{key}`"].alias("key"), docs[f"`{text}`"].alias("text"))
    if ranking is None:
        scored = rows.select("key", F.lit(0.0).alias("rank_value"), F.lit(0.5).alias("score"))
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in words.slices(batches, "text"):
                features = measure(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array(ranking.value(features)), pa.array(ranking.score(features, threshold))],
                    names=["key", "rank_value", "score"],
                )

        scored = rows.mapInArrow(run, f"key {kind}, rank_value double, score double")
    return scored.select(F.col("key").alias(key), "rank_value", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
