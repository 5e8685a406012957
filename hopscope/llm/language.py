"""Language identification by Bayesian fusion of text, markup and address.

Text gives a likelihood from byte trigrams counted over all labelled texts. It
is tempered, since neighbouring trigrams are not independent. The declared
markup language enters through a table of how often pages of a language declare
each one, and the address through a prior that is smoothed from host to domain
to suffix to all rows; both come from grouped sums of the posteriors that text
alone gives, a row's own share taken out of its host's.

Defined cases: null or blank texts are judged by prior and markup; a missing
declaration or host gives no evidence; labelled texts of null language are not
counted; repeated rows are judged one by one; empty tables give an empty result,
and without labelled texts the language is null; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from hopscope.llm import words
from hopscope.sources.staging import stage

SLOT_BITS = 16
FULL_WEIGHT = 60.0  # independent trigrams that a long text counts for at most
STRENGTH = 5.0  # rows that a parent's rates count for in a host, domain or suffix
OWN, OTHER = 8.0, 1.0  # prior rows for declaring the own language, and any other
_MOST_LANGUAGES = 1000


class Model(NamedTuple):
    languages: list[str]
    logs: np.ndarray  # languages x slots
    share: np.ndarray  # of each language in the labelled rows


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all byte trigrams of the lower-case words, and offsets of each text."""
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    plain = pc.binary_join_element_wise(" ", lower, " ", "")
    offsets = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(plain)), dtype=np.int64)])
    data = np.frombuffer(b"".join(words.raw(plain)), np.uint8).astype(np.uint32)
    data[data < 33] = 32
    n = max(0, len(data) - 2)
    code = data[:n] << 16 | data[1 : n + 1] << 8 | data[2:]
    slot = ((code * np.uint32(2654435761)) >> np.uint32(32 - SLOT_BITS)).astype(np.int64)
    # A text of m bytes has m - 2 trigrams; those over its end are given to no text.
    return slot, offsets


def _row_of(offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    place = np.arange(n)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    use = place + 2 < offsets[1:][row]
    return row, use


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in words.slices(batches, "text"):
        slot, offsets = _trigrams(batch.column("text"))
        row, use = _row_of(offsets, len(slot))
        names = batch.column("lang").to_pylist()
        order = {name: i for i, name in enumerate(sorted(set(names)))}
        of = np.array([order[n] for n in names], np.int64)
        both = np.bincount(of[row[use]] << SLOT_BITS | slot[use], minlength=len(order) << SLOT_BITS)
        for name, i in order.items():
            tables[name] = tables.get(name, 0) + both[i << SLOT_BITS : (i + 1) << SLOT_BITS]
            rows[name] = rows.get(name, 0) + names.count(name)
    for name, table in tables.items():
        some = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name] * (len(some) + 1)),
                pa.array(np.concatenate([[-1], some]).astype(np.int32)),
                pa.array(np.concatenate([[rows[name]], table[some]]).astype(np.int64)),
            ],
            names=["lang", "slot", "n"],
        )


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """Counts of all labelled texts; at most 2**SLOT_BITS rows a language reach the driver."""
    rows = labelled.select(labelled[f"`{text}`"].alias("text"), labelled[f"`{lang}`"].cast("string").alias("lang"))
    rows = rows.filter("lang is not null")
    counts = rows.mapInArrow(_count, "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    names = sorted(set(found["lang"].to_pylist()))
    if not names:
        return None
    if len(names) > _MOST_LANGUAGES:
        raise ValueError(f"{len(names)} languages in the labels; at most {_MOST_LANGUAGES}")
    of = np.searchsorted(np.array(names), np.array(found["lang"].to_pylist()))
    slot, n = np.asarray(found["slot"]), np.asarray(found["n"])
    table, share = np.full((len(names), 1 << SLOT_BITS), 0.5), np.zeros(len(names))
    grams = slot >= 0
    table[of[grams], slot[grams]] += n[grams]
    share[of[~grams]] = n[~grams]
    logs = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    return Model(names, logs, (share + 1) / (share + 1).sum())


def _weigh(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in words.slices(batches, "text"):
            slot, offsets = _trigrams(batch.column("text"))
            row, use = _row_of(offsets, len(slot))
            rest = [c for c in batch.schema.names if c != "text"]
            sums = np.stack([np.bincount(row[use], x[slot[use]], minlength=batch.num_rows) for x in model.logs], axis=1)
            n = np.bincount(row[use], minlength=batch.num_rows)[:, None]
            log = sums / np.maximum(n, 1) * (FULL_WEIGHT * n / (FULL_WEIGHT + n))
            log -= log.max(axis=1, keepdims=True)
            ends = pa.array(np.arange(0, log.size + 1, log.shape[1], dtype=np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(log.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), lists], names=[*rest, "likelihood"])

    return run


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#\\s]+)", 1))
    return F.when(host != "", host)


def declared_of(html: Column) -> Column:
    tag = F.lower(F.regexp_extract(html, "(?i)<html[^>]*?\\slang\\s*=\\s*[\"']?([A-Za-z]{2,3})\\b", 1))
    return F.when(tag != "", tag)


def visible_text(html: Column) -> Column:
    return F.regexp_replace(html, "(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->|<[^>]*>", " ")


def _normal(logs: Column) -> Column:
    """Probabilities from logs."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def _sums(posterior: str, n: int) -> Column:
    return F.array(*(F.sum(F.get(F.col(posterior), F.lit(i))) for i in range(n)))


def identify(rows: DataFrame, model: Model | None) -> DataFrame:
    """(ref, lang, probability, text_lang, declared) of ``rows`` (ref, text, declared, host).

    ``ref`` may be of any type and is handed through.
    """
    if model is None:
        none = F.lit(None).cast("string")
        return rows.select("ref", none.alias("lang"), F.lit(None).cast("double").alias("probability"), none.alias("text_lang"), "declared")
    size, names = len(model.languages), F.array(*map(F.lit, model.languages))
    spread = F.array(*(F.lit(float(x)) for x in model.share))
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*rows.select("ref", "declared", "host").schema.fields]).add("likelihood", ArrayType(DoubleType()))
    # Only two or three letters are a declaration, which bounds how many there are.
    plain = F.lower("declared")
    rows = rows.withColumn("declared", F.when(plain.rlike("^[a-z]{2,3}$"), plain))
    weighed = rows.select("ref", "declared", "host", "text").mapInArrow(_weigh(shared), schema)
    alone = _normal(F.transform("likelihood", lambda x, i: x + F.log(F.get(spread, i))))
    labels = F.split(F.col("host"), "\\.")
    seen = stage(
        weighed.withColumn("alone", alone)
        .withColumn("suffix", F.element_at(labels, -1))
        .withColumn("domain", F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.col("host"))),
        "weighed",
    )

    # Rates of suffix, domain and host, each smoothed by the one above it.
    mixed = lambda sums, n, parent: F.transform(sums, lambda x, i: (x + STRENGTH * F.get(parent, i)) / (n + STRENGTH))
    hosts = stage(
        seen.filter("host is not null").groupBy("suffix", "domain", "host").agg(F.count(F.lit(1)).alias("n"), _sums("alone", size).alias("sums")),
        "host-sums",
    )

    def level(keys):
        return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), _sums("sums", size).alias("sums"))

    suffixes = level(["suffix"]).select("suffix", mixed(F.col("sums"), F.col("n"), spread).alias("suffix_rate"))
    domains = level(["suffix", "domain"]).join(suffixes, "suffix")
    domains = domains.select("domain", "suffix", mixed(F.col("sums"), F.col("n"), F.col("suffix_rate")).alias("parent"))
    hosts = stage(hosts.join(domains, ["suffix", "domain"]).select("host", "n", "sums", "parent"), "host-rates")

    # How often rows of a language declare each language; at most 26**2 + 26**3 declarations.
    said = seen.filter("declared is not null").groupBy("declared").agg(_sums("alone", size).alias("said"))
    totals = said.agg(_sums("said", size).alias("t"), F.count(F.lit(1)).alias("kinds")).first()
    whole = F.array(*(F.lit(float(x or 0.0) + OWN + OTHER * (totals.kinds or 0)) for x in (totals.t or [0.0] * size)))
    said = said.select(
        "declared",
        F.transform(
            "said",
            lambda x, i: F.log((x + OTHER + F.when(F.get(names, i) == F.col("declared"), OWN).otherwise(0.0)) / F.get(whole, i)),
        ).alias("said"),
    )

    joined = seen.join(F.broadcast(said), "declared", "left").join(hosts, "host", "left")
    # The host's other rows and its parents; without a host the share of the labels.
    others = F.transform(
        "sums",
        lambda x, i: F.greatest(x - F.get(F.col("alone"), i) + STRENGTH * F.get(F.col("parent"), i), F.lit(1e-9)) / (F.col("n") - 1 + STRENGTH),
    )
    prior = F.coalesce(others, spread)
    logs = F.transform(
        "likelihood", lambda x, i: x + F.log(F.get(F.col("prior"), i)) + F.coalesce(F.get(F.col("said"), i), F.lit(0.0))
    )
    out = joined.withColumn("prior", prior).withColumn("posterior", _normal(logs))
    first = lambda column: F.get(names, (F.array_position(column, F.array_max(column)) - 1).cast("int"))
    return out.select(
        "ref",
        first(F.col("posterior")).alias("lang"),
        F.array_max("posterior").alias("probability"),
        first(F.col("alone")).alias("text_lang"),
        "declared",
    )

