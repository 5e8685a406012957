"""N-gram Jaccard join by MinHash banding, and classes of near copies.

A text is the set of its five-word shingles (a text of one to four words is one
shingle). Texts with equal sets are one vertex. Each vertex has ``bands`` hashes
of ``rows`` minima, chosen for the target recall at the threshold. Vertices that
share a band hash are gathered into families (components over one star per
band bucket, so a hot bucket gives as many rows as it has members). The members
of a family are dealt to blocks of bounded size, and verified on the full shingle
sets, by a product of matrices: first each block in itself, then, in families of
several blocks, each pair of blocks. What leaves a block is one row for each
member, with its links and the root of the members it is connected to; what leaves a pair of
blocks are link counts and one edge for each two roots that it connects first. No pairs leave
either, and no link is lost unless the bands miss it and every path around it.

Moved are one shingle set for each member of a family, and in families of B blocks
each set B - 1 times more. The comparing itself takes quadratic time in the
distinct sets of a family, since the links of every one of them are counted.

Defined cases: a null text is alone in its class; a class in which no row has a key has a null id, and its
distinct texts all stay in ``keep_one``; blank texts have the empty
set and are copies of each other; repeated rows are exact copies; an empty table
gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopscope.llm import words
from hopscope.llm.components import components, free
from hopscope.llm.rows import keyed
from hopscope.operators.key_filter import keep_possible, possible
from hopscope.sources.staging import stage

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
BLOCK = 1024
BLOCK_BYTES = 8 << 20  # of shingles
BIN_BYTES = 16 << 20  # of small families verified together
_FEW_PAIRS = 32  # compared one by one, more as matrices
_SEED = 20240229


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = 128) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose bands reach the recall at the threshold within ``most`` hashes."""
    best = (most, 1)
    for rows in range(1, most + 1):
        miss = 1 - threshold**rows
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(miss))) if miss < 1 else most + 1
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def shingle_sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each row of a slice with a text."""
    hashes, offsets = words.hashed(batch.column("text"))
    grams = words.mix(words.windows(hashes, size))
    there = np.asarray(batch.column("text").is_valid())
    for i in np.flatnonzero(there):
        lo, hi = offsets[i], offsets[i + 1]
        if hi - lo >= size:
            yield i, np.unique(grams[lo : hi - size + 1])
        elif hi > lo:  # fewer words than a shingle: one shingle of all, told apart by their number
            yield i, words.mix(words.windows(hashes[lo:hi], int(hi - lo)) + np.uint64(hi - lo))
        else:
            yield i, np.zeros(0, np.uint64)


def _set_id(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _signatures(size: int, bands: int, rows: int):
    """Vertex id, number of shingles and band hashes of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(_SEED)
        factor = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
        shift = np.uint64(32)
        for batch in words.slices(batches, "text"):
            found = list(shingle_sets(batch, size))
            sets = [x for _, x in found]
            lens = np.fromiter(map(len, sets), np.int64, len(sets))
            full = np.flatnonzero(lens)
            minima = np.zeros((bands * rows, len(sets)), np.uint32)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                starts = np.concatenate([[0], np.cumsum(lens[full])[:-1]])
                for k in range(bands * rows):
                    minima[k, full] = np.minimum.reduceat(((flat * factor[k]) >> shift).astype(np.uint32), starts)
            minima = np.ascontiguousarray(minima.T).reshape(len(sets), bands, rows)
            band = np.zeros((len(sets), bands), np.uint64)
            for r in range(rows):
                band = words.mix(band * np.uint64(31) + minima[:, :, r] + np.uint64(r + 1))
            take = pa.array(np.array([i for i, _ in found], np.int64))
            flat_bands = pa.array(band.view(np.int64).ravel())
            at = pa.array(np.arange(0, len(sets) * bands + 1, bands, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(take) for c in ("key", "id", "h")),
                    pa.array([_set_id(x) for x in sets], pa.binary()),
                    pa.array(lens),
                    pa.ListArray.from_arrays(at, flat_bands),
                ],
                names=["key", "id", "h", "vertex", "n", "bands"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            found = [x.tobytes() for _, x in shingle_sets(batch, size)]
            yield pa.RecordBatch.from_arrays([batch.column("vertex"), pa.array(found, pa.binary())], names=["vertex", "shingles"])

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common shingles of each pair, exact; memory bounded by cutting the common universe."""
    # A block against itself is laid out once.
    every, first = (left, 0) if right is left else ([*left, *right], len(left))
    universe, place = np.unique(np.concatenate(every), return_inverse=True)
    out = np.zeros((len(left), len(right)), np.float64)
    rows = np.repeat(np.arange(len(every)), [len(x) for x in every])
    order = np.argsort(place, kind="stable")
    place, rows = place[order], rows[order]
    step = max(1, (8 << 20) // max(1, len(every)))
    for lo in range(0, len(universe), step):
        a, b = np.searchsorted(place, [lo, lo + step])
        part = np.zeros((len(every), min(step, len(universe) - lo)), np.float32)
        part[rows[a:b], place[a:b] - lo] = 1
        out += part[: len(left)] @ part[first:].T
    return out


def _good(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs reach the threshold."""
    if len(left) * len(right) <= _FEW_PAIRS:
        common = np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left], np.float64)
    else:
        common = overlaps(left, right)
    sizes = np.add.outer([float(len(x)) for x in left], [float(len(x)) for x in right])
    return common >= threshold * (sizes - common) - 1e-9


def roots(linked: np.ndarray) -> np.ndarray:
    """For each member of a symmetric matrix of links the first member it is connected to."""
    root = np.full(len(linked), -1)
    for first in range(len(linked)):
        if root[first] >= 0:
            continue
        there = np.zeros(len(linked), bool)
        there[first] = True
        edge = there
        while edge.any():
            edge = linked[edge].any(axis=0) & ~there
            there |= edge
        root[there] = first
    return root


def _families(table: pa.Table) -> Iterator[np.ndarray]:
    """Rows of each family of a group."""
    family = np.array(table.column("family").to_pylist(), object)
    order = np.array(sorted(range(len(family)), key=family.__getitem__), np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], family[order][1:] != family[order][:-1], [True]]))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        yield order[lo:hi]


def _set_columns(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles").combine_chunks()]


def _verify_blocks(threshold: float):
    """(vertex, root, rows, texts) of each member: links within its block."""

    def run(group: pa.Table) -> pa.Table:
        sets, ids = _set_columns(group), group.column("vertex").to_pylist()
        weights = np.asarray(group.column("copies"))
        root = np.arange(len(ids))
        rows, texts = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for at in _families(group):
            own = [sets[i] for i in at]
            good = _good(own, own, threshold)
            np.fill_diagonal(good, False)
            rows[at], texts[at] = good @ weights[at], good.sum(axis=1)
            root[at] = at[roots(good)]
        columns = [pa.array(ids, pa.binary()), pa.array([ids[i] for i in root], pa.binary()), pa.array(rows), pa.array(texts)]
        return pa.Table.from_arrays(columns, names=["vertex", "root", "rows", "texts"])

    return run


def cross_links(root: list, left: np.ndarray, right: np.ndarray, good: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges between roots of two blocks, one for each two sets of connected roots that a link joins first."""
    names = sorted({root[i] for i in [*left, *right]})
    place = {name: k for k, name in enumerate(names)}
    a, b = np.nonzero(good)
    of = np.array([place[r] for r in root])
    pairs = np.unique(np.stack([of[left[a]], of[right[b]]], axis=1), axis=0)
    top = list(range(len(names)))

    def find(i):
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for i, j in pairs.tolist():
        x, y = find(i), find(j)
        if x != y:
            top[y] = x
            yield names[i], names[j]


def _verify_pairs(threshold: float):
    """Of two blocks of one family: (vertex, null, rows, texts) sums, and (root, other root, 0, 0) edges."""

    def run(group: pa.Table) -> pa.Table:
        sets, ids, root = _set_columns(group), group.column("vertex").to_pylist(), group.column("root").to_pylist()
        weights, side = np.asarray(group.column("copies")), np.asarray(group.column("side"))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        out = []
        if len(left) and len(right):
            good = _good([sets[i] for i in left], [sets[i] for i in right], threshold)
            rows, texts = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            rows[left], rows[right] = good @ weights[right], good.T @ weights[left]
            texts[left], texts[right] = good.sum(axis=1), good.sum(axis=0)
            out = [(ids[i], None, int(rows[i]), int(texts[i])) for i in np.flatnonzero(texts)]
            out += [(a, b, 0, 0) for a, b in cross_links(root, left, right, good)]
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64())
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["vertex", "other", "rows", "texts"]
        )

    return run


def near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """(``key``, class_id, n_copies, n_links, n_linked_texts), one row for each row of ``docs``; see ``classes``."""
    return classes(docs, text, key, **options).drop("id", "h").withColumnRenamed("key", key)


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One document of each class, the one of the least key, with its own columns only."""
    classed, read = _classed(docs, text, key, **options)
    found = stage(classed.select("key", "id", "h", "class", "class_id"), "classes")
    for table in read:
        free(table)
    # A class is known by its vertex: keys may repeat, so its least key can be that of another class, too.
    # Rows without a text are not copies of anything, whatever their keys.
    several = found.filter("class is not null").groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("key").isNull(), "key", "id", "h")).alias("one")
    )
    several = stage(several.filter("n > 1").select("class", "one.id", "one.h"), "several")
    shared = found.join(several.select("class"), "class", "left_semi")
    # Only documents of such classes are in question; rows that repeat key and text can't be told apart.
    plain = F.max(F.col("class_id").isNull()).alias("plain")
    times = shared.groupBy("id", "h").agg(F.count(F.lit(1)).alias("n"), plain)
    chosen = several.select("id", "h", F.lit(True).alias("one"))
    asked = times.join(chosen, ["id", "h"], "left").select("id", "h", "n", (F.coalesce("one", F.lit(False)) | F.col("plain")).alias("stays"))
    asked = stage(asked, "asked")
    free(found)
    free(several)
    packed = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("doc"),
        F.coalesce(docs[f"`{key}`"].cast("string"), F.lit("\0")).alias("id"),
        F.xxhash64(docs[f"`{text}`"]).alias("h"),
    )
    # All other documents stay where they are: only those that may be asked for are shuffled with their texts.
    maybe = possible(asked, ["id", "h"], asked.count())
    rest = packed.filter(~maybe).select("doc")
    # One plan at every size: neither side is one to broadcast.
    met = packed.filter(maybe).join(asked.hint("merge"), ["id", "h"], "left").filter("stays is null or stays")
    out = rest.unionByName(met.filter("n is null or n = 1").select("doc"))
    twice = asked.filter("stays and n > 1").select("id", "h")
    if twice.isEmpty():
        return out.select("doc.*")
    repeated = packed.join(twice, ["id", "h"], "left_semi").groupBy("id", "h").agg(F.first("doc").alias("doc"))
    return out.unionByName(repeated.select("doc")).select("doc.*")


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """(key, id, h, class_id, n_copies, n_links, n_linked_texts), one row for each row of ``docs`` (``rows.keyed``).

    ``class_id``: least key of all rows that links and equal sets connect;
    ``n_copies``: other rows with an equal set; ``n_links``: other rows at or
    above the threshold, equal sets included; ``n_linked_texts``: other
    distinct sets among them.
    """
    return _classed(docs, text, key, **options)[0].drop("class")


def _classed(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    size: int = SHINGLE,
) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of ``classes`` with ``class``, the vertex a class is known by, and the staged tables they are read from.

    ``class`` is null for a null text, which is in none.
    """
    bands, rows = choose_bands(threshold, recall)
    texts = keyed(docs, text, key)
    kind = docs.schema[key].dataType.simpleString()
    signed = stage(
        texts.mapInArrow(
            _signatures(size, bands, rows), f"key {kind}, id string, h bigint, vertex binary, n bigint, bands array<bigint>"
        ),
        "signed",
    )
    vertices = stage(
        signed.groupBy("vertex").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("key").alias("least"),
            F.min(F.struct("id", "h")).alias("holder"),
            F.first("bands").alias("bands"),
            F.max("n").alias("n"),
        ),
        "vertices",
    )

    # One star per bucket: each member with the least member.
    slots = vertices.filter("n > 0").select("vertex", F.posexplode("bands").alias("band", "hash"))
    buckets = slots.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("m"), F.min("vertex").alias("hub")).filter("m > 1")
    stars = stage(
        slots.join(buckets.select("band", "hash", "hub"), ["band", "hash"])
        .filter(F.col("vertex") != F.col("hub"))
        .select(F.col("vertex").alias("a"), F.col("hub").alias("b"))
        .distinct(),
        "stars",
    )
    families = components(stars)  # vertex, component

    # Deal each family to blocks by hash, of so many members and bytes on average.
    own = families.join(vertices.select("vertex", "copies", "holder", "n"), "vertex").withColumnRenamed("component", "family")
    own = stage(own, "own")
    free(stars)
    free(families)
    sizes = own.groupBy("family").agg(F.count(F.lit(1)).alias("members"), F.sum(8 * F.col("n")).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    sizes = sizes.select("family", blocks.alias("blocks"), "bytes")
    dealt = own.join(sizes, "family").select(
        "vertex", "family", "blocks", F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int").alias("block"), "copies", "holder"
    )
    dealt = stage(dealt, "dealt")
    small = own.agg(F.sum(8 * F.col("n")).alias("bytes"), F.count(F.lit(1)).alias("members")).first()
    n_bins = max((small["bytes"] or 0) // BIN_BYTES, small["members"] // (4 * BLOCK)) + 1
    # The full set of a vertex comes from the text of one row that holds it; other texts stay behind the filter.
    holders = dealt.select("holder.id", "holder.h", "vertex")
    sets = keep_possible(texts, holders, ["id", "h"], small["members"]).join(holders, ["id", "h"]).select("vertex", "text")
    sets = stage(sets.mapInArrow(_sets(size), "vertex binary, shingles binary").dropDuplicates(["vertex"]), "sets")
    # Small families share groups, large ones have a group for each block.
    bins = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("family"), F.lit(n_bins))).otherwise(F.xxhash64("family", "block"))
    placed = dealt.join(sets, "vertex").select(bins.alias("bin"), F.col("blocks").alias("of"), "block", "family", "vertex", "copies", "shingles")
    inner = stage(
        placed.groupBy("of", "bin", "block").applyInArrow(_verify_blocks(threshold), "vertex binary, root binary, rows bigint, texts bigint"),
        "inner",
    )
    pair = lambda j: F.struct(F.least(F.col("block"), j).alias("i"), F.greatest(F.col("block"), j).alias("j"))
    others = F.transform(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: j != F.col("block")), pair)
    large = dealt.filter("blocks > 1").join(inner.select("vertex", "root"), "vertex").join(sets, "vertex")
    paired = large.select("*", F.explode(others).alias("pair")).select(
        "family", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), (F.col("block") != F.col("pair.i")).cast("int").alias("side"),
        "vertex", "root", "copies", "shingles",
    )
    across = stage(
        paired.groupBy("family", "i", "j").applyInArrow(_verify_pairs(threshold), "vertex binary, other binary, rows bigint, texts bigint"),
        "across",
    )
    free(sets)
    free(own)
    edges = across.filter("other is not null").select(F.col("vertex").alias("a"), F.col("other").alias("b"))
    joined = components(edges).select(F.col("vertex").alias("root"), "component")
    counts = inner.select("vertex", "rows", "texts").unionByName(across.filter("other is null").select("vertex", "rows", "texts"))
    counts = counts.groupBy("vertex").agg(F.sum("rows").alias("rows"), F.sum("texts").alias("texts"))
    classes = inner.select("vertex", "root").join(joined, "root", "left").select("vertex", F.coalesce("component", "root").alias("component"))
    classes = stage(classes.join(counts, "vertex").filter("texts > 0"), "classes")
    least = classes.join(vertices.select("vertex", "least"), "vertex").groupBy("component").agg(F.min("least").alias("class_id"))
    linked = stage(classes.join(least, "component").select("vertex", "component", "class_id", "rows", "texts"), "linked")
    for table in (dealt, inner, across, classes):
        free(table)
    known = vertices.join(linked, "vertex", "left").select(
        "vertex",
        F.coalesce("component", "vertex").alias("class"),
        F.coalesce("class_id", "least").alias("class_id"),
        (F.col("copies") - 1).alias("n_copies"),
        (F.coalesce("rows", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_linked_texts"),
    )
    out = signed.select("key", "id", "h", "vertex").join(known, "vertex").drop("vertex")
    none = texts.filter("text is null").select(
        "key", "id", "h", F.lit(None).cast("binary").alias("class"), F.col("key").alias("class_id"), *(F.lit(0).cast("long").alias(c) for c in ("n_copies", "n_links", "n_linked_texts"))
    )
    return out.unionByName(none), [signed, vertices, linked]

