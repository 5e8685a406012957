"""Runs of periodically repeated words, found with a dictionary of basic factors.

Factors are the stretches of ``L = 1, 2, 4, ...`` words. Level by level each
position gets the name of the factor that starts there: equal factors have equal
names, made from the pair of names of the two halves. A factor that occurs once in its slice
has no name and neither have the longer ones it begins or ends, so ordinary text
leaves the dictionary after a few levels.

At each level the successor of a position is the next occurrence of its factor.
Two equal steps in a row, from i to i + d to i + 2d with ``L <= d < 2L``, form an
arithmetic progression that proposes the period d; a third name equality closes
the gap between the factors, so d holds on all of ``[i, i + 2d + L)``. Every run
of at least four periods is proposed: a periodic word has more different factors
of L words than half its period, so one of them occurs once a period, and its
steps are exactly the period. Proposals of one d that touch are united, extended
word by word (fewer than d words at either end), and equal ones dropped.
A proposed period is the smallest of its run, since a smaller one would put an
occurrence before the successor.

Defined cases: a null text has no words, no runs and an empty collapsed text, as
have empty and blank ones; a text of any length is worked on whole, in memory
linear in its words (two levels are held at a time); repeated rows are done one
by one; an empty table gives an empty result. Runs are ordered by start, then
period, and overlapping runs of different periods are all listed. Extra columns
are carried as asked, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from hopscope.llm import words

SHORTEST = 6
PERIODS = 4
_STEPPED = 64  # periods up to this are extended together, longer ones each in blocks
RUNS = ArrayType(StructType().add("start", LongType()).add("length", LongType()).add("period", LongType()))


def _named(keys: np.ndarray, most: int) -> np.ndarray:
    """Names from 0 for keys that occur twice or more, -1 for the others; keys below 0 have none."""
    out = np.full(len(keys), -1, np.int32)
    at = np.flatnonzero(keys >= 0)
    if not len(at):
        return out
    key = keys[at]
    if most < 4 * len(keys):
        code = key
        n = most
    else:
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        code = np.empty(len(key), np.int64)
        code[order] = np.cumsum(new) - 1
        n = int(new.sum())
    often = np.bincount(code, minlength=n) > 1
    rename = np.where(often, np.cumsum(often) - 1, -1)
    out[at] = rename[code]
    return out


def _successors(names: np.ndarray) -> np.ndarray:
    """Distance to the next position of the same name, 0 where there is none."""
    out = np.zeros(len(names), np.int64)
    at = np.flatnonzero(names >= 0)
    order = at[np.argsort(names[at], kind="stable")]
    same = names[order][1:] == names[order][:-1]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def _united(start: np.ndarray, size: int, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, lo, hi): stretches on which each word equals the one a period later, from proposals ``[start, start + d + size)``."""
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    end = start + period + size
    # Within one period all proposals have the same length, so ends are sorted too.
    first = np.concatenate([[True], (period[1:] != period[:-1]) | (start[1:] > end[:-1])])
    at = np.flatnonzero(first)
    last = np.concatenate([at[1:], [len(start)]]) - 1
    return period[at], start[at], end[last]


def _extended(ids: np.ndarray, period: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The widest stretches around ``[lo, hi)`` on which words equal those a period later; ids below 0 equal nothing."""
    lo, hi = lo.copy(), hi.copy()
    go = np.flatnonzero(period <= _STEPPED)
    while len(go):
        go = go[lo[go] > 0]
        left = lo[go] - 1
        go = go[(ids[left] >= 0) & (ids[left] == ids[left + period[go]])]
        lo[go] -= 1
    go = np.flatnonzero(period <= _STEPPED)
    while len(go):
        go = go[hi[go] + period[go] < len(ids)]
        go = go[(ids[hi[go]] >= 0) & (ids[hi[go]] == ids[hi[go] + period[go]])]
        hi[go] += 1
    for k in np.flatnonzero(period > _STEPPED):
        d, reach = int(period[k]), True
        while reach and lo[k] > 0:
            a = max(0, lo[k] - d)
            block = ids[a : lo[k]]
            off = np.flatnonzero((block != ids[a + d : lo[k] + d]) | (block < 0))
            reach = not len(off)
            lo[k] = a if reach else a + off[-1] + 1
        reach = True
        while reach and hi[k] + d < len(ids):
            b = min(len(ids) - d, hi[k] + d)
            block = ids[hi[k] : b]
            off = np.flatnonzero((block != ids[hi[k] + d : b + d]) | (block < 0))
            reach = not len(off)
            hi[k] = b if reach else hi[k] + off[0]
    return lo, hi


def find(ids: np.ndarray, shortest: int = SHORTEST, periods: int = PERIODS) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of ids; an id below 0 equals nothing, so it parts texts.

    A run is a stretch with smallest period q and at least ``max(shortest, periods * q)``
    words that no neighbouring word extends; ``periods`` is 4 or more.
    """
    if periods < 4:
        raise ValueError("proposals are sure to meet runs of four periods or more")
    found = []
    names = _named(ids.astype(np.int64), int(ids.max(initial=-1)) + 1)
    size = 1
    while (names >= 0).any():
        step = _successors(names)
        i = np.flatnonzero((step >= size) & (step < 2 * size))
        d = step[i]
        # The third term exists, as i + d has a successor where its step is d.
        next_to = step[i + d] == d
        i, d = i[next_to], d[next_to]
        gap = i + d - size
        closed = (names[gap] >= 0) & (names[gap] == names[gap + d])
        i, d = i[closed], d[closed]
        if len(i):
            d, lo, hi = _united(i, size, d)
            lo, hi = _extended(ids, d, lo, hi)
            length = hi + d - lo
            good = length >= np.maximum(shortest, periods * d)
            found.append(np.stack([lo[good], length[good], d[good]], axis=1))
        # Names of the factors twice as long; a half without a name leaves none.
        both = np.full(len(names), -1, np.int64)
        n = len(names) - size
        if n > 0:
            most = int(names.max()) + 1
            whole = (names[:n] >= 0) & (names[size:] >= 0)
            both[:n][whole] = names[:n][whole].astype(np.int64) * most + names[size:][whole]
            names = _named(both, most * most)
        else:
            names = np.full(0, -1, np.int32)
        size *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    return np.unique(np.concatenate(found), axis=0)


def _in_order(runs: np.ndarray) -> np.ndarray:
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of_slice(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(runs with starts in their text, offsets of each text's runs, numbers of words, collapsed texts)."""
    found, offsets = words.split(texts)
    counts = np.diff(offsets)
    # A place between two texts equals nothing, so no run crosses it.
    place = np.arange(len(found)) + np.repeat(np.arange(len(counts)), counts)
    ids = np.full(len(found) + len(counts), -1, np.int64)
    index = np.asarray(found.indices).astype(np.int64) if len(found) else np.zeros(0, np.int64)
    ids[place] = index
    runs = _in_order(find(ids))
    begins = offsets[:-1] + np.arange(len(counts))
    owner = np.searchsorted(begins, runs[:, 0], side="right") - 1
    # Words after the first period of any run go.
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = (np.cumsum(change)[:-1] == 0)[place]
    runs[:, 0] -= begins[owner]
    upto = np.concatenate([[0], np.bincount(owner, minlength=len(counts)).cumsum()]) if len(runs) else np.zeros(len(counts) + 1, np.int64)
    kept_upto = np.concatenate([[0], np.cumsum(kept)])[offsets]
    if len(found):
        left = found.dictionary.take(pa.array(index[kept])).cast(pa.string())
        collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept_upto, pa.int32()), left), " ")
    else:
        collapsed = pa.array([""] * len(counts), pa.string())
    return runs, upto, counts, collapsed


def find_runs(docs: DataFrame, text: str | Column = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns with ``n_words``, ``runs`` (start, length, period) and ``collapsed``.

    ``collapsed`` holds the words, joined by one space, without those a run
    repeats: all of its words after the first period.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c not in ("n_words", "runs", "collapsed")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            runs, upto, counts, collapsed = runs_of_slice(batch.column("text"))
            fields = [pa.array(np.ascontiguousarray(runs[:, k])) for k in range(3)]
            rows = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), rows)
            columns = [batch.column("row"), pa.array(counts), lists, collapsed]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_words", "runs", "collapsed"])

    # The carried columns travel in a struct, so they may have any name.
    source = text if isinstance(text, Column) else docs[f"`{text}`"]
    packed = docs.select(
        F.struct(F.lit(1).alias("none"), *(docs[f"`{c}`"] for c in names)).alias("row"), source.alias("text")
    )
    schema = StructType([*packed.select("row").schema.fields]).add("n_words", "long").add("runs", RUNS).add("collapsed", "string")
    made = packed.mapInArrow(run, schema)
    return made.select(*(F.col("row")[c].alias(c) for c in names), "n_words", "runs", "collapsed")


def longest(runs: Column) -> Column:
    """The run of greatest length; ties: smallest start, then period. Null where there is none."""
    ranked = F.array_max(
        F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    return F.when(
        F.size(runs) > 0,
        F.struct((-ranked["start"]).alias("start"), ranked["length"].alias("length"), (-ranked["period"]).alias("period")),
    )
