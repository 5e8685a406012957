"""First-N interval join: for every probe the first N transactions of its
actor inside a half-open time window.

The plain join (same chain and actor, ``start <= ts < end``) pairs every probe
with every transaction in its window before the cap throws nearly all of them
away; for a busy router address that is quadratic. Three steps keep the work in
proportion to the result instead:

1. **Reach.** Inside one time slot the transactions of an actor are ordered
   once. A transaction can be among the first N of a probe only if the one N
   places before it lies before the probe's start, so each transaction serves
   just the starts in ``(reach, ts]`` where ``reach`` is that earlier time.
   At any instant at most N transactions per slot have it in reach.
2. **Levels.** The length of that range picks a bucket width: long for quiet
   actors, short for busy ones. A range covers at most two buckets of its
   level and a probe looks into one bucket per level, so an equality join on
   (chain, actor, level, bucket) finds each pair exactly once and meets only a
   constant multiple of N candidates per probe.
3. **Cap.** A window touches at most two slots, so at most 2N rows per probe
   remain for the exact cap.

A hot address spreads over its time slots. If one slot of one address is hot as
well, the semi join that thins the transactions is a left-semi join AQE may
split, identical timestamps are cut to N before they are shuffled, and copies
of one transaction collapse to one.

A slot is as long as the longest window. Slots over three hours are ordered in parts
of at most three hours (or a 256th): each part is ranked by itself, and a small table
carries the last N times before a part to the transactions at its beginning. So
the rows ordered together don't grow with the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import integer_div
from .key_filter import keep_possible
from .transactions import tx_order

SLOT_PART_MINUTES = 180
MOST_PARTS = 256
LEVELS = 5
FANOUT = 16
_SLOT = ("chain", "actor", "_slot")
PROBE_COLUMNS = ("phase", "chain", "actor", "w0", "w1")


def window_span(probes: DataFrame, start: str = "w0", end: str = "w1") -> DataFrame:
    """One row ``(lo, hi)``: earliest start and latest end of all windows."""
    return probes.agg(F.min(start).alias("lo"), F.max(end).alias("hi"))


def first_n_join(
    probes: DataFrame, by_actor: DataFrame, n: int, slot_minutes: int, expected: int | None = None
) -> DataFrame:
    """Pairs that can survive a cap of ``n`` per probe; exact after the cap.

    ``probes`` carries PROBE_COLUMNS next to its own id columns, ``by_actor``
    comes from ``tx_by_actor``; ``slot_minutes`` is at least the longest window.
    For stored probes, ``expected`` slots that they touch size a filter that drops
    the other transactions before they are shuffled.
    """
    probes = probes.filter((F.col("w0") < F.col("w1")) & F.col("chain").isNotNull() & F.col("actor").isNotNull())
    width = slot_minutes * 60_000_000
    parts = slot_parts(slot_minutes)
    near = _touched_slots(by_actor, probes, width, expected)
    if parts > 1:
        part = integer_div(F.col("_us") - F.col("_slot") * width, -(-width // parts)).cast("int")
        near = near.withColumn("_part", part).repartition(*_SLOT, "_part")
    near = _without_copies(near, parts)
    if n <= 0:
        return _all_pairs(probes, near.drop("_part"), width)
    reached = _reach(near, n, width) if parts == 1 else _reach_by_parts(near, n, width)
    return _meet(probes, reached, width)


def slot_parts(slot_minutes: int) -> int:
    """In how many parts a slot is ordered."""
    return min(MOST_PARTS, max(1, -(-slot_minutes // SLOT_PART_MINUTES)))


def _slots(start: str, end: str, width: int) -> Column:
    first, last = integer_div(F.unix_micros(start), width), integer_div(F.unix_micros(end) - 1, width)
    return F.explode(F.sequence(first, last))


def _touched_slots(by_actor: DataFrame, probes: DataFrame, width: int, expected: int | None = None) -> DataFrame:
    """Transactions in a slot that some window of their actor touches."""
    slots = probes.select("chain", "actor", _slots("w0", "w1", width).alias("_slot"))
    timed = by_actor.withColumn("_us", F.unix_micros("block_timestamp")).withColumn(
        "_slot", integer_div(F.col("_us"), width)
    )
    if expected is not None:
        timed = keep_possible(timed, slots, list(_SLOT), expected)
    return timed.join(slots.distinct(), list(_SLOT), "left_semi")


def _without_copies(tx: DataFrame, parts: int) -> DataFrame:
    own = _SLOT if parts == 1 else (*_SLOT, "_part")
    copies = Window.partitionBy(*own, "_us", "transaction_hash").orderBy("side", *tx_order())
    return tx.withColumn("_copy", F.row_number().over(copies)).filter("_copy = 1").drop("_copy")


def _all_pairs(probes: DataFrame, tx: DataFrame, width: int) -> DataFrame:
    """Every pair inside a window: the result itself when there is no cap."""
    left = probes.withColumn("_slot", _slots("w0", "w1", width))
    ts = F.col("block_timestamp")
    return (
        left.join(tx, ["chain", "actor", "_slot"])
        .filter((ts >= F.col("w0")) & (ts < F.col("w1")))
        .drop("_slot", "_us")
    )


def _reach(tx: DataFrame, n: int, width: int) -> DataFrame:
    """Add ``_reach`` and drop what no start can reach."""
    key = ["chain", "actor", "_slot"]
    same_time = Window.partitionBy(*key, "_us").orderBy(*tx_order())
    in_slot = Window.partitionBy(*key).orderBy("_us", *tx_order())
    return (
        tx.withColumn("_tick", F.row_number().over(same_time))
        .filter(F.col("_tick") <= n)
        .withColumn("_reach", F.greatest(F.lag("_us", n).over(in_slot), F.col("_us") - width))
        .filter("_reach < _us")
        .drop("_tick", "_slot")
    )


def _reach_by_parts(tx: DataFrame, n: int, width: int) -> DataFrame:
    """``_reach`` with no more than a part of a slot ordered together."""
    key = [*_SLOT, "_part"]
    in_part = Window.partitionBy(*key)
    ordered = in_part.orderBy("_us", *tx_order())
    same_time = Window.partitionBy(*key, "_us").orderBy(*tx_order())
    ranked = (
        tx.withColumn("_tick", F.row_number().over(same_time))
        .filter(F.col("_tick") <= n)
        .withColumns({"_rank": F.row_number().over(ordered), "_near": F.lag("_us", n).over(ordered), "_size": F.count("*").over(in_part)})
    )
    # The last n times of each part, at most n of all parts before it.
    last = ranked.filter(F.col("_size") - F.col("_rank") < n).groupBy(*key).agg(F.array_sort(F.collect_list("_us")).alias("_last"))
    before = Window.partitionBy(*_SLOT).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    gathered = last.select(*key, F.flatten(F.collect_list("_last").over(before)).alias("_before"))
    carried = gathered.select(*key, F.slice("_before", F.greatest(F.lit(1), F.size("_before") - n + 1), n).alias("_before"))
    earlier = F.get(F.col("_before"), F.size("_before") - (n + 1 - F.col("_rank")))
    return (
        ranked.join(carried, key, "left")
        .withColumn("_reach", F.greatest(F.when(F.col("_rank") > n, F.col("_near")).otherwise(earlier), F.col("_us") - width))
        .filter("_reach < _us")
        .drop("_tick", "_slot", "_part", "_rank", "_near", "_size", "_before")
    )


def _level_widths(width: int) -> list[int]:
    return [max(1, -(-width // FANOUT**i)) for i in range(LEVELS)]


def _meet(probes: DataFrame, tx: DataFrame, width: int) -> DataFrame:
    widths = _level_widths(width)
    length = F.col("_us") - F.col("_reach")
    level = F.lit(0)
    for i, w in enumerate(widths[1:], start=1):
        level = F.when(length <= w, F.lit(i)).otherwise(level)
    own_width = F.element_at(F.array(*[F.lit(w).cast("long") for w in widths]), F.col("_level") + 1)
    covered = F.sequence(integer_div(F.col("_reach") + 1, F.col("_w")), integer_div(F.col("_us"), F.col("_w")))
    right = (
        tx.withColumn("_level", level)
        .withColumn("_w", own_width)
        .withColumn("_bucket", F.explode(covered))
        .drop("_w")
    )

    looks = [F.struct(F.lit(i).alias("_level"), integer_div(F.col("_w0"), w).alias("_bucket")) for i, w in enumerate(widths)]
    left = probes.withColumns({"_w0": F.unix_micros("w0"), "_w1": F.unix_micros("w1")}).select(
        "*", F.inline(F.array(*looks))
    )
    return (
        left.join(right, ["chain", "actor", "_level", "_bucket"])
        .filter((F.col("_reach") < F.col("_w0")) & (F.col("_w0") <= F.col("_us")) & (F.col("_us") < F.col("_w1")))
        .drop("_level", "_bucket", "_reach", "_us", "_w0", "_w1")
    )


def cap_actions(pairs: DataFrame, id_cols: Sequence[str], n: int) -> DataFrame:
    """One row per hash, numbered by ``seq``; the first ``n`` per id and phase.

    One shuffle by id serves both windows here and the grouping that follows.
    """
    who = [*id_cols, "phase"]
    repeat = Window.partitionBy(*who, "transaction_hash").orderBy(*tx_order(), "side")
    order = Window.partitionBy(*who).orderBy(*tx_order())
    numbered = (
        pairs.repartition(*id_cols)
        .withColumn("_repeat", F.row_number().over(repeat))
        .filter("_repeat = 1")
        .withColumn("seq", F.row_number().over(order))
        .drop("_repeat")
    )
    return numbered.filter(F.col("seq") <= n) if n > 0 else numbered
