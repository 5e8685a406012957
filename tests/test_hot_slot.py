"""Windows of a week on one busy address: ordered in parts, equal to brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hopscope.operators import window_join as wj

START = dt.datetime(2024, 1, 1)
WEEK = 7 * 24 * 60
TX = "chain string, actor string, side int, block_timestamp timestamp, transaction_hash string, block_number long, transaction_index long"


def frames(spark, times, starts, minutes):
    tx = [("eth", "0xhot", 0, START + dt.timedelta(seconds=s), f"0x{i:06d}", i, 0) for i, s in enumerate(times)]
    tx += [("eth", f"0xcold{i}", 0, START + dt.timedelta(hours=i), f"0xc{i}", i, 0) for i in range(5)]
    probes = [(i, "dst", "eth", "0xhot", START + dt.timedelta(seconds=s), START + dt.timedelta(seconds=s, minutes=minutes)) for i, s in enumerate(starts)]
    schema = "id long, phase string, chain string, actor string, w0 timestamp, w1 timestamp"
    return spark.createDataFrame(probes, schema).repartition(3), spark.createDataFrame(tx, TX).repartition(5)


def brute(times, starts, minutes, n):
    out = {}
    for i, s in enumerate(starts):
        met = sorted((t, k) for k, t in enumerate(times) if s <= t < s + 60 * minutes)
        out[i] = [f"0x{k:06d}" for _, k in (met if n <= 0 else met[:n])]
    return {i: v for i, v in out.items() if v}


@pytest.mark.parametrize("minutes, n", [(WEEK, 5), (WEEK, 50), (180, 3), (181, 1), (WEEK, 0), (1440, 4)])
def test_equal_to_brute_force(spark, minutes, n):
    rng = random.Random(minutes + n)
    span = 3 * 60 * minutes
    times = [rng.randrange(span) for _ in range(600)] + [rng.randrange(span // 50) + span // 3 for _ in range(900)]
    times += [span // 2] * 30 + [span // 2 + 3600 * k for k in range(5)]
    starts = [rng.randrange(span) for _ in range(80)] + [span // 2, span // 2 + 1, 0, span // 3]
    probes, tx = frames(spark, times, starts, minutes)
    rows = wj.cap_actions(wj.first_n_join(probes, tx, n, minutes), ["id"], n)
    got = {}
    for r in rows.orderBy("id", "seq").collect():
        got.setdefault(r.id, []).append(r.transaction_hash)
    assert got == brute(times, starts, minutes, n)


def test_a_week_on_one_address_runs_in_many_tasks(spark):
    rng = random.Random(1)
    times = [rng.randrange(7 * 86400) for _ in range(20000)]
    probes, tx = frames(spark, times, [0, 86400], WEEK)
    assert wj.slot_parts(WEEK) == 56 and wj.slot_parts(180) == 1 and wj.slot_parts(10**9) == wj.MOST_PARTS
    width = WEEK * 60_000_000
    near = wj._touched_slots(tx, probes, width)
    part = wj.integer_div(F.col("_us") - F.col("_slot") * width, -(-width // 56)).cast("int")
    sizes = near.groupBy("_slot", part.alias("p")).count().agg(F.max("count").alias("m"), F.count("*").alias("n")).first()
    assert sizes.n > 50 and sizes.m < 600
    # Every window over the transactions is dealt by the part as well.
    plan = wj._reach_by_parts(wj._without_copies(near.withColumn("_part", part).repartition(*wj._SLOT, "_part"), 56), 50, width)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line and "collect_list" not in line]
    assert windows and all("_part" in line for line in windows)


def test_parts_and_the_single_window_agree(spark):
    rng = random.Random(9)
    times = [rng.randrange(100000) for _ in range(2000)]
    probes, tx = frames(spark, times, [0, 500, 50000], 1440)
    width = 1440 * 60_000_000
    near = wj._touched_slots(tx, probes, width)
    part = wj.integer_div(F.col("_us") - F.col("_slot") * width, -(-width // 24)).cast("int")
    one = wj._reach(wj._without_copies(near, 1), 7, width)
    many = wj._reach_by_parts(wj._without_copies(near.withColumn("_part", part), 24), 7, width)
    key = lambda df: sorted((r.transaction_hash, r._us, r._reach) for r in df.collect())
    assert key(one) == key(many)
