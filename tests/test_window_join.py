"""The first-N interval join against brute force, on skewed data."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hopscope.operators.transactions import tx_by_actor
from hopscope.operators.window_join import cap_actions, first_n_join

MINUTE = 60_000_000
BASE = 1_704_067_200_000_000


def make(seed, n_tx, n_probes, step, window):
    """A third of all rows belongs to one address; times may coincide."""
    rng = random.Random(seed)
    actor = lambda: "0xhot" if rng.random() < 1 / 3 else f"0x{rng.randrange(12)}"
    tx = []
    for i in range(n_tx):
        us = BASE + rng.randrange(n_tx) * step
        a, b = actor(), actor()
        row = (rng.choice(["eth", "base"]), us, f"0xh{i}", a, b, rng.choice([None, i // 7]), rng.choice([None, i % 7]))
        tx += [row] * (1 if rng.random() < 0.9 else 3)
    # One transaction copied many times, and many at one instant.
    tx += [("eth", BASE + 5 * step, "0xcopy", "0xhot", "0x1", 1, 1)] * (n_tx // 3)
    tx += [("eth", BASE + 7 * step, f"0xtick{i}", "0xhot", "0x2", i % 5, None) for i in range(n_tx // 5)]
    probes = []
    for i in range(n_probes):
        us = BASE + rng.randrange(-n_tx // 10, n_tx) * step
        probes.append((i, "p", rng.choice(["eth", "base"]), actor(), us, us + rng.choice([window, window // 3, 0])))
    return tx, probes


def brute(tx, probes, n):
    null_last = lambda x: (x is None, x or 0)
    order = lambda t: (t[1], null_last(t[5]), null_last(t[6]), t[2])
    by_actor = defaultdict(dict)
    for t in sorted(tx, key=order):
        for a in {t[3], t[4]}:
            by_actor[t[0], a].setdefault(t[2], t)
    out = set()
    for pid, _, chain, a, w0, w1 in probes:
        hits = sorted((t for t in by_actor[chain, a].values() if w0 <= t[1] < w1), key=order)
        out |= {(pid, i + 1, t[2]) for i, t in enumerate(hits[: n or None])}
    return out


def frames(spark, tx, probes):
    t = spark.createDataFrame(
        tx,
        "chain string, us bigint, transaction_hash string, from_address string, to_address string, "
        "block_number bigint, transaction_index bigint",
    ).withColumn("block_timestamp", F.timestamp_micros("us")).drop("us")
    p = spark.createDataFrame(probes, "pid int, phase string, chain string, actor string, w0 bigint, w1 bigint")
    return t, p.withColumns({"w0": F.timestamp_micros("w0"), "w1": F.timestamp_micros("w1")})


def run(spark, tx, probes, n, slot_minutes=60):
    t, p = frames(spark, tx, probes)
    capped = cap_actions(first_n_join(p, tx_by_actor(t), n, slot_minutes), ["pid"], n)
    rows = [(r.pid, r.seq, r.transaction_hash) for r in capped.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("step", [1, 1_000, 1_000_000, 20_000_000])
@pytest.mark.parametrize("n", [1, 4, 50, 0])
def test_matches_brute_force(spark, step, n):
    tx, probes = make(step + n, 600, 120, step, 60 * MINUTE if step > 1000 else 300 * step)
    assert run(spark, tx, probes, n) == brute(tx, probes, n)


def test_does_not_depend_on_partitions_or_join_strategy(spark):
    tx, probes = make(99, 500, 100, 1_000_000, 60 * MINUTE)
    t, p = frames(spark, tx, probes)
    expected = brute(tx, probes, 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold, parts in (("-1", 1), ("-1", 37), ("10MB", 5)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            joined = first_n_join(p.repartition(parts), tx_by_actor(t.repartition(parts)), 5, 60)
            got = {(r.pid, r.seq, r.transaction_hash) for r in cap_actions(joined, ["pid"], 5).collect()}
            assert got == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_address_emits_few_candidates(spark):
    """2,000 probes and 20,000 transactions of one address in one hour: the
    window pairs number about 20 million, the candidates at most 2N per probe."""
    n = 5
    tx = [("eth", BASE + i * 180_000, f"0x{i:05d}", "0xhot", "0x1", i, 0) for i in range(20_000)]
    probes = [(i, "p", "eth", "0xhot", BASE + i * 1_700_000, BASE + i * 1_700_000 + 60 * MINUTE) for i in range(2_000)]
    t, p = frames(spark, tx, probes)
    candidates = first_n_join(p, tx_by_actor(t), n, 60)
    per_probe = candidates.groupBy("pid").count().agg(F.max("count"), F.sum("count")).first()
    assert per_probe[0] <= 2 * n
    got = {(r.pid, r.seq, r.transaction_hash) for r in cap_actions(candidates, ["pid"], n).collect()}
    assert got == brute(tx, probes, n)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_no_cross_join_or_python(spark):
    tx, probes = make(1, 50, 10, 1_000_000, 60 * MINUTE)
    t, p = frames(spark, tx, probes)
    for n in (5, 0):
        text = plan_of(cap_actions(first_n_join(p, tx_by_actor(t), n, 60), ["pid"], n))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "Python" not in text
    assert "WindowGroupLimit" in plan_of(cap_actions(first_n_join(p, tx_by_actor(t), 5, 60), ["pid"], 5))
