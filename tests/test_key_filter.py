"""The key filter at the scan, and the one shuffle that carries the payload of kept events."""

import random
import re

import pytest
from pyspark.sql import functions as F

import hopscope as hs
from hopscope.operators.events import capped_events_of
from hopscope.operators.key_filter import BITS_PER_KEY, LEAST_WORDS, MOST_WORDS, filter_words, keep_possible
from hopscope.plans.trace_plan import build_action_trace
from hopscope.sources.staging import stage

EVENTS = "chain string, transaction_hash string, log_index long, address string, event_hash string, event_signature string, topics string, args_json string, data string, block_timestamp timestamp"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_asked_key_is_lost(spark):
    rng = random.Random(6)
    keys = [("eth", f"0x{rng.getrandbits(64):x}") for _ in range(3000)] + [(None, "0x1"), ("eth", None)]
    others = [("eth", f"0y{i}") for i in range(20000)]
    rows = spark.createDataFrame(keys + others, "chain string, tx_hash string")
    kept = keep_possible(rows, spark.createDataFrame(keys, rows.schema), ["chain", "tx_hash"], 3000)
    got = {tuple(r) for r in kept.collect()}
    assert set(keys) <= got and len(got) - len(keys) < 0.03 * len(others)
    full = keep_possible(rows, spark.createDataFrame(keys, rows.schema), ["chain", "tx_hash"], 1)
    assert set(keys) <= {tuple(r) for r in full.collect()}
    assert keep_possible(rows, rows.limit(0), ["chain", "tx_hash"]).count() == 0


def test_the_filter_is_bounded():
    assert filter_words(0) == LEAST_WORDS and filter_words(10**12) == MOST_WORDS
    assert 64 * filter_words(10**6) >= BITS_PER_KEY * 10**6


def events_on_disk(spark, tmp_path):
    rows = [("eth", f"0x{i % 50}", i, "0xc", None, "Transfer(address,address,uint256)", "[]", '["0xa","0xb",1]', "0x", None) for i in range(2000)]
    spark.createDataFrame(rows, EVENTS).write.parquet(str(tmp_path / "events"))
    return spark.read.parquet(str(tmp_path / "events"))


def nodes_of(df):
    """(depth, text) of the nodes of the plan before it runs."""
    text = df._jdf.queryExecution().executedPlan().toString()
    nodes = re.split(r"\n(?=[ :]*[+:]- )", text)
    return [(re.match(r"[ :]*[+:]- |", n).end(), n) for n in nodes]


def exchanges_with(df, column):
    """What lies below each exchange of rows that come from a scan of ``column``."""
    nodes, out = nodes_of(df), []
    for i, (depth, text) in enumerate(nodes):
        if re.match(r"[ :]*[+:]- Exchange hashpartitioning", text):
            below = []
            for d, t in nodes[i + 1 :]:
                if d <= depth:
                    break
                below.append(t)
            if any("FileScan parquet" in t and column in t for t in below):
                out.append("\n".join(below))
    return out


def test_payload_crosses_one_exchange_behind_filter_and_cap(no_broadcast, tmp_path):
    spark = no_broadcast
    events = hs.normalize_events(events_on_disk(spark, tmp_path))
    asked = spark.createDataFrame([("eth", "0x1"), ("eth", "0x7")], "chain string, tx_hash string")
    kept = capped_events_of(events, asked, 3)
    carrying = exchanges_with(kept, "args_json")
    assert len(carrying) == 1
    assert "WindowGroupLimit" in carrying[0] and "shiftleft" in carrying[0] and "subquery" in carrying[0].lower()
    assert sorted((r.tx_hash, r.log_index, r.event_pos) for r in kept.collect()) == [
        (f"0x{k}", k + 50 * i, i + 1) for k in (1, 7) for i in range(3)
    ]


def test_the_filter_is_in_the_plans(no_broadcast, tmp_path):
    spark = no_broadcast
    events = events_on_disk(spark, tmp_path)
    asked = spark.createDataFrame([("eth", "0x1")], "chain string, tx_hash string")
    scanned = hs.scan_events(hs.normalize_events(events), asked)
    carrying = exchanges_with(scanned, "args_json")
    assert len(carrying) == 1 and "shiftleft" in carrying[0]
    assert scanned.count() == 40
    actions = '[{"ts":"2024-01-01T00:00:00+00:00","tx_hash":"0x1","chain":"eth","phase":"dst"}]'
    episodes = spark.createDataFrame([(0, actions)], "episode_row long, EPISODE_ACTIONS_JSON string")
    tx = spark.createDataFrame([("eth", "0x1", None)], "chain string, transaction_hash string, block_timestamp timestamp")
    trace = build_action_trace(episodes, tx, events.withColumn("block_timestamp", F.lit("2024-01-01 00:30:00").cast("timestamp")))
    first = min(exchanges_with(trace, "args_json"), key=len)
    assert "shiftleft" in first and "WindowGroupLimit" in first
    assert trace.select("n_events").first()[0] == 40


def test_the_filter_holds_the_hash_few_times(spark):
    """A filter computes an expression wherever it stands; nine times it took most of the time of the scan."""
    rows = spark.range(10).select(F.concat(F.lit("0x"), F.col("id").cast("string")).alias("tx_hash"))
    plan = keep_possible(rows, rows.filter("tx_hash > '0x5'"), ["tx_hash"], 10)._jdf.queryExecution().optimizedPlan().toString()
    (condition,) = [line for line in plan.split("\n") if "Filter" in line and "subquery" in line]
    assert 1 <= condition.count("xxhash64(") <= 3


def test_transactions_pass_the_filter_before_a_shuffle(no_broadcast, tmp_path):
    """Each of the three readings of the transactions cuts them at the scan."""
    spark = no_broadcast
    schema = "chain string, transaction_hash string, block_timestamp timestamp, from_address string, to_address string"
    at = "2024-01-01 00:30:00"
    rows = [("eth", f"0x{i}", "0xa" if i < 5 else f"0xb{i}", "0xc") for i in range(200)]
    made = spark.createDataFrame(rows, "chain string, transaction_hash string, from_address string, to_address string")
    made.select("chain", "transaction_hash", F.lit(at).cast("timestamp").alias("block_timestamp"), "from_address", "to_address").write.parquet(str(tmp_path / "tx"))
    tx = spark.read.schema(schema).parquet(str(tmp_path / "tx"))
    receipt = [(1, "0xa", "eth", "2024-01-01 00:00:00", "eth", "0x3"), (2, "0xnone", "eth", "2024-01-01 01:00:00", "eth", "0x7"), (3, None, "eth", None, None, None)]
    columns = "receipt_id long, DESTINATION_ADDRESS string, DESTINATION_CHAIN string, DESTINATION_TIMESTAMP string, SOURCE_CHAIN string, SOURCE_TX_HASH string"
    receipts = hs.canonical_receipts(spark.createDataFrame(receipt, columns))
    config = hs.EpisodeConfig(id_cols=("receipt_id",))
    windowed = hs.episode_probes(receipts, tx, config)
    senders = exchanges_with(windowed, "from_address")
    assert senders and all("shiftleft" in x for x in senders)
    probes = stage(windowed, "probes")
    actions = hs.episode_actions(probes, tx, config)
    assert all("shiftleft" in x for x in exchanges_with(actions, "to_address"))
    got = sorted((r.receipt_id, r.phase, r.transaction_hash) for r in actions.collect())
    # The sender of 0x3 is the receiver, whose five transactions follow; 0x7 was sent by another address in the hour before.
    assert got == [(1, "dst_post", f"0x{i}") for i in range(5)] + [(2, "src_pre", "0x7")]
    episodes = hs.build_episodes(receipts, tx, None, config)
    trace = build_action_trace(episodes, tx, None, hs.TraceConfig(id_cols=("receipt_id",)))
    assert "shiftleft" in min(exchanges_with(trace, "from_address"), key=len)
    assert sorted((r.tx_hash, r.from_address) for r in trace.collect()) == [(f"0x{i}", "0xa") for i in range(5)] + [("0x7", "0xb7")]
