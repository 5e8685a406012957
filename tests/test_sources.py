"""Files, schema drift, time index, profile and sinks on a small folder tree."""

import datetime as dt
import json
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

import hopscope as hs
from hopscope.functions import to_utc_ts
from hopscope.operators.transactions import prune_to_span
from hopscope.sources.columns import detect_receipt_columns
from hopscope.sources.files import chain_files
from hopscope.sources.tables import touched_chains
from hopscope.sources.time_index import index_errors, indexed_files

R, S = "0x" + "a" * 40, "0x" + "b" * 40


def write(path, data, **options):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(data), path, **options)


def day(d, h=0):
    return dt.datetime(2024, 1, d, h)


def utc(text):
    return to_utc_ts(F.lit(text), T.StringType())


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    for d in (1, 2, 3):
        write(
            f"{root}/eth/transactions/2024-01-0{d}.parquet",
            {
                "block_timestamp": pa.array([day(d, 1), day(d, 12)], pa.timestamp("us")),
                "transaction_hash": [f"0xE{d}a", f"0xE{d}b"], "from_address": [R, S], "to_address": [S, R],
                "value": [d, 10 * d], "input": ["0xa9059cbb00", "0x"], "block_number": [d, d], "transaction_index": [0, 1],
            },
        )
    # Another chain: other column order, text values, one column less and one more.
    write(
        f"{root}/base/transactions/part/x.parquet",
        {"transaction_hash": ["0xB1"], "block_timestamp": pa.array([day(1, 11)], pa.timestamp("us")), "value": ["7"],
         "from_address": [S.upper().replace("0X", "0x")], "to_address": [None], "gas": [1]},
    )
    write(f"{root}/eth/decoded_events/e.parquet", {
        "block_timestamp": pa.array([day(1, 12)], pa.timestamp("us")), "transaction_hash": ["0xe1b"], "log_index": [0],
        "address": ["0xT"], "event_signature": ["Transfer(a,b,c)"], "args_json": [f'["{S}","{R}",3]']})
    times = pa.array([day(1, 12), day(2, 0)], pa.timestamp("us"))
    write(f"{root}/receipts/arbitrum/2024-01-01_arbitrum.parquet", {
        "DESTINATION_ADDRESS": [R, R], "DESTINATION_CHAIN": ["1", "ethereum"], "DESTINATION_TIMESTAMP": times,
        "SOURCE_CHAIN": ["base", "base"], "SOURCE_TX_HASH": ["0xb1", None]})
    write(f"{root}/receipts/base/2024-01-01_base.parquet", {
        "receiver": [R], "to_chain": [1], "timestamp": ["2024-01-01T12:00:00Z"], "DESTINATION_CHAIN_NOTE": [5]})
    write(f"{root}/receipts/base/2024-01-02_base.parquet", {"note": ["no roles here"]})
    return root


def test_receipts_are_detected_per_schema(spark, lake):
    df = hs.read_receipts(spark, f"{lake}/receipts")
    rows = sorted(df.collect(), key=lambda r: (r._file, r._idx))
    assert [(os.path.basename(r._file), r._idx) for r in rows] == [
        ("2024-01-01_arbitrum.parquet", 0), ("2024-01-01_arbitrum.parquet", 1), ("2024-01-01_base.parquet", 0),
        ("2024-01-02_base.parquet", 0)]
    assert [r._chain for r in rows] == ["eth", "eth", "eth", None]
    assert [r._recv for r in rows] == [R, R, R, None]
    assert rows[2]._ts == rows[0]._ts and rows[0]._src_tx_hash == "0xb1" and rows[3].note == "no roles here"
    assert touched_chains(df) == ["base", "eth"]
    assert hs.read_receipts(spark, f"{lake}/receipts", limit_files=1).count() == 2
    assert hs.read_receipts(spark, f"{lake}/receipts", limit_rows=1).count() == 3
    with pytest.raises(FileNotFoundError):
        hs.read_receipts(spark, f"{lake}/nothing")


def test_transactions_with_drift(spark, lake):
    tx = hs.read_transactions(spark, lake, ["eth", "base", "absent"])
    rows = {r.transaction_hash: r for r in hs.normalize_transactions(tx).collect()}
    assert len(rows) == 7 and rows["0xb1"].from_address == S and rows["0xb1"].block_number is None
    assert rows["0xe3b"].value == "30" and rows["0xe1a"].method_id == "0xa9059cbb" and rows["0xe1b"].method_id is None
    with pytest.raises(FileNotFoundError):
        hs.read_transactions(spark, lake, ["absent"], strict=True)
    assert hs.read_transactions(spark, lake, ["absent"]).count() == 0
    assert hs.read_decoded_events(spark, lake, ["base"]) is None


def test_time_range_reaches_the_scan(spark, lake):
    span = spark.range(1).select(utc("2024-01-02 00:00:00").alias("lo"), utc("2024-01-03 00:00:00").alias("hi"))
    df = prune_to_span(hs.read_transactions(spark, lake, ["eth"]), "block_timestamp", span)
    assert df.count() == 2
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("scalar-subquery" in s.lower() or "subquery" in s.lower() for s in scans)


def test_files_to_episodes_to_trace(spark, lake, tmp_path):
    receipts = hs.read_receipts(spark, f"{lake}/receipts")
    tx = hs.read_transactions(spark, lake, touched_chains(receipts))
    events = hs.read_decoded_events(spark, lake, ["eth", "base"])
    episodes = hs.build_episodes(receipts, tx, events)
    out = str(tmp_path / "episodes")
    hs.write_episodes(episodes, out)
    stored = spark.read.parquet(out)
    assert stored.count() == 4 and "_recv" not in stored.columns
    assert os.path.isdir(f"{out}/chain=eth/date=2024-01-01")
    by_time = {(r.DESTINATION_CHAIN, r.receiver): r for r in stored.collect()}
    first = by_time["1", None]
    assert [json.loads(first.EPISODE_ACTIONS_JSON)[i]["tx_hash"] for i in range(2)] == ["0xb1", "0xe1b"]
    assert json.loads(first.EPISODE_ACTIONS_JSON)[1]["events"][0]["amount"] == 3
    assert by_time["ethereum", None].EPISODE_FIRST_TX_HASH == "0xe2a"
    assert by_time[None, R].EPISODE_FIRST_TX_HASH == "0xe1b" and by_time[None, None].EPISODE_TX_COUNT == 0

    again = hs.read_episodes(spark, out, ["EPISODE_ACTIONS_JSON", "DESTINATION_ADDRESS", "absent"])
    config = hs.TraceConfig(id_cols=("episode_file", "episode_row"), focus_addr_cols=("DESTINATION_ADDRESS",))
    trace = hs.build_action_trace(again, tx, events, config)
    hs.write_action_trace(trace, str(tmp_path / "trace"))
    rows = spark.read.parquet(str(tmp_path / "trace")).filter("tx_hash = '0xe1b'").collect()
    assert len(rows) == 2 and all(r.n_events == 1 for r in rows)
    deltas = [json.loads(r.transfer_delta_json) for r in rows]
    assert {S: {"0xt": -3, "native": -10}, R: {"0xt": 3, "native": 10}} in deltas


def test_time_index(spark, lake, tmp_path):
    base = str(tmp_path / "chains")
    for d in (1, 2, 3):
        os.makedirs(f"{base}/eth/transactions", exist_ok=True)
        pq.write_table(pq.read_table(f"{lake}/eth/transactions/2024-01-0{d}.parquet"),
                       f"{base}/eth/transactions/{d}.parquet", write_statistics=d != 2)
    write(f"{base}/eth/transactions/empty.parquet", {"block_timestamp": pa.array([], pa.timestamp("us"))})
    write(f"{base}/eth/logs/l.parquet", {"other": [1]})
    with open(f"{base}/eth/transactions/broken.parquet", "wb") as f:
        f.write(b"PAR1 not parquet")
    index = hs.build_time_index(spark, base, ["eth", "absent"])
    good = indexed_files(index.filter("dataset = 'transactions'")).collect()
    assert [(r.rel_file, r.min_ts, r.max_ts, r.method) for r in good] == [
        (f"eth/transactions/{d}.parquet", f"2024-01-0{d}T01:00:00+00:00", f"2024-01-0{d}T12:00:00+00:00",
         "read_column" if d == 2 else "metadata") for d in (1, 2, 3)]
    assert sorted(r.rel_file for r in index_errors(index).collect()) == [
        "eth/logs/l.parquet", "eth/transactions/broken.parquet", "eth/transactions/empty.parquet"]
    summary = {r.dataset: (r.n_files, r.n_indexed, r.n_errors) for r in hs.time_index_summary(index).collect()}
    assert summary == {"transactions": (5, 3, 2), "logs": (1, 0, 1)}

    def hit(start, end):
        rows = hs.select_files(index, utc(start), utc(end)).collect()
        return sorted(os.path.basename(r.file) for r in rows)

    assert hit("2024-01-01 12:00:00", "2024-01-02 01:00:00") == ["1.parquet"]  # end of 1 touches, start of 2 does not
    assert hit("2024-01-01 12:00:01", "2024-01-02 01:00:01") == ["2.parquet"]
    assert hit("bad", "2024-01-02 01:00:01") == []

    hs.write_time_index(index, str(tmp_path / "index"))
    stored = hs.read_time_index(spark, str(tmp_path / "index"))
    readable = stored.filter("error is null")
    rows = hs.read_for_range(spark, readable, base, "eth", utc("2024-01-02 00:00:00"), utc("2024-01-03 00:00:00"))
    assert sorted(r.transaction_hash for r in rows.collect()) == ["0xE2a", "0xE2b"]
    far = (utc("2025-01-01 00:00:00"), utc("2025-01-02 00:00:00"))
    with pytest.raises(FileNotFoundError):
        hs.read_for_range(spark, readable, base, "eth", *far, strict=True)
    with pytest.raises(FileNotFoundError):
        hs.read_for_range(spark, None, base, "eth", *far, strict=True)
    assert hs.read_time_index(spark, str(tmp_path / "none")) is None
    whole = hs.read_for_range(spark, None, lake, "eth", *far)
    assert whole.count() == 6


def test_time_index_from_json(spark, tmp_path):
    path = str(tmp_path / "eth_transactions_time_index.json")
    with open(path, "w") as f:
        json.dump({"n_files": 2, "files": [{"file": "/a", "chain": "eth", "dataset": "transactions", "method": "metadata",
                   "min_ts": "2024-01-01T00:00:00+00:00", "max_ts": "2024-01-02T00:00:00+00:00"}],
                   "errors": [{"file": "/b", "chain": "eth", "dataset": "transactions", "error": "bad"}]}, f, indent=2)
    index = hs.read_time_index(spark, path)
    assert {(r.file, r.error) for r in index.collect()} == {("/a", None), ("/b", "bad")}
    assert hs.select_files(index, utc("2024-01-02"), utc("2024-01-03")).count() == 1


def test_schema_profile(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/eth/transactions/1.parquet", {"a": [1], "b": [1]})
    write(f"{root}/eth/transactions/2.parquet", {"a": [1], "b": [1]})
    write(f"{root}/eth/transactions/3.parquet", {"b": [1], "a": [1]})
    write(f"{root}/eth/transactions/4.parquet", {"a": [1], "b": [1], "c": [1]})
    write(f"{root}/base/transactions/1.parquet", {"a": [1]})
    with open(f"{root}/eth/transactions/5.parquet", "wb") as f:
        f.write(b"junk")
    files = chain_files(spark, root, ["eth", "base", "none"], "transactions", recursive=False)
    columns = hs.file_columns(files)
    presence = [tuple(r) for r in hs.schema_column_presence(columns).filter("chain = 'eth'").collect()]
    assert presence == [("eth", "a", 4, 0.8), ("eth", "b", 4, 0.8), ("eth", "c", 1, 0.2)]
    groups = [(r["count"], os.path.basename(r.example_file), r.num_cols, r.first_25_cols)
              for r in hs.schema_groups(columns).filter("chain = 'eth'").orderBy("rank").collect()]
    assert groups == [(2, "1.parquet", 2, ["a", "b"]), (1, "3.parquet", 2, ["b", "a"]), (1, "4.parquet", 3, ["a", "b", "c"])]
    assert [tuple(r) for r in hs.schema_global_union(columns).collect()] == [("a", 5), ("b", 4), ("c", 1)]
    summary = {r.chain: (r.files_inspected, r.unique_schemas, r.num_columns, r.error)
               for r in hs.schema_summary(columns, ["eth", "base", "none"]).collect()}
    assert summary == {"eth": (5, 3, 3, None), "base": (1, 1, 1, None), "none": (None, None, None, "no parquet files")}
    assert chain_files(spark, root, ["eth"], "transactions", max_files=2).count() == 2


def test_column_detection():
    cols = detect_receipt_columns
    assert cols(["token", "dst chain", "TIME"])[:3] == ("token", "dst chain", "TIME")
    assert cols(["recipient", "Destination-Address", "src_chain", "ts"])[:3] == ("Destination-Address", None, None)
    assert cols(["to", "source chain", "block_timestamp"]).chain == "source chain"
    assert cols(["A B", "a_b", "dest_address", "Dest Address"]).recv == "Dest Address"
    assert cols(["x", "tx_hash", "sender"])[3:] == ("tx_hash", None, "sender", "tx_hash")
    assert not cols(["x"]).complete
    assert cols(["x", "y", "z"], recv="x", chain="y", ts="z").complete


def test_union_promoting_and_projection(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    b = spark.createDataFrame([(1, 5.5, "q")], "k int, v double, w string")
    c = spark.createDataFrame([("t",)], "v string")
    assert sorted(map(str, hs.union_promoting([a, b]).collect())) == [
        "Row(k=1, v=2.0, w=None)", "Row(k=1, v=5.5, w='q')"]
    assert {r.v for r in hs.union_promoting([a, b, c]).collect()} == {"2", "5.5", "t"}
    assert hs.project_tolerant(a, {"v": "string", "z": "bigint"}).first() == ("2", None)
