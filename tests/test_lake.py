"""The stored lake: typed values, instants, index rows and file pruning."""

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import hopscope as hs
from hopscope import fixtures as fx
from hopscope.sources.staging import stage

SF = "/root/testdata/sf0.001"


def write(path, columns, **options):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path, **options)


def times(*texts, zone=None):
    return pa.array([None if t is None else __import__("datetime").datetime.fromisoformat(t) for t in texts], pa.timestamp("us", zone))


def tx(**more):
    base = {"transaction_hash": ["0xA"], "from_address": ["0x1"], "to_address": ["0x2"], "block_timestamp": times("2024-01-01 12:00:00", zone="UTC")}
    return base | more


def test_values_and_times_of_several_chains(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/eth/transactions/1.parquet", tx(value=[5.0]))
    write(f"{root}/arbitrum/transactions/1.parquet", tx(value=pa.array([__import__("decimal").Decimal("7.90")], pa.decimal128(20, 2)), block_timestamp=times("2024-01-01 12:00:00")))
    write(f"{root}/optimism/transactions/1.parquet", tx(value=["9"]))
    write(f"{root}/base/transactions/1.parquet", tx(value=[11]))
    chains = ["eth", "arbitrum", "optimism", "base"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    for session_zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        try:
            read = hs.read_transactions(spark, root, chains)
            assert dict(read.dtypes)["block_timestamp"] == "timestamp"
            rows = hs.normalize_transactions(read).select("chain", "value", F.unix_timestamp("block_timestamp").alias("s")).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
        assert {r.chain: (r.value, r.s) for r in rows} == {c: (v, 1704110400) for c, v in zip(chains, ["5", "7", "9", "11"])}


def test_missing_keys_raise(spark):
    whole = spark.createDataFrame([("eth", "0xa", "x")], "chain string, transaction_hash string, block_timestamp string")
    for lost in whole.columns:
        with pytest.raises(ValueError, match="no column"):
            hs.normalize_transactions(whole.drop(lost))
    with pytest.raises(ValueError, match="no column chain"):
        hs.normalize_events(whole.drop("chain"))


def test_index_of_nested_and_unmeasured_files(spark, tmp_path):
    root = str(tmp_path / "logs" / "eth" / "lake")
    nested = pa.array([{"a": 1, "b": 2}], pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    write(f"{root}/eth/transactions/1.parquet", {"info": nested, "block_timestamp": times("2024-05-01 00:00:00")})
    with_nulls = {"block_timestamp": times(None, "2024-06-01 00:00:00")}
    write(f"{root}/eth/transactions/2.parquet", with_nulls, row_group_size=1)
    write(f"{root}/eth/transactions/3.parquet", {"block_timestamp": times("2024-07-01 00:00:00")}, write_statistics=False)
    rows = {r.rel_file: r for r in hs.build_time_index(spark, root, ["eth"]).collect()}
    assert {k: (r.chain, r.dataset, r.min_ts, r.method) for k, r in rows.items()} == {
        "eth/transactions/1.parquet": ("eth", "transactions", "2024-05-01T00:00:00+00:00", "metadata"),
        "eth/transactions/2.parquet": ("eth", "transactions", "2024-06-01T00:00:00+00:00", "metadata"),
        "eth/transactions/3.parquet": ("eth", "transactions", "2024-07-01T00:00:00+00:00", "read_column"),
    }


def test_stale_index_and_new_columns(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/eth/transactions/1.parquet", tx(value=["1"]))
    index = stage(hs.build_time_index(spark, root, ["eth"]), "index")
    write(f"{root}/eth/transactions/2.parquet", tx(value=["2"], block_timestamp=times("2025-01-01 12:00:00", zone="UTC"), gas=[1]))
    day = [F.lit(t).cast("timestamp") for t in ("2025-01-01 00:00:00", "2025-01-02 00:00:00")]
    rows = hs.read_for_range(spark, index, root, "eth", *day)
    assert [(r.value, r.gas, r.chain) for r in rows.collect()] == [("2", 1, "eth")]
    both = hs.read_for_range(spark, index, root, "eth", F.lit("2024-01-01").cast("timestamp"), day[1])
    assert sorted((r.value, r.gas) for r in both.collect()) == [("1", None), ("2", 1)]


def test_folder_of_summaries(spark, tmp_path):
    for chain in ("eth", "base"):
        row = {"file": f"/{chain}", "chain": chain, "dataset": "transactions", "method": "metadata",
               "min_ts": "2024-01-01T00:00:00+00:00", "max_ts": "2024-01-02T00:00:00+00:00"}
        (tmp_path / f"{chain}_transactions_time_index.json").write_text(json.dumps({"files": [row], "errors": []}, indent=1))
    assert {r.chain for r in hs.read_time_index(spark, str(tmp_path)).collect()} == {"eth", "base"}
    (tmp_path / "bad_time_index.json").write_text("{broken")
    with pytest.raises(Exception):
        hs.read_time_index(spark, str(tmp_path)).collect()


def test_episodes_read_only_the_files_of_their_windows(spark):
    root = fx.write_lake(spark, SF, files=12)
    index = stage(hs.build_time_index(spark, root, fx.CHAINS), "index")
    receipts = hs.read_receipts(spark, f"{root}/receipts").orderBy("_ts", "receipt_id").limit(5)
    receipts = stage(receipts, "few")
    config = hs.EpisodeConfig(enrich_events=False)
    from hopscope.plans.lake_plan import read_days, window_days

    picked = read_days(spark, root, "transactions", window_days(receipts, config), index, (), True)
    files = sum(len(df.inputFiles()) for _, df in picked)
    total = index.filter("dataset = 'transactions'").count()
    assert 0 < files < total / 2
    pruned = hs.build_episodes_from_lake(spark, receipts, root, config, index, force_time_index=True)
    whole = hs.build_episodes(receipts, hs.read_transactions(spark, root, fx.CHAINS), None, config)
    key = lambda df: sorted((r.receipt_id, r.EPISODE_ACTIONS_JSON) for r in df.collect())
    assert key(pruned) == key(whole)
    with pytest.raises(FileNotFoundError):
        hs.build_episodes_from_lake(spark, receipts, root, config, index.limit(0), force_time_index=True)


def test_staged_tables_are_removed(spark):
    with hs.staging(spark):
        kept = stage(spark.range(3), "gone")
        path = kept.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path) and kept.count() == 3
    assert not os.path.exists(path)


def test_view_ids_have_no_gaps(spark):
    rows = [(f"f{i % 3}", i, 1 if i % 4 else 0, "0xa", "0xb", None, 0, "[]") for i in range(50)]
    schema = ("_file string, _idx int, EPISODE_TX_COUNT int, EPISODE_FIRST_TX_HASH string, EPISODE_LAST_TX_HASH string, "
              "EPISODE_LAST_TX_TIMESTAMP string, EPISODE_DURATION_SEC int, EPISODE_ACTIONS_JSON string")
    frame = spark.createDataFrame(rows, schema).repartition(7)
    every = hs.episode_view(frame, limit=0).collect()
    assert sorted(r.id for r in every) == list(range(len(every))) and len(every) == 37
    assert sorted(r.id for r in hs.episode_view(frame, limit=10).collect()) == list(range(10))
