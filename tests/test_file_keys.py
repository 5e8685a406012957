"""A file has one name, however an index spells it; folders of values are pruned at run time."""

import json

import pytest
from pyspark.sql import functions as F

import hopscope as hs
from hopscope.sources.staging import stage
from hopscope.sources.time_index import choose_files, file_keys
from tests.test_lake import times, tx, write


def instants(*texts):
    return [F.lit(t).cast("timestamp") for t in texts]


def whole_span():
    return instants("2024-01-01 00:00:00", "2025-01-02 00:00:00")


@pytest.fixture
def lake(tmp_path):
    root = str(tmp_path / "lake")
    for i in range(4):
        day = f"2024-01-0{i + 1} 12:00:00"
        write(f"{root}/eth/transactions/{i}.parquet", tx(value=[str(i)], block_timestamp=times(day, zone="UTC")))
        write(f"{root}/eth/decoded_events/{i}.parquet", tx(log_index=[i], block_timestamp=times(day, zone="UTC")))
    return root


@pytest.mark.parametrize("spell", ["/{rel}", "/./{rel}", "//{rel}"])
@pytest.mark.parametrize("before", ["{root}", "file://{root}", "file:{root}", "file:///{root}", "/another/mount", "s3://bucket/lake", ".", ""])
def test_spellings_are_one_file(spark, before, spell):
    root = "/data/my lake"
    rel = "eth/transactions/day=1/part 0.parquet"
    name = (before + spell).format(root=root, rel=rel)
    if before == "":
        name = name.lstrip("/")
    rows = spark.createDataFrame([(name, f"./{rel}")], "file string, rel_file string")
    assert file_keys(spark, rows, root + "/").first()["key"] == f"file:{root}/{rel}"
    assert file_keys(spark, rows, f"file://{root}").first()["key"] == f"file:{root}/{rel}"


def summary(root, files, chain="eth", target="transactions"):
    rows = [
        {"file": f, "rel_file": f"{chain}/{target}/{i}.parquet", "chain": chain, "dataset": target, "timestamp_col": "block_timestamp",
         "min_ts": f"2024-01-0{i + 1}T12:00:00+00:00", "max_ts": f"2024-01-0{i + 1}T12:00:00+00:00", "method": "metadata"}
        for i, f in files
    ]
    return json.dumps({"base_dir": root, "chain": chain, "dataset": target, "files": rows, "errors": []}, indent=2)


def test_plain_paths_give_each_row_once(spark, lake, tmp_path):
    files = [(i, f"{lake}/eth/transactions/{i}.parquet") for i in range(4)]
    path = tmp_path / "eth_transactions_time_index.json"
    path.write_text(summary(lake, files))
    index = hs.read_time_index(spark, str(path))
    rows = hs.read_for_range(spark, index, lake, "eth", *whole_span())
    assert sorted(r.value for r in rows.collect()) == ["0", "1", "2", "3"]
    one = instants("2024-01-02 00:00:00", "2024-01-03 00:00:00")
    rows = hs.read_for_range(spark, index, lake, "eth", *one)
    assert [r.value for r in rows.collect()] == ["1"] and len(rows.inputFiles()) == 1
    assert spark.read.parquet(f"{lake}/eth/transactions").count() == 4


def test_repeated_and_deleted_and_unlisted_files(spark, lake, tmp_path):
    files = [(0, f"{lake}/eth/transactions/0.parquet"), (0, f"file://{lake}/eth/transactions/0.parquet"), (1, "eth/transactions/1.parquet"), (9, "eth/transactions/9.parquet")]
    (tmp_path / "x_time_index.json").write_text(summary(lake, files))
    rows = hs.read_for_range(spark, hs.read_time_index(spark, str(tmp_path)), lake, "eth", *whole_span())
    assert sorted(r.value for r in rows.collect()) == ["0", "1", "2", "3"]


def test_json_summaries_round_trip(spark, lake):
    index = stage(hs.build_time_index(spark, lake, ["eth"]), "index")
    hs.write_time_index_json(index, lake, f"{lake}/time_indexes")
    with open(f"{lake}/time_indexes/eth_transactions_time_index.json", encoding="utf-8") as file:
        stored = json.load(file)
    assert (stored["n_files"], stored["n_indexed"], stored["n_errors"], stored["errors"]) == (4, 4, 0, [])
    assert [f["file"] for f in stored["files"]] == [f"{lake}/eth/transactions/{i}.parquet" for i in range(4)]
    assert list(stored["files"][0]) == ["file", "rel_file", "chain", "dataset", "timestamp_col", "min_ts", "max_ts", "method"]
    again = hs.read_time_index(spark, f"{lake}/time_indexes")
    assert again.count() == index.count() == 8


def test_all_chains_are_chosen_in_one_go(spark, lake):
    write(f"{lake}/base/transactions/0.parquet", tx(value=["b"], block_timestamp=times("2024-01-03 12:00:00", zone="UTC")))
    index = stage(hs.build_time_index(spark, lake, ["eth", "base"]), "index")
    days = spark.sql("select chain, timestamp'2024-01-03' lo, timestamp'2024-01-04' hi from values ('eth'), ('base') t(chain)")
    chosen, known = choose_files(spark, index, lake, "transactions", ["eth", "base"], days)
    assert known == ["base", "eth"]
    assert sorted((r.chain, r.key.rpartition("/")[2]) for r in chosen.collect()) == [("base", "0.parquet"), ("eth", "2.parquet")]


def test_force_holds_for_events(spark, lake):
    index = stage(hs.build_time_index(spark, lake, ["eth"], ["transactions"]), "index")
    row = [(1, "0x2", "eth", "2024-01-01 12:00:00", "eth", "0x1", "0xA")]
    names = "receipt_id long, DESTINATION_ADDRESS string, DESTINATION_CHAIN string, DESTINATION_TIMESTAMP string, SOURCE_CHAIN string, SOURCE_ADDRESS string, SOURCE_TX_HASH string"
    receipts = hs.canonical_receipts(spark.createDataFrame(row, names))
    config = hs.EpisodeConfig(id_cols=("receipt_id",))
    assert hs.build_episodes_from_lake(spark, receipts, lake, config, index).count() == 1
    with pytest.raises(FileNotFoundError, match="no time index for eth/decoded_events"):
        hs.build_episodes_from_lake(spark, receipts, lake, config, index, force_time_index=True)


def test_folders_of_values_are_pruned_at_run_time(spark, tmp_path):
    root = str(tmp_path / "lake")
    for i in range(1, 9):
        day = f"2024-01-0{i}"
        for part in range(2):
            write(f"{root}/eth/transactions/date={day}/{part}.parquet", tx(value=[f"{i}.{part}"], block_timestamp=times(f"{day} 12:00:00", zone="UTC")))
    index = stage(hs.build_time_index(spark, root, ["eth"]), "index")
    span = instants("2024-01-03 00:00:00", "2024-01-05 00:00:00")
    rows = hs.read_for_range(spark, index, root, "eth", *span)
    assert sorted(r.value for r in rows.collect()) == ["3.0", "3.1", "4.0", "4.1"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    scan = plan[plan.index("Scan parquet") if "Scan parquet" in plan else 0 :]
    assert "PartitionFilters: [isnotnull(date" in scan or "dynamicpruningexpression" in scan
