"""The derived tables in tasks and files of a bounded number of rows."""

import datetime

from hopscope import fixtures as fx
from hopscope import tune
from hopscope.sources.files import list_parquet


def events(spark, tmp_path, n=600):
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, start + datetime.timedelta(minutes=i), i % 7, "purchase" if i % 5 == 0 else "view", 1.0, "{}") for i in range(n)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_rows_of_a_task_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    d = events(spark, tmp_path)
    whole = sorted(fx.decoded_events(spark, d).collect())
    monkeypatch.setattr(fx, "ROWS_PER_TASK", 20, raising=False)
    small = fx.decoded_events(spark, d)
    assert small.rdd.getNumPartitions() == 30
    assert sorted(small.collect()) == whole and len(whole) == 1500


def test_files_of_a_lake_grow_with_the_table(spark, tmp_path, monkeypatch):
    d = events(spark, tmp_path)
    monkeypatch.setattr(fx, "ROWS_PER_TASK", 20, raising=False)
    root = fx.write_lake(spark, d)
    for table in ("transactions", "decoded_events"):
        assert list_parquet(spark, [f"{root}/eth/{table}"]).count() > 8
    assert list_parquet(spark, [f"{root}/receipts"]).count() == 2
    assert sum(spark.read.parquet(f"{root}/{c}/transactions").count() for c in fx.CHAINS) == 600


def test_merged_partitions_are_small_unless_set(spark):
    key, was = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.unset(key)
        assert tune(spark).conf.get(key) == "16m"
        spark.conf.set(key, "8m")
        assert tune(spark).conf.get(key) == "8m"
    finally:
        spark.conf.set(key, was)
