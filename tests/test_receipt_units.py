"""Receipts are read by folders of one schema, not by lists of names."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import hopscope as hs
from hopscope.sources import tables
from hopscope.sources.files import list_parquet
from tests.test_lake import write

ROW = {"receipt_id": [1], "DESTINATION_ADDRESS": ["0xb"], "DESTINATION_CHAIN": ["eth"], "DESTINATION_TIMESTAMP": ["2024-01-01 00:00:00"]}
OTHER = {"receipt_id": [2], "receiver": ["0xc"], "dst_chain": ["base"], "dst_timestamp": ["2024-01-02 00:00:00"]}


def units(spark, root, **options):
    listed = list_parquet(spark, [root]).select(F.lit("receipts").alias("chain"), "path")
    return {r.unit.removeprefix(f"file:{root}") for r in tables.receipt_units(listed, **options).collect()}


def test_one_schema_is_one_path(spark, tmp_path):
    root = str(tmp_path / "receipts")
    for i in range(12):
        write(f"{root}/y={i % 2}/m{i % 3}/{i}.parquet", ROW)
    assert units(spark, root) == {""}
    assert len(units(spark, root, whole_folders=False)) == 12
    rows = hs.read_receipts(spark, root)
    assert rows.count() == 12 and rows.select("_file").distinct().count() == 12


def test_mixed_folders(spark, tmp_path):
    root = str(tmp_path / "receipts")
    for i in range(3):
        write(f"{root}/a/{i}.parquet", ROW)
        write(f"{root}/b/x/{i}.parquet", OTHER)
    write(f"{root}/b/1.parquet", ROW)
    write(f"{root}/b/2.parquet", OTHER)
    assert units(spark, root) == {"/a", "/b/x", "/b/1.parquet", "/b/2.parquet"}
    rows = hs.read_receipts(spark, root)
    assert sorted((r._recv, r._chain) for r in rows.collect()) == [("0xb", "eth")] * 4 + [("0xc", "base")] * 4
    assert hs.read_receipts(spark, root, limit_files=2).count() == 2


def test_two_hundred_thousand_names_make_one_row(spark, monkeypatch):
    """No list of names: the units of one schema are one row, whatever the number of files."""
    names = spark.range(200_000).select(F.lit("receipts").alias("chain"), F.format_string("file:/lake/r/d%03d/%06d.parquet", F.col("id") % 100, "id").alias("path"))
    footers = names.select("chain", "path", F.lit(0).alias("pos"), F.lit("a").alias("name"), F.lit("string").alias("type"), F.lit(None).cast("string").alias("error"))
    monkeypatch.setattr(tables, "file_columns", lambda files: footers)
    found = tables.receipt_units(names)
    assert [r.unit for r in found.collect()] == ["file:/lake/r"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_files_that_only_spark_can_open(spark, tmp_path):
    local = str(tmp_path / "receipts")
    write(f"{local}/a.parquet", ROW)
    write(f"{local}/b.parquet", ROW | {"extra": [1]})
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.receipts.link./lake", f"file://{tmp_path}")
    rows = hs.read_receipts(spark, "viewfs://receipts/lake/receipts")
    assert sorted(r.receipt_id for r in rows.collect()) == [1, 1] and "extra" in rows.columns
    assert pq.read_table(f"{local}/a.parquet").equals(pa.table(ROW))
