"""Staged tables and the disk they take."""

import glob

import pyarrow.parquet as pq

from hopscope.sources.staging import stage


def test_staged_tables_are_packed_well(spark):
    rows = spark.range(1000).selectExpr("id", "repeat(cast(id as string), 20) as text")
    staged = stage(rows, "packed")
    files = [f for x in staged.inputFiles() for f in glob.glob(x.removeprefix("file://"))]
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(1).compression for f in files} == {"ZSTD"}
    assert sorted(staged.collect()) == sorted(rows.collect())
