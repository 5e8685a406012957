"""Files that a stale index does not list and that only Spark can open."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import hopscope as hs
from hopscope.sources import time_index
from hopscope.sources.staging import stage
from tests.test_lake import times, tx, write


def test_unlisted_file_that_arrow_cannot_open_is_read(spark, tmp_path):
    local = str(tmp_path)
    write(f"{local}/eth/transactions/1.parquet", tx(value=["1"]))
    index = stage(hs.build_time_index(spark, local, ["eth"]), "index")
    write(f"{local}/eth/transactions/2.parquet", tx(value=["2"], block_timestamp=times("2025-01-01 12:00:00", zone="UTC")))
    day = [F.lit(t).cast("timestamp") for t in ("2025-01-01 00:00:00", "2025-01-02 00:00:00")]
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.unopened.link./lake", f"file://{local}")
    root = "viewfs://unopened/lake"
    index = index.withColumn("file", F.concat(F.lit(f"{root}/"), "rel_file"))
    rows = hs.read_for_range(spark, index, root, "eth", *day)
    assert [r.value for r in rows.collect()] == ["2"]


def test_unlisted_file_whose_bytes_are_no_parquet_is_left_out(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/eth/transactions/1.parquet", tx(value=["1"]))
    index = stage(hs.build_time_index(spark, root, ["eth"]), "index")
    (tmp_path / "eth/transactions/2.parquet").write_bytes(b"no parquet at all")
    day = [F.lit(t).cast("timestamp") for t in ("2024-01-01 00:00:00", "2024-01-02 00:00:00")]
    with pytest.warns(UserWarning, match="not parquet, left out: .*2.parquet"):
        rows = hs.read_for_range(spark, index, root, "eth", *day)
    assert [r.value for r in rows.collect()] == ["1"]


@pytest.mark.parametrize("data, foreign", [(b"", True), (b"PAR1", True), (b"PAR1 not parquet", True), (b"PAR1 broken one PAR1", False)])
def test_only_the_bytes_show_that_a_file_is_no_parquet(data, foreign):
    assert time_index._not_parquet(pa.BufferReader(data)) is foreign
