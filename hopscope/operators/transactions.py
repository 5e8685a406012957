"""Transactions: normalisation, the by-actor view and key scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import method_id, normalize_addr, to_utc_ts, tx_value_text
from ..sources.columns import match_column

# Order of transactions inside an episode; the hash makes it total.
TX_ORDER = ("block_timestamp", "block_number", "transaction_index", "transaction_hash")


def tx_order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in TX_ORDER]


def prune_time(df: DataFrame, ts_col: str, lo: Column, hi: Column) -> DataFrame:
    """Keep rows with ``lo <= ts < hi``; ``lo`` and ``hi`` are UTC instants.

    The stored column is compared as it is, so the range reaches the parquet
    reader.
    """
    data_type = df.schema[ts_col].dataType
    col = F.col(ts_col)
    if isinstance(data_type, T.TimestampNTZType):
        lo, hi = _utc_wall(lo), _utc_wall(hi)
    elif not isinstance(data_type, T.TimestampType):
        col = to_utc_ts(col, data_type)
    return df.filter((col >= lo) & (col < hi))


def prune_to_span(df: DataFrame, ts_col: str, span: DataFrame) -> DataFrame:
    """``prune_time`` with the bounds of a one-row frame ``(lo, hi)``.

    The bounds enter as scalar subqueries of the stored type: nothing is
    collected, and the scan still receives them as pushed filters.
    """
    data_type = df.schema[ts_col].dataType
    col = F.col(ts_col)
    if isinstance(data_type, T.TimestampNTZType):
        span = span.select(_utc_wall(F.col("lo")).alias("lo"), _utc_wall(F.col("hi")).alias("hi"))
    elif not isinstance(data_type, T.TimestampType):
        col = to_utc_ts(col, data_type)
    return df.filter((col >= span.select("lo").scalar()) & (col < span.select("hi").scalar()))


def _utc_wall(instant: Column) -> Column:
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def require(df: DataFrame, *alternatives: list[str]) -> None:
    """Raise if none of the names of a list is a column."""
    for names in alternatives:
        if match_column(df.columns, names) is None:
            raise ValueError(f"no column {' or '.join(names)}; there are {', '.join(df.columns) or 'none'}")


def normalize_transactions(df: DataFrame, keep_value_text: bool = True) -> DataFrame:
    """One spelling for hashes, addresses, times, values and call data.

    Columns a source lacks come out as typed NULLs. Only the first four bytes
    of the call data are kept, as ``method_id``, so that the long payload is
    dropped at the scan. ``chain``, the hash and the time have to be there.
    """
    require(df, ["chain"], ["transaction_hash", "tx_hash"], ["block_timestamp"])

    def source(name: str, *aliases: str) -> tuple[Column, T.DataType]:
        found = match_column(df.columns, [name, *aliases])
        if found is None:
            return F.lit(None).cast("string"), T.StringType()
        return F.col(f"`{found}`"), df.schema[found].dataType

    def long(name: str) -> Column:
        col, data_type = source(name)
        return col.cast("long") if isinstance(data_type, T.NumericType) else col.try_cast("long")

    return df.select(
        source("chain")[0].alias("chain"),
        to_utc_ts(*source("block_timestamp")).alias("block_timestamp"),
        F.lower(source("transaction_hash", "tx_hash")[0].cast("string")).alias("transaction_hash"),
        normalize_addr(source("from_address")[0]).alias("from_address"),
        normalize_addr(source("to_address")[0]).alias("to_address"),
        tx_value_text(*source("value"), keep_text=keep_value_text).alias("value"),
        method_id(source("input")[0]).alias("method_id"),
        long("block_number").alias("block_number"),
        long("transaction_index").alias("transaction_index"),
    )


def tx_by_actor(tx: DataFrame, include_to_address: bool = True) -> DataFrame:
    """One row per transaction and acting address, with the side it is on.

    A self-transfer gives one row, on the sender side. Splitting the row in
    place reads the table once and gives the later join a plain equality key
    where "from = a OR to = a" would have none.
    """
    sides = [F.struct(F.col("from_address").alias("actor"), F.lit(0).alias("side"))]
    if include_to_address:
        sides.append(
            F.struct(
                F.when(~F.col("to_address").eqNullSafe(F.col("from_address")), F.col("to_address")).alias("actor"),
                F.lit(1).alias("side"),
            )
        )
    return tx.select("*", F.inline(F.array(*sides))).filter(F.startswith("actor", F.lit("0x")))


def scan_by_actors(
    tx: DataFrame, actors: DataFrame, start: Column, end: Column, side: str = "from"
) -> DataFrame:
    """Transactions in ``[start, end)`` whose from/to address is in ``actors``.

    ``actors`` has the columns ``chain`` and ``actor``.
    """
    keys = actors.select("chain", normalize_addr(F.col("actor")).alias(f"{side}_address")).distinct()
    return prune_time(tx, "block_timestamp", start, end).join(keys, ["chain", f"{side}_address"], "left_semi")


def scan_by_hashes(tx: DataFrame, hashes: DataFrame, start: Column, end: Column) -> DataFrame:
    """Transactions in ``[start, end)`` whose ``(chain, transaction_hash)`` is asked for."""
    keys = hashes.select("chain", F.lower("transaction_hash").alias("transaction_hash")).distinct()
    return prune_time(tx, "block_timestamp", start, end).join(keys, ["chain", "transaction_hash"], "left_semi")
