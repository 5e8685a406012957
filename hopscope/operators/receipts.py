"""Receipts: canonical roles, validity and the two time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..config import EpisodeConfig
from ..functions import canonical_chain, time_bucket, to_utc_ts
from ..sources.columns import detect_receipt_columns

ROLES = {
    "_recv": "string",
    "_chain": "string",
    "_ts": "timestamp",
    "_src_chain": "string",
    "_src_addr": "string",
    "_src_tx_hash": "string",
}

EPISODE_COLUMNS = (
    "EPISODE_TX_COUNT",
    "EPISODE_ACTIONS_JSON",
    "EPISODE_FIRST_TX_HASH",
    "EPISODE_LAST_TX_HASH",
    "EPISODE_LAST_TX_TIMESTAMP",
    "EPISODE_DURATION_SEC",
)


def canonical_receipts(
    df: DataFrame,
    recv_col: str | None = None,
    chain_col: str | None = None,
    ts_col: str | None = None,
    id_col: str | None = None,
    ts_unit: str = "ns",
) -> DataFrame:
    """Add the role columns ``_recv .. _src_tx_hash`` next to the own ones.

    When receiver, chain or time cannot be found all roles are NULL, so the
    rows pass through with empty episodes.
    """
    cols = detect_receipt_columns(df.columns, recv=recv_col, chain=chain_col, ts=ts_col, id=id_col)
    if not cols.complete:
        return df.withColumns({name: F.lit(None).cast(t) for name, t in ROLES.items()})

    def raw(name: str) -> Column:
        return F.col(f"`{name}`")

    def lowered(name: str | None) -> Column:
        return F.lower(raw(name).cast("string")) if name else F.lit(None).cast("string")

    def chain(name: str | None) -> Column:
        return canonical_chain(raw(name), df.schema[name].dataType) if name else F.lit(None).cast("string")

    return df.withColumns(
        {
            "_recv": lowered(cols.recv),
            "_chain": chain(cols.chain),
            "_ts": to_utc_ts(raw(cols.ts), df.schema[cols.ts].dataType, ts_unit),
            "_src_chain": chain(cols.src_chain),
            "_src_addr": lowered(cols.src_addr),
            "_src_tx_hash": lowered(cols.src_tx_hash or cols.id),
        }
    )


def valid_receipts(receipts: DataFrame, chains: Sequence[str] = ()) -> DataFrame:
    """Receipts that can have an episode: an 0x receiver, a time, a wanted chain."""
    keep = F.startswith(F.col("_recv"), F.lit("0x")) & F.col("_ts").isNotNull()
    wanted = sorted({c.strip().lower() for c in chains if c.strip()})
    if wanted:
        keep = keep & F.col("_chain").isin(*wanted)
    return receipts.filter(keep)


def _minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def with_windows(receipts: DataFrame, config: EpisodeConfig = EpisodeConfig()) -> DataFrame:
    """Add both half-open windows and the bucket each one starts in."""
    dst_start = F.col("_ts") + _minutes(config.start_offset_minutes)
    src_end = F.col("_ts") + _minutes(config.pre_end_offset_minutes)
    return (
        receipts.withColumns({"_dst_start": dst_start, "_src_end": src_end})
        .withColumns(
            {
                "_dst_end": F.col("_dst_start") + _minutes(config.window_minutes),
                "_src_start": F.col("_src_end") - _minutes(config.pre_window_minutes),
            }
        )
        .withColumns(
            {
                "_dst_bucket": time_bucket(F.col("_dst_start"), config.bucket_minutes),
                "_src_bucket": time_bucket(F.col("_src_start"), config.bucket_minutes),
            }
        )
    )


def empty_episodes(df: DataFrame) -> DataFrame:
    """Append the episode columns of a receipt without any action."""
    text = F.lit(None).cast("string")
    values = (F.lit(0), F.lit("[]"), text, text, text, F.lit(None).cast("bigint"))
    return df.withColumns(dict(zip(EPISODE_COLUMNS, values)))
