"""Who acted on the source chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import EpisodeConfig
from ..functions.scalars import NULL_WORDS
from .transactions import TX_ORDER


def _search_windows(receipts: DataFrame, config: EpisodeConfig) -> DataFrame:
    """Per-receipt window, or the span of all windows of its (chain, bucket)."""
    if not config.bucket_scope:
        return receipts.withColumns({"w0": F.col("_src_start"), "w1": F.col("_src_end")})
    spans = receipts.groupBy("_src_chain", "_src_bucket").agg(
        F.min("_src_start").alias("w0"), F.max("_src_end").alias("w1")
    )
    return receipts.join(spans, ["_src_chain", "_src_bucket"])


def resolve_source_actor(receipts: DataFrame, tx: DataFrame, config: EpisodeConfig = EpisodeConfig()) -> DataFrame:
    """Add ``_src_actor`` to windowed receipts.

    It is the sender of the source transaction if that is found inside the
    window (the earliest copy counts), else the address on the receipt. The
    inner join comes first: it shrinks the transactions to the asked-for
    hashes and lets a small receipt side be broadcast, which an outer join
    with the receipts on the preserved side could not do.
    """
    ids = list(config.id_cols)
    searched = _search_windows(receipts.filter(F.col("_src_chain").isNotNull()), config)
    # Placeholders would all meet in one key and match nothing.
    named = (F.length("_src_tx_hash") > 0) & ~F.lower("_src_tx_hash").isin(*NULL_WORDS, "0x")
    keys = searched.filter(named).select(
        *ids,
        F.col("_src_chain").alias("chain"),
        F.col("_src_tx_hash").alias("transaction_hash"),
        "w0",
        "w1",
    )
    ts = F.col("block_timestamp")
    order = F.struct(*[_nulls_last(c) for c in TX_ORDER if c != "transaction_hash"])
    senders = (
        tx.select("chain", "from_address", *TX_ORDER)
        .join(keys, ["chain", "transaction_hash"])
        .filter((ts >= F.col("w0")) & (ts < F.col("w1")))
        .groupBy(*ids)
        .agg(F.min_by("from_address", order).alias("_sender"))
    )
    return (
        receipts.join(senders, ids, "left")
        .withColumn("_src_actor", F.coalesce("_sender", "_src_addr"))
        .drop("_sender")
    )


def _nulls_last(name: str) -> Column:
    return F.struct(F.col(name).isNull().alias("missing"), F.col(name).alias("value"))
