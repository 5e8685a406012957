"""Projections for browsing episodes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import parse_actions
from ..functions.scalars import null_if_blank
from ..sources.columns import match_column
from ..sources.staging import stage
from .receipts import EPISODE_COLUMNS

# Receipt columns shown if present, best first.
RECEIVER_NAMES = ["DESTINATION_ADDRESS", "RECEIVER", "TO", "to", "destination_address", "receiver"]
CHAIN_NAMES = ["DESTINATION_CHAIN", "DST_CHAIN", "destination_chain", "dst_chain"]
TIME_NAMES = ["BLOCK_TIMESTAMP", "block_timestamp", "DESTINATION_TIMESTAMP", "destination_timestamp", "timestamp"]


def episode_view(
    episodes: DataFrame, limit: int = 2000, id_cols: Sequence[str] = ("_file", "_idx")
) -> DataFrame:
    """Episodes with at least one action, the first ``limit`` in id order.

    ``id`` counts from 0 without gaps. The limit becomes a distributed top-k and
    only its rows are numbered in one place; with ``limit=0`` all rows are kept,
    written in order once, and numbered by file and place.
    """
    missing = [c for c in EPISODE_COLUMNS if c not in episodes.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")

    def shown(candidates: list[str]) -> Column:
        found = match_column(episodes.columns, candidates)
        return F.col(f"`{found}`") if found else F.lit(None).cast("string")

    order = [F.col(c) for c in id_cols]
    kept = episodes.filter(F.coalesce("EPISODE_TX_COUNT", F.lit(0)) > 0).orderBy(*order)
    if limit > 0:
        top = kept.limit(limit)
        number = F.row_number().over(Window.orderBy(*order)).cast("long") - 1
    else:
        top, number = _numbered(kept)
    # The names of the shown columns.
    return top.select(
        number.alias("id"),
        F.col("EPISODE_TX_COUNT").alias("tx_count"),
        F.col("EPISODE_FIRST_TX_HASH").alias("first_tx"),
        F.col("EPISODE_LAST_TX_HASH").alias("last_tx"),
        F.col("EPISODE_LAST_TX_TIMESTAMP").alias("last_ts"),
        F.col("EPISODE_DURATION_SEC").alias("duration_sec"),
        shown(RECEIVER_NAMES).alias("receiver"),
        shown(CHAIN_NAMES).alias("dst_chain"),
        shown(TIME_NAMES).cast("string").alias("receipt_ts"),
        parse_actions(F.col("EPISODE_ACTIONS_JSON")).alias("actions"),
    )


def _numbered(ordered: DataFrame) -> tuple[DataFrame, Column]:
    """A sorted frame, stored, and its row numbers; the rows of each file are counted, not gathered."""
    stored = stage(ordered, "view")
    part = F.regexp_extract(F.col("_metadata.file_name"), "part-([0-9]+)", 1).cast("int")
    placed = stored.select("*", part.alias("_part"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row for each file of the sort.
    starts = sizes.select("_part", before.alias("_start"))
    return placed.join(starts, "_part"), F.col("_start") + F.col("_row")


def _event_line(event: Column) -> Column:
    amount = F.coalesce(F.concat(F.lit(" amt="), null_if_blank(event["amount"])), F.lit(""))
    name = F.coalesce(null_if_blank(event["event_name"]), event["event_signature"], F.lit(""))
    contract = F.coalesce(null_if_blank(event["contract"]), event["token"], F.lit(""))
    return F.trim(F.concat(name, F.lit(" "), contract, amount))


def episode_event_preview(view: DataFrame, max_lines: int = 3) -> DataFrame:
    """One row per action of ``episode_view`` with a short text of its events."""

    def blank(name: str) -> Column:
        return F.coalesce(F.col(f"_a.{name}"), F.lit("")).alias(name)

    events = F.coalesce(F.col("_a.events"), F.array())
    lines = F.transform(F.slice(events, 1, max_lines), _event_line)
    return view.select("id", F.posexplode("actions").alias("tx_pos", "_a")).select(
        "id",
        "tx_pos",
        *[blank(n) for n in ("ts", "tx_hash", "to", "value", "method_id")],
        F.size(events).alias("events_count"),
        F.array_join(lines, "\n").alias("events_preview"),
    )
