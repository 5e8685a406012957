"""The two pipelines over a stored lake, reading only the files that can matter.

A window asks for (chain, day) pairs. They pick the files of the transactions
and those of the events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import EpisodeConfig, TraceConfig
from ..functions import to_utc_ts
from ..operators.receipts import valid_receipts, with_windows
from ..operators.trace import explode_actions
from ..sources.files import path_exists
from ..sources.staging import stage
from ..sources.tables import unite_events, unite_transactions
from ..sources.time_index import choose_files, read_chosen
from .episode_plan import build_episodes
from .trace_plan import build_action_trace


def window_days(receipts: DataFrame, config: EpisodeConfig) -> DataFrame:
    """Distinct ``(chain, lo, hi)``, whole days that any window of a receipt touches."""
    windowed = with_windows(valid_receipts(receipts, config.chains), config)
    sides = [
        windowed.select(F.col("_chain").alias("chain"), F.col("_dst_start").alias("w0"), F.col("_dst_end").alias("w1")),
        windowed.select(F.col("_src_chain").alias("chain"), F.col("_src_start").alias("w0"), F.col("_src_end").alias("w1")),
    ]
    return _days(sides[0].unionByName(sides[1]))


def _days(windows: DataFrame) -> DataFrame:
    days = windows.filter("chain is not null and w0 is not null and w1 >= w0").select(
        "chain", F.explode(F.sequence(F.to_date("w0"), F.to_date("w1"))).alias("day")
    )
    start = F.col("day").cast("timestamp")
    return days.distinct().select("chain", start.alias("lo"), (start + F.expr("interval 1 day")).alias("hi"))


def read_days(
    spark: SparkSession,
    root: str,
    target: str,
    days: DataFrame,
    index: DataFrame | None,
    chains: Sequence[str] = (),
    force_time_index: bool = False,
) -> list[tuple[str, DataFrame]]:
    """``(chain, rows)`` of the stored files of ``target`` that can hold rows of the ``days``.

    ``chains`` defaults to those of the days, a handful of names.
    """
    days = stage(days, "days")
    wanted = list(chains) or sorted(r.chain for r in days.select("chain").distinct().collect())
    there = [c for c in wanted if path_exists(spark, f"{root.rstrip('/')}/{c}/{target}")]
    if not there:
        return []
    chosen, known = choose_files(spark, index, root, target, there, days, force_time_index)
    return [(c, read_chosen(spark, root, c, target, chosen if c in known else None)) for c in there]


def build_episodes_from_lake(
    spark: SparkSession,
    receipts: DataFrame,
    root: str,
    config: EpisodeConfig = EpisodeConfig(),
    index: DataFrame | None = None,
    force_time_index: bool = False,
) -> DataFrame:
    """``build_episodes`` over ``<root>/<chain>/transactions`` and ``decoded_events``.

    With ``force_time_index`` a chain without an index, or without a file in
    the range, raises, for transactions and for events.
    """
    days = window_days(receipts, config)
    tx = unite_transactions(spark, read_days(spark, root, "transactions", days, index, (), force_time_index))
    events = None
    if config.enrich_events:
        # Actions lie in the windows, so their days are among these.
        events = unite_events(read_days(spark, root, "decoded_events", days, index, (), force_time_index))
    return build_episodes(receipts, tx, events, config)


def build_action_trace_from_lake(
    spark: SparkSession,
    episodes: DataFrame,
    root: str,
    config: TraceConfig = TraceConfig(),
    index: DataFrame | None = None,
    force_time_index: bool = False,
) -> DataFrame:
    """``build_action_trace`` over the same folders, by the days of the episodes' actions."""
    actions = explode_actions(episodes, config)
    ts = to_utc_ts(F.col("action_ts"), actions.schema["action_ts"].dataType)
    days = _days(actions.select("chain", ts.alias("w0"), ts.alias("w1")))
    tx = unite_transactions(spark, read_days(spark, root, "transactions", days, index, (), force_time_index))
    events = unite_events(read_days(spark, root, "decoded_events", days, index, (), force_time_index))
    return build_action_trace(episodes, tx, events, config)
