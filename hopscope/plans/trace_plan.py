"""Episodes + transactions + events -> action trace."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import TraceConfig
from ..operators.events import capped_events_of, decode_events, events_per_tx, normalize_events
from ..operators.key_filter import keep_possible
from ..operators.trace import TX_KEY, explode_actions, trace_rows, trace_span, trace_with_events, trace_with_meta
from ..operators.transactions import normalize_transactions, prune_to_span
from ..sources.columns import match_column
from ..sources.staging import stage


def joined_trace(
    actions: DataFrame, tx: DataFrame, events: DataFrame | None, config: TraceConfig = TraceConfig()
) -> DataFrame:
    """Exploded actions with transaction fields and nested events.

    Transactions and events are both cut to the hashes of the actions before
    they are joined, and all joins share the key ``(chain, tx_hash)``.
    """
    span = trace_span(actions)
    meta = normalize_transactions(prune_to_span(tx, "block_timestamp", span), keep_value_text=False)
    # The actions are staged, so counting them opens footers only.
    n = actions.count()
    asked = actions.select("chain", F.col("tx_hash").alias("transaction_hash"))
    trace = trace_with_meta(actions, keep_possible(meta, asked, list(asked.columns), n))
    if events is None:
        events = actions.sparkSession.createDataFrame([], "chain string, tx_hash string")
    ts_col = match_column(events.columns, ["block_timestamp"])
    if ts_col is not None:
        events = prune_to_span(events, ts_col, span)
    kept = capped_events_of(normalize_events(events), actions.select(*TX_KEY), config.max_events_per_tx, n)
    return trace_with_events(trace, events_per_tx(decode_events(kept)))


def build_action_trace(
    episodes: DataFrame, tx: DataFrame, events: DataFrame | None = None, config: TraceConfig = TraceConfig()
) -> DataFrame:
    """One row per action of every episode, with calls, events and net deltas."""
    actions = stage(explode_actions(episodes, config), "trace-actions")
    return trace_rows(joined_trace(actions, tx, events, config), config)
