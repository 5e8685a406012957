"""Receipts + transactions + events -> episodes.

Three steps, the first two staged: who to look for in which window (receipt
sized), what they did (at most two caps of actions per receipt), and the
finished episodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import EpisodeConfig
from ..operators.episodes import align_back, assemble_episodes, collect_phase, dst_probes, src_probes
from ..operators.events import attach_events, capped_events_of, decode_events, events_per_tx, normalize_events
from ..operators.key_filter import keep_possible
from ..operators.receipts import valid_receipts, with_windows
from ..operators.source_actor import resolve_source_actor
from ..operators.transactions import normalize_transactions, prune_to_span, tx_by_actor
from ..operators.window_join import window_span
from ..sources.columns import match_column
from ..sources.staging import stage

_ACTION_COLUMNS = (
    "phase", "seq", "chain", "transaction_hash", "block_timestamp", "to_address", "value", "method_id",
)
_PROBE_INPUTS = ("_recv", "_chain", "_ts", "_src_chain", "_src_addr", "_src_tx_hash")


def episode_probes(receipts: DataFrame, tx: DataFrame, config: EpisodeConfig = EpisodeConfig()) -> DataFrame:
    """``id_cols, phase, chain, actor, w0, w1`` for both phases of each receipt.

    Only the ids and role columns travel; the other receipt columns rejoin at
    the very end.
    """
    slim = receipts.select(*config.id_cols, *_PROBE_INPUTS)
    # Read for the span, the filter, the keys and the windows, so their source is gone through once.
    windowed = stage(with_windows(valid_receipts(slim, config.chains), config), "windows")
    source_side = prune_to_span(tx, "block_timestamp", window_span(windowed, "_src_start", "_src_end"))
    asked = windowed.select(F.col("_src_chain").alias("chain"), F.col("_src_tx_hash").alias("transaction_hash"))
    possible = keep_possible(normalize_transactions(source_side), asked, list(asked.columns), windowed.count())
    resolved = resolve_source_actor(windowed, possible, config)
    return dst_probes(windowed, config.id_cols).unionByName(src_probes(resolved, config.id_cols))


def episode_actions(probes: DataFrame, tx: DataFrame, config: EpisodeConfig = EpisodeConfig()) -> DataFrame:
    """Capped actions of both phases in long form, from one pass over ``tx``."""
    in_range = normalize_transactions(prune_to_span(tx, "block_timestamp", window_span(probes)))
    # The probes are staged, so counting them opens footers only.
    actions = collect_phase(probes, tx_by_actor(in_range, config.include_to_address), config, 2 * probes.count())
    return actions.select(*config.id_cols, *_ACTION_COLUMNS)


def enrich(actions: DataFrame, events: DataFrame, max_events: int, span: DataFrame | None = None) -> DataFrame:
    """Attach decoded events; only events of kept transactions are decoded."""
    ts_col = match_column(events.columns, ["block_timestamp"])
    if span is not None and ts_col is not None:
        events = prune_to_span(events, ts_col, span)
    hashes = actions.select("chain", F.col("transaction_hash").alias("tx_hash"))
    # The actions are staged, so counting them opens footers only.
    kept = capped_events_of(normalize_events(events), hashes, max_events, actions.count())
    return attach_events(actions, events_per_tx(decode_events(kept)))


def build_episodes(
    receipts: DataFrame, tx: DataFrame, events: DataFrame | None = None, config: EpisodeConfig = EpisodeConfig()
) -> DataFrame:
    """Receipts plus the six EPISODE_* columns and the typed ``actions`` array.

    ``receipts`` come from ``canonical_receipts``; ``tx`` and ``events`` are
    raw tables with a ``chain`` column.
    """
    probes = stage(episode_probes(receipts, tx, config), "probes")
    actions = episode_actions(probes, tx, config)
    if config.enrich_events and events is not None:
        actions = enrich(stage(actions, "actions"), events, config.max_events_per_tx, window_span(probes))
    return align_back(receipts, assemble_episodes(actions, config), config.id_cols)
