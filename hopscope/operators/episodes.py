"""From capped actions to one episode per receipt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..config import EpisodeConfig
from ..functions import ts_iso
from ..functions.json_args import ACTION_FIELDS, ACTION_TYPE, bare_integers
from .receipts import EPISODE_COLUMNS
from .window_join import cap_actions, first_n_join

DST_POST = "dst_post"
SRC_PRE = "src_pre"


def dst_probes(windowed: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """What the receiver did after arrival."""
    return windowed.select(
        *id_cols,
        F.lit(DST_POST).alias("phase"),
        F.col("_chain").alias("chain"),
        F.trim("_recv").alias("actor"),
        F.col("_dst_start").alias("w0"),
        F.col("_dst_end").alias("w1"),
    )


def src_probes(resolved: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """What the source actor did before arrival."""
    return resolved.select(
        *id_cols,
        F.lit(SRC_PRE).alias("phase"),
        F.col("_src_chain").alias("chain"),
        F.trim("_src_actor").alias("actor"),
        F.col("_src_start").alias("w0"),
        F.col("_src_end").alias("w1"),
    ).filter(F.col("chain").isNotNull() & F.startswith("actor", F.lit("0x")))


def collect_phase(
    probes: DataFrame, by_actor: DataFrame, config: EpisodeConfig = EpisodeConfig(), expected: int | None = None
) -> DataFrame:
    """Capped, numbered actions of the probes, in long form.

    Probes of both phases can be passed together: the transactions are then
    read and ordered once for both. ``expected`` is as in ``first_n_join``.
    """
    slot = max(config.window_minutes, config.pre_window_minutes, 1)
    pairs = first_n_join(probes, by_actor, config.max_txs_per_episode, slot, expected)
    return cap_actions(pairs, config.id_cols, config.max_txs_per_episode)


def dst_post_actions(windowed: DataFrame, by_actor: DataFrame, config: EpisodeConfig = EpisodeConfig()) -> DataFrame:
    """``collect_phase`` on the destination side."""
    return collect_phase(dst_probes(windowed, config.id_cols), by_actor, config)


def src_pre_actions(resolved: DataFrame, by_actor: DataFrame, config: EpisodeConfig = EpisodeConfig()) -> DataFrame:
    """``collect_phase`` on the source side; needs ``_src_actor``."""
    return collect_phase(src_probes(resolved, config.id_cols), by_actor, config)


def _micros_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def episode_duration(last_ts: Column, receipt_ts: Column) -> Column:
    """Whole seconds from arrival to the last action, cut towards zero."""
    return F.call_function("div", _micros_between(last_ts, receipt_ts), F.lit(1_000_000).cast("long"))


def actions_json(actions: Column) -> Column:
    """JSON list of the actions; amounts are numbers, absent fields are left out."""
    return bare_integers(F.to_json(actions), "value", "amount")


def assemble_episodes(actions: DataFrame, config: EpisodeConfig = EpisodeConfig()) -> DataFrame:
    """One row per id: the ordered ``actions`` array and its summary.

    Order: time, source side first on ties, then the order inside the phase.
    """
    with_events = "events" in actions.columns
    fields = {
        "ts": ts_iso(F.col("block_timestamp")),
        "tx_hash": F.col("transaction_hash"),
        "to": F.col("to_address"),
        "events": F.col("events") if with_events else F.lit(None),
    }
    names = [n for n, _ in ACTION_FIELDS] + ["events"]
    body = F.struct(*[fields.get(n, F.col(n)).alias(n) for n in names]).cast(ACTION_TYPE)
    item = F.struct(
        F.col("block_timestamp").alias("at"),
        (F.col("phase") == DST_POST).cast("int").alias("rank"),
        F.col("seq"),
        body.alias("action"),
    )
    ordered = actions.groupBy(*config.id_cols).agg(F.array_sort(F.collect_list(item)).alias("_ordered"))
    bodies = ordered.select(
        *config.id_cols,
        F.transform("_ordered", lambda x: x["action"]).alias("actions"),
        F.element_at("_ordered", -1)["at"].alias("_last_at"),
    )
    return bodies.withColumns(
        {
            "EPISODE_TX_COUNT": F.size("actions"),
            "EPISODE_ACTIONS_JSON": actions_json(F.col("actions")),
            "EPISODE_FIRST_TX_HASH": F.element_at("actions", 1)["tx_hash"],
            "EPISODE_LAST_TX_HASH": F.element_at("actions", -1)["tx_hash"],
            "EPISODE_LAST_TX_TIMESTAMP": F.element_at("actions", -1)["ts"],
        }
    )


def align_back(receipts: DataFrame, episodes: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Every receipt with its episode; those without one get the empty values."""
    joined = receipts.join(episodes, list(id_cols), "left").withColumns(
        {
            "EPISODE_TX_COUNT": F.coalesce("EPISODE_TX_COUNT", F.lit(0)),
            "EPISODE_ACTIONS_JSON": F.coalesce("EPISODE_ACTIONS_JSON", F.lit("[]")),
            "EPISODE_DURATION_SEC": episode_duration(F.col("_last_at"), F.col("_ts")),
            "actions": F.coalesce("actions", F.array()),
        }
    )
    return joined.select(*[F.col(f"`{c}`") for c in receipts.columns], *EPISODE_COLUMNS, "actions")
