"""Parameters of the two pipelines, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EpisodeConfig:
    """Windows, caps and switches of the episode builder.

    A cap of 0 or less means unlimited. ``chains`` filters receipts by their
    destination chain; empty means all. ``id_cols`` identify a receipt.
    """

    window_minutes: int = 180
    start_offset_minutes: int = 0
    pre_window_minutes: int = 60
    pre_end_offset_minutes: int = 0
    bucket_minutes: int = 60
    max_txs_per_episode: int = 50
    enrich_events: bool = True
    include_to_address: bool = True
    max_events_per_tx: int = 100
    chains: tuple[str, ...] = ("eth", "arbitrum", "optimism")
    bucket_scope: bool = False
    id_cols: tuple[str, ...] = ("_file", "_idx")


@dataclass(frozen=True)
class TraceConfig:
    """Parameters of the episode-to-trace expansion."""

    episode_actions_col: str = "EPISODE_ACTIONS_JSON"
    focus_addr_cols: tuple[str, ...] = ()
    max_events_per_tx: int = 500
    # None: file and row of the stored episode; the row alone where there is no file column.
    id_cols: tuple[str, ...] | None = None
