"""Cross-chain episode analytics on Spark DataFrames."""

from .config import EpisodeConfig, TraceConfig
from .operators.episodes import (
    assemble_episodes,
    collect_phase,
    dst_post_actions,
    episode_duration,
    src_pre_actions,
)
from .operators.events import (
    attach_events,
    cap_events,
    decode_approval,
    decode_events,
    decode_transfer,
    events_per_tx,
    normalize_events,
    scan_events,
)
from .operators.profile import schema_column_presence, schema_global_union, schema_groups, schema_summary
from .operators.receipts import canonical_receipts, empty_episodes, valid_receipts, with_windows
from .operators.source_actor import resolve_source_actor
from .operators.trace import explode_actions, focus_addresses, native_delta, transfer_delta
from .operators.transactions import normalize_transactions, scan_by_actors, scan_by_hashes, tx_by_actor
from .operators.view import episode_event_preview, episode_view
from .operators.window_join import cap_actions, first_n_join
from .plans.episode_plan import build_episodes, episode_actions, episode_probes
from .plans.lake_plan import build_action_trace_from_lake, build_episodes_from_lake
from .plans.trace_plan import build_action_trace
from .session import builder, tune
from .sources.columns import detect_receipt_columns, project_tolerant, union_promoting
from .sources.files import file_columns, list_parquet
from .sources.staging import staging
from .sources.tables import (
    read_decoded_events,
    read_episodes,
    read_receipts,
    read_transactions,
    write_action_trace,
    write_episodes,
)
from .sources.time_index import (
    build_time_index,
    read_for_range,
    read_time_index,
    select_files,
    time_index_summary,
    write_time_index,
    write_time_index_json,
)

__all__ = [name for name in dir() if not name.startswith("_")]
