"""Change-data lake jobs on Spark: decode, write, read, plan, track and check."""

from cdclake.functions.images import DEFAULT_TYPES, TypeRegistry
from cdclake.functions.positions import commit_date, lsn_str, lsn_value
from cdclake.operators.cuts import segments_joint
from cdclake.operators.decode import decode, select_tables
from cdclake.operators.filters import filter_changes, not_commit
from cdclake.operators.planning import day_runs, file_manifest, segments_by_count, segments_by_interval
from cdclake.operators.progress import (
    acked_history,
    acked_position,
    backlog,
    contiguous_prefix,
    fold_ledger,
    position_regressions,
    resume,
    safe_restart,
    stream_health,
)
from cdclake.operators.reconcile import (
    conservation,
    dedup_replays,
    duplicate_keys,
    expand_image,
    misplaced_rows,
    missing_changes,
    mixed_day_files,
    order_breaks,
    rolled_back_leaks,
    row_identity,
)
from cdclake.operators.replays import remove_replays
from cdclake.sources.lake import compact_days, export_dated, live_files, read_changes, read_dated, vacuum, write_changes
from cdclake.sources.messages import read_messages, stream_messages
from cdclake.streaming.stream import drain, stream_changes

__all__ = [
    "DEFAULT_TYPES",
    "TypeRegistry",
    "acked_history",
    "acked_position",
    "backlog",
    "commit_date",
    "compact_days",
    "conservation",
    "contiguous_prefix",
    "day_runs",
    "decode",
    "dedup_replays",
    "drain",
    "duplicate_keys",
    "expand_image",
    "export_dated",
    "file_manifest",
    "filter_changes",
    "fold_ledger",
    "live_files",
    "lsn_str",
    "lsn_value",
    "misplaced_rows",
    "missing_changes",
    "mixed_day_files",
    "not_commit",
    "order_breaks",
    "position_regressions",
    "read_changes",
    "read_dated",
    "read_messages",
    "remove_replays",
    "resume",
    "rolled_back_leaks",
    "row_identity",
    "safe_restart",
    "segments_by_count",
    "segments_by_interval",
    "segments_joint",
    "select_tables",
    "stream_changes",
    "stream_health",
    "stream_messages",
    "vacuum",
    "write_changes",
]
