from .durable import Cache, Lifetime, discard, fetch_small, lookup_join, materialize, measured, shared_folder, table_scope
from .points import assemble, load_points, partition_count, partition_layout, shuffle, subset, to_points, with_partitions
from .runlog import RunLog, append_run_log, compact_run_log, read_run_logs, unfinished

__all__ = [
    "Cache",
    "Lifetime",
    "RunLog",
    "append_run_log",
    "assemble",
    "compact_run_log",
    "discard",
    "fetch_small",
    "load_points",
    "lookup_join",
    "materialize",
    "measured",
    "partition_count",
    "partition_layout",
    "read_run_logs",
    "shared_folder",
    "shuffle",
    "subset",
    "table_scope",
    "to_points",
    "unfinished",
    "with_partitions",
]
