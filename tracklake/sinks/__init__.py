from .compaction import compact, read_compacted
from .interleave import interleaved_key, rank_bounds, write_interleaved
from .tables import (
    append_hour,
    delete_path,
    ensure_table,
    overwrite_table,
    path_exists,
    table_exists,
    with_event_date,
    write_clustered,
    write_partitioned,
)

__all__ = [
    "append_hour",
    "compact",
    "delete_path",
    "path_exists",
    "rank_bounds",
    "read_compacted",
    "ensure_table",
    "interleaved_key",
    "overwrite_table",
    "table_exists",
    "with_event_date",
    "write_clustered",
    "write_interleaved",
    "write_partitioned",
]
