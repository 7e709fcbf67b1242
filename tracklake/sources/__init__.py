from .feeds import csv_with_header, delimited_feed, feed_rejects, json_archive, seed
from .lake import drop_view, hour_has_rows, hour_of, parquet_glob, register_view, snake_case_columns
from .replay import replay_stream, start_mark
from .stream import event_stream, file_stream, kafka_options, kafka_stream, rate_stream

__all__ = [
    "csv_with_header",
    "delimited_feed",
    "feed_rejects",
    "drop_view",
    "event_stream",
    "file_stream",
    "hour_has_rows",
    "hour_of",
    "json_archive",
    "kafka_options",
    "kafka_stream",
    "parquet_glob",
    "rate_stream",
    "register_view",
    "replay_stream",
    "seed",
    "snake_case_columns",
    "start_mark",
]
