from .archive import archive_frame, start_archive
from .decode import decode_events, decoded_with_context, doubtful, readable, rejected
from .dedup import dedup_sink, dedup_stream
from .run import file_sink, health, keep_running, run_topics, start_topic, supervise, topic_writers

__all__ = [
    "archive_frame",
    "decode_events",
    "decoded_with_context",
    "dedup_sink",
    "dedup_stream",
    "doubtful",
    "file_sink",
    "health",
    "keep_running",
    "readable",
    "rejected",
    "run_topics",
    "start_archive",
    "start_topic",
    "supervise",
    "topic_writers",
]
