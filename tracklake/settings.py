"""Ingest settings, read from the environment once and then frozen."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class IngestSettings:
    lake_root: str
    checkpoint_root: str
    source: str = "kafka"  # kafka | files | archive | rate
    bootstrap_servers: str = "localhost:9092"
    files_root: str | None = None
    starting_offsets: str = "earliest"  # or latest; of an archive also an hour like 2024-01-02T03
    fail_on_data_loss: bool = False
    max_offsets_per_trigger: int = 50_000
    max_files_per_trigger: int | None = None
    trigger_interval: str = "60 seconds"
    run_once: bool = False  # drain what is there, then stop
    run_id: str = "main"  # a new id replays from the start into new folders

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> IngestSettings:
        env = os.environ if env is None else env
        lake = env.get("LAKE_ROOT", "lake").rstrip("/")
        host, port = env.get("KAFKA_ADDRESS", "localhost"), env.get("KAFKA_PORT", "9092")
        files_per_trigger = env.get("SPARK_MAX_FILES_PER_TRIGGER")
        return cls(
            lake_root=lake,
            checkpoint_root=env.get("CHECKPOINT_ROOT", f"{lake}/checkpoint").rstrip("/"),
            source=env.get("STREAM_SOURCE", "kafka"),
            bootstrap_servers=f"{host}:{port}",
            files_root=env.get("STREAM_FILES_ROOT"),
            starting_offsets=env.get("SPARK_STARTING_OFFSETS", "earliest"),
            fail_on_data_loss=env.get("SPARK_FAIL_ON_DATA_LOSS", "false").lower() == "true",
            max_offsets_per_trigger=int(env.get("SPARK_MAX_OFFSETS_PER_TRIGGER", "50000")),
            max_files_per_trigger=int(files_per_trigger) if files_per_trigger else None,
            trigger_interval=env.get("SPARK_TRIGGER_INTERVAL", "60 seconds"),
            run_once=env.get("STREAM_RUN_ONCE", "false").lower() == "true",
            run_id=env.get("SPARK_RUN_ID", "main"),
        )

    def sink_path(self, topic: str) -> str:
        """Replaying never deletes: another run id writes beside the old data."""
        return f"{self.lake_root}/{topic}" if self.run_id == "main" else f"{self.lake_root}/{self.run_id}/{topic}"

    def checkpoint_path(self, topic: str) -> str:
        return f"{self.checkpoint_root}/{self.run_id}/{topic}"
