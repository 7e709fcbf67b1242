"""Session construction and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# So many jobs of one driver run at once. The tasks share the same cores, so a task has no less memory than before.
AT_ONCE = 4

# Settings every job of this package relies on. Shuffle width and memory are
# left to the cluster: adaptive execution coalesces and splits partitions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Building a plan records a Python stack per column otherwise.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(
    app_name: str = "tracklake", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Get or create a session; ``master=None`` leaves the choice to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make a session that somebody else built read and print times in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``.

    The cluster names a folder all executors share. Only a ``local`` session, where driver and
    executor are one process, may do without: it gets a temporary folder. Elsewhere a missing
    setting is an error, as each worker would write to its own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tracklake-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def side_by_side(spark: SparkSession, steps: Iterable[Callable[[], None]]) -> None:
    """Run steps that do not depend on each other at once, so that the end of one does not leave the cores idle.

    All of them end before the first error, if any, is raised.
    """
    with ThreadPoolExecutor(AT_ONCE) as pool:
        # Wrapped one by one: each has its own copy of the caller's job properties.
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for done in running:
        done.result()
