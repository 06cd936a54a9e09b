"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import SparkSession

# Settings the jobs are designed for. Java never compiles methods beyond 8000 bytes, so a wider
# generated loop is better run operator by operator.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

SHUFFLE_BYTES_PER_PARTITION = 128 << 20
# Parquet on disk against rows in a shuffle.
SHUFFLE_EXPANSION = 3

_local_dirs: dict[str, str] = {}


def build_session(app: str = "meterline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        path = tempfile.mkdtemp(prefix="meterline-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _local_dirs[context.applicationId] = path
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def side_by_side(calls: Iterable[Callable[[], Any]], at_once: int = 8) -> list:
    """Results of calls that start independent jobs; the first error is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        return [future.result() for future in [pool.submit(call) for call in calls]]


@contextlib.contextmanager
def shuffles_sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Raise the shuffle partition count so that one partition of ``input_bytes`` fits a task.

    Adaptive execution merges partitions that turn out small but cannot add any, so a
    month of terabytes needs a higher starting point than the session's default.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    wanted = -(-input_bytes * SHUFFLE_EXPANSION // SHUFFLE_BYTES_PER_PARTITION)
    spark.conf.set(key, str(max(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(key, before)
