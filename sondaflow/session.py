"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "sondaflow", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's defaults; the cluster's own settings win when it is already up."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scale_settings(shuffled_bytes: int, cores: int, partition_bytes: int = 512 << 20,
                   most_partitions: int | None = None) -> dict[str, str]:
    """Settings for a known amount of shuffled data, to pass to ``build_session`` or ``sized``.

    A shuffle starts with enough partitions for each to fit a task's memory, and
    at least two per core; adaptive execution merges those that turn out small
    up to a size worth writing as a file. ``most_partitions`` bounds their number where
    tracking map outputs costs more than larger partitions; a warning says when it does.
    """
    wanted = max(-(-shuffled_bytes // partition_bytes), 2 * cores)
    if most_partitions and wanted > most_partitions:
        warnings.warn(f"{wanted} partitions of {partition_bytes} bytes are wanted, {most_partitions} are allowed: "
                      "partitions will be larger and may spill", stacklevel=2)
        wanted = most_partitions
    return {
        "spark.sql.shuffle.partitions": str(wanted),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes // 2),
    }


def sized(spark: SparkSession, shuffled_bytes: int, cores: int | None = None, **options: int) -> SparkSession:
    """The session with the settings for this amount of data; ``cores`` are its own by default."""
    cores = cores or spark.sparkContext.defaultParallelism
    for key, value in scale_settings(shuffled_bytes, cores, **options).items():
        spark.conf.set(key, value)
    return spark


# A task of such a part sorts some hundred thousand rows, in memory and without a spill.
MOST_BYTES = {"spark.sql.files.maxPartitionBytes": 8 << 20,
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 << 20}
RECORDS_A_FILE = 500_000    # of written rows that such jobs read: a row group is never divided
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
_parts_lock = Lock()
_parts_open: dict[str, list] = {}   # by application: how many blocks are open, the settings before the first


def _bytes(setting: str) -> float:
    found = re.fullmatch(r"(\d+)\s*([a-z]*)", setting.strip().lower())
    return int(found[1]) * _UNITS[found[2]] if found and found[2] in _UNITS else float("inf")


@contextmanager
def small_parts(spark: SparkSession) -> Iterator[None]:
    """Jobs that sort whole rows: tasks take parts of the input that fit their memory, however large
    the files are. Smaller settings stay, and the session has its own again after the last such block."""
    application = spark.sparkContext.applicationId
    with _parts_lock:
        opened = _parts_open.setdefault(application, [0, {}])
        opened[0] += 1
        if opened[0] == 1:
            for key, most in MOST_BYTES.items():
                before = spark.conf.get(key)
                if _bytes(before) > most:
                    opened[1][key] = before
                    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        with _parts_lock:
            opened[0] -= 1
            if not opened[0]:
                for key, before in _parts_open.pop(application)[1].items():
                    spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine, so there the
    setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="sondaflow-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
