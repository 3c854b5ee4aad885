"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock
from typing import Any

from pyspark.sql import SparkSession


def session(app: str = "shoplake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on: UTC dates and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Spark's setting by which a query's shuffle files go when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping: dict[str, tuple[int, str | None]] = {}
_dropping_lock = Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go as soon as it ends; else they stay until the driver happens to collect its garbage, and a job
    of many queries holds those of all of them on its disks. Meant for queries whose results are written; blocks may overlap."""
    owner = spark._jsparkSession.sessionUUID()
    with _dropping_lock:
        users, before = _dropping.get(owner) or (0, spark.conf.get(DROP_SHUFFLES, None))
        _dropping[owner] = users + 1, before
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _dropping_lock:
            users, before = _dropping.pop(owner)
            if users > 1:
                _dropping[owner] = users - 1, before
            elif before is None:
                spark.conf.unset(DROP_SHUFFLES)
            else:
                spark.conf.set(DROP_SHUFFLES, before)


_local: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    Executors on any machine must reach it, so the location is whatever ``spark.checkpoint.dir`` names. Only a local master, whose
    tasks share the driver's disk, may leave it unset and gets a temporary folder; elsewhere that is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _local.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="shoplake-")
        _local[context.applicationId] = root
    made = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(context.applicationId, []).append(made)
    return made


def scratch_made(spark: SparkSession) -> list[str]:
    """The scratch folders that this application made and has not removed, oldest first."""
    return list(_made.get(spark.sparkContext.applicationId, []))


def clear_scratch(spark: SparkSession, folders: list[str] | None = None) -> list[str]:
    """Remove scratch folders that this application made, all or some of them. Frames that were built on them can't be read any
    more, so call it once results are stored."""
    held = scratch_made(spark)
    gone = [f for f in held if folders is None or f in folders]
    for folder in gone:
        remove(spark, folder)
    _made[spark.sparkContext.applicationId] = [f for f in held if f not in gone]
    return gone


def _place(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """A path and its file system, whichever that is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def glob(spark: SparkSession, pattern: str) -> list[str]:
    place, system = _place(spark, pattern)
    plain = "://" not in pattern and not pattern.startswith("file:")
    names = [status.getPath() for status in system.globStatus(place) or []]
    return sorted(n.toUri().getPath() if plain else n.toString() for n in names)


def remove(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def set_times(spark: SparkSession, pattern: str, seconds: float) -> None:
    """Give files a time of change, as a copy does."""
    for path in glob(spark, pattern):
        place, system = _place(spark, path)
        system.setTimes(place, int(seconds * 1000), -1)
