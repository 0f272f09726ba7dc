"""Spark session defaults and the shared checkpoint folder.

On a cluster the session comes configured (``spark.checkpoint.dir`` points
at a shared folder).  ``build_session`` fills settings that neither the
submitted configuration nor an active session names, and overrides none.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark import SparkConf, SparkContext, inheritable_thread_target
from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "skyledger",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session; settings that are not named elsewhere get defaults.

    ``shuffle_partitions`` and ``extra`` are the caller's own settings and always hold.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = unset_defaults()
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def unset_defaults() -> dict[str, str]:
    """The defaults that neither an active session nor the submitted configuration has."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return {k: v for k, v in _DEFAULTS.items() if active.conf.get(k, None) is None}
    SparkContext._ensure_initialized()  # without a JVM, SparkConf sees no submitted settings
    submitted = SparkConf()
    return {k: v for k, v in _DEFAULTS.items() if not submitted.contains(k)}


def run_together(spark: SparkSession, calls: Sequence[Callable[[], object]]) -> None:
    """Run the calls, each a Spark job, side by side; the first failure is raised.

    The threads inherit the caller's job group and scheduler pool, so that
    cancelling the group (as stopping a stream does) reaches their jobs.  The
    last call runs in the caller's thread: a thread is a connection to the JVM.
    """
    if not calls:
        return
    *others, own = calls
    with ThreadPoolExecutor(max(1, len(others))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(call)) for call in others]
        own()
        for done in running:
            done.result()


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder.

    A cluster names a shared folder in ``spark.checkpoint.dir`` and that is
    used as is.  Only a local session without it gets a fresh temporary
    folder; on any other master its absence is an error, as executors could
    not see a folder of the driver's machine.
    """
    root = checkpoint_root(spark)
    if not root:
        master = spark.sparkContext.master
        if not is_local(master):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master {master})")
        root = tempfile.mkdtemp(prefix="skyledger-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, *[p.strip("/") for p in parts]])


# Every step of a name, and every call, is a message to the JVM, which shows in work that follows each micro-batch.
@lru_cache(maxsize=16)
def _java_class(jvm, name: str):
    found = jvm
    for part in name.split("."):
        found = getattr(found, part)
    return found


def hadoop_path(spark: SparkSession, path: str):
    return _java_class(spark._jvm, "org.apache.hadoop.fs.Path")(path)


def file_system(spark: SparkSession, path: str):
    """The file system, of any kind that Spark reads, that a path is on."""
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(hadoop_path(spark, path))


def stored_bytes(spark: SparkSession, paths: Sequence[str]) -> dict[str, int]:
    """Bytes of the files below each path that there is; all are on one file system."""
    found = {}
    for path in paths:
        at = hadoop_path(spark, path)
        files = file_system(spark, path) if path is paths[0] else files
        if files.exists(at):
            found[path] = files.getContentSummary(at).getLength()
    return found


def numbered_folders(spark: SparkSession, folder: str, prefix: str) -> list[tuple[str, int]]:
    """The folders ``<prefix><number>`` in ``folder``."""
    files, at = file_system(spark, folder), hadoop_path(spark, folder)
    if not files.exists(at):
        return []
    names = [s.getPath().getName() for s in files.listStatus(at)]
    found = [re.fullmatch(rf"{re.escape(prefix)}(-?[0-9]+)", name) for name in names]
    return [(f"{folder}/{m[0]}", int(m[1])) for m in found if m]
