"""Spark session helpers.

Cluster runs get their session from ``spark-submit``; these helpers only
fill in what is unset, so a cluster's own settings always win.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "jobtally",
    conf: dict[str, str] | None = None,
    event_log_dir: str | None = None,
) -> SparkSession:
    """A session with AQE, UTC and no UI, where nothing else is configured.

    An active session is returned as it is, but for ``conf`` (what the caller
    asks for by name). In a new one, ``conf`` and the arguments hold, and the
    defaults fill only keys that spark-submit or its files leave unset.
    ``shuffle_partitions`` has no default: a cluster's own width stays.
    ``event_log_dir``: write the Spark event log there (input of the
    run-log job); an error on a session that already runs without.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        if event_log_dir and active.sparkContext.getConf().get("spark.eventLog.enabled", "false") != "true":
            raise ValueError("the event log must be configured before the session starts")
        for key, value in (conf or {}).items():
            active.conf.set(key, value)
        ensure_checkpoint_dir(active)
        return active
    asked = dict(conf or {})
    if shuffle_partitions is not None:
        asked["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if event_log_dir:
        asked["spark.eventLog.enabled"] = "true"
        asked["spark.eventLog.dir"] = event_log_dir
    submitted = SparkConf()  # what spark-submit was given, by option or by file
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**{k: v for k, v in _DEFAULTS.items() if not submitted.contains(k)}, **asked}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; we only set our own (a fresh
    scratch folder) when nothing is configured in local mode, as in tests.
    On a cluster an unset value is an error: a machine-local folder would
    not survive the loss of that machine.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="jobtally-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """``values`` hold inside the block; what was set before holds after it."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


#: open writers of a task that writes partitions side by side (twelve months, and what carries no month)
SIDE_BY_SIDE = 32


def side_by_side(spark: SparkSession):
    """Inside the block a write by a partition column keeps a writer open per value, up to ``SIDE_BY_SIDE``.

    Spark else sorts a task's rows by the partition column first, and a task
    with more rows than its memory holds spills all of them.
    """
    return _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(SIDE_BY_SIDE)})


def listed_in_few_tasks(spark: SparkSession):
    """Inside the block, files are listed by a few tasks a core, each for many folders.

    Spark else starts a task per folder or named file (up to 10,000), which
    takes far longer than the listing.
    """
    tasks = 4 * spark.sparkContext.defaultParallelism
    return _settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)})
