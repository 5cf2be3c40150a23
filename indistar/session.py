"""Session helpers: defaults that matter at scale, and the shared work folder.

Nothing here overrides a setting the cluster already made: every default is
applied only where the key is unset, so a production session keeps its own
shuffle sizing, checkpoint folder and AQE tuning.
"""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults for a session this library creates itself (tests, bench, local
# runs). Sizes are per-partition targets, so they hold from 1 GB to 100 TB:
# AQE coalesces small shuffle partitions and splits skewed ones at runtime.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Wide projections (34 text columns) generate one method per stage; above
    # ~8 KB of bytecode the JVM will not JIT it, so fall back to per-operator
    # code generation there instead of running interpreted bytecode.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Row counts and column statistics of catalogued tables, where there are any, guide joins.
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.planStats.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


#: Of these, what a running session also gets where it has no value of its own: it changes no result.
RUNTIME_DEFAULTS = ("spark.sql.codegen.hugeMethodLimit",)


def fill_runtime_defaults(spark: SparkSession) -> None:
    """Give a session that was made elsewhere :data:`RUNTIME_DEFAULTS`; a value that it has stays."""
    for key in RUNTIME_DEFAULTS:
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, SESSION_DEFAULTS[key])


#: Spark 4.1: an action's shuffle files go when it ends. Without it, and in earlier versions, they stay until the driver
#: collects the plan as garbage, which a long job with much free heap may never do.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """In it, no action leaves its shuffles on the executors' disks for the next one.

    For code that writes every table it reads twice: a DataFrame that is run a second time would shuffle anew.
    A session that has a value of its own keeps it, and of nested uses the outermost counts.
    """
    if spark.conf.get(FREE_SHUFFLES, None) is not None:
        yield
        return
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES)


def frees_shuffles(f: Callable) -> Callable:
    """``f(spark, ...)`` within :func:`freed_shuffles`."""
    @functools.wraps(f)
    def within(spark: SparkSession, *args, **kwargs):
        with freed_shuffles(spark):
            return f(spark, *args, **kwargs)
    return within


def get_spark(master: str | None = None, app_name: str = "indistar",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None,
              driver_memory: str | None = "16g") -> SparkSession:
    """Return the active session or build one with :data:`SESSION_DEFAULTS`.

    An already-running session is returned as it is, so cluster-level configuration always wins.
    """
    active = SparkSession.getActiveSession()
    if active is None:
        builder = SparkSession.builder.appName(app_name)
        if master:
            builder = builder.master(master)
        conf = dict(SESSION_DEFAULTS)
        if shuffle_partitions is not None:
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        if driver_memory and master and master.startswith("local"):
            # local mode runs every task in the driver JVM
            conf["spark.driver.memory"] = driver_memory
        conf.update(extra or {})
        for key, value in conf.items():
            builder = builder.config(key, value)
        active = builder.getOrCreate()
        active.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(active)
    return active


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for written intermediates.

    The session's own checkpoint folder comes first, then ``spark.checkpoint.dir``. A
    machine-local scratch folder is made only where neither is set and the master is local
    (tests, local runs); on a cluster that raises, as executors would not share it.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="indistar-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the shared checkpoint folder for written tables.

    Jobs that must write intermediate tables (landing, upserts, publishing
    in the self-checking queries) write here, so the data survives the loss
    of any executor and is visible to every node.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = name or "work"
    return f"{root}/{leaf}-{uuid.uuid4().hex[:12]}"


def env_or(name: str, default: str) -> str:
    value = os.environ.get(name)
    return value if value else default
