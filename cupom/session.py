"""Session helpers: one place for the Spark settings this library relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Performance settings applied to any session the library runs on (they change plans, not results).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A whole-stage method above the JVM's 8000-byte JIT limit runs interpreted (measured 2× slower
    # on the nested-record coercions); such stages fall back to per-operator codegen instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Only for sessions the library creates itself (tests, bench). Writes pass the overwrite mode
# per call, and every time conversion works on timezone-free types, so a caller's session keeps
# its own settings for these.
_OWN_SESSION = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app_name: str = "cupom", **conf: str) -> SparkSession:
    """Create (or reuse) a session with the library defaults; used by tests and bench."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in {**_DEFAULTS, **_OWN_SESSION, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> None:
    """Apply the library's runtime SQL settings to an existing session."""
    settings = dict(_DEFAULTS)
    # Partition discovery lists many directories with a Spark job of up to this many tasks (Spark's
    # default is 10000, i.e. one task per directory for a daily layout); a few tasks per core list
    # the same directories without the per-task overhead (measured 8 s → 1-2 s for 2500 days).
    try:
        cores = spark.sparkContext.defaultParallelism
        settings["spark.sql.sources.parallelPartitionDiscovery.parallelism"] = str(max(16, 2 * cores))
    except Exception:  # no SparkContext view (e.g. Spark Connect)
        pass
    for key, value in settings.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static conf on a shared session: keep what the cluster set
            pass


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Unset, it is an error on a cluster, whose nodes share no temporary folder; a session in one process
    (``local[n]``, as in tests) gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        current = tempfile.mkdtemp(prefix="cupom-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint folder for a written intermediate."""
    return os.path.join(checkpoint_root(spark), "cupom", f"{name}-{uuid.uuid4().hex}")


@contextmanager
def conf_override(spark: SparkSession, settings: dict[str, str]):
    """Set SQL settings for the jobs run inside the block, then restore the caller's values."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# For partitioned writes: AQE may still split a hot partition (rebalance), but must not coalesce
# many small partitions into one task that then creates every file serially (measured 5× slower).
WRITE_SETTINGS = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1"}
