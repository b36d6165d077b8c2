"""Session helpers: a tuned local/test session and the shared work folder.

On a cluster the session is supplied by the caller; these helpers only read
its settings.  ``shared_dir`` is the one place that decides where
intermediate tables (checkpoints, round-trip writes) go: the folder named by
``spark.checkpoint.dir``.  Only when a session has none (local runs, tests)
is a private folder created and registered.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session we create gets.  AQE re-plans joins from runtime
# sizes (sort-merge -> broadcast when a side turns out small), coalesces tiny
# shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, partitions: int | None = None,
              app: str = "faultline", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the defaults above.

    ``partitions`` sets ``spark.sql.shuffle.partitions``; on a cluster size it
    to the shuffle volume (roughly 128-256 MB per partition), locally to the
    core count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, registering one if unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; Spark
    registers it at start-up.  Only a local-mode session without one (tests,
    single-machine runs) gets a private folder; on a cluster a missing
    setting is an error, since executors cannot share a machine-local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a client without a SparkContext (Spark Connect): the server owns the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(checkpoints and intermediate tables are written there)")
        configured = tempfile.mkdtemp(prefix="faultline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for a written table."""
    return f"{shared_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
