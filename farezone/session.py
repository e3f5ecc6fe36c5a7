"""SparkSession helper for tests, the bench and local runs.

On a cluster the session comes from the platform; only settings that are unset
are filled in here, so cluster choices (shuffle partitions, checkpoint folder)
always win.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Defaults for a run; AQE coalesces shuffle partitions to the data actually seen
# and splits skewed join partitions, so the static partition count is an upper bound.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # without a record of the Python line of every Column call, which costs more than the calls
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "farezone",
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The session's shared checkpoint folder, if any (``spark.checkpoint.dir``
    or one set on the SparkContext)."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Use the session's checkpoint folder; set one only where it is unset
    (local tests), in a fresh scratch folder."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder is not visible to other executors
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        d = default or tempfile.mkdtemp(prefix="farezone-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d
