"""Session helpers.

On a cluster the session is built by whoever submits the job; these helpers
only fill in what is missing, and never override a setting the cluster made.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the jobs want. Runtime SQL confs only, so they can be applied to a
# session somebody else built. The jobs' results need the UTC timezone: whoever
# sets another one gets days and hours of that zone.
_RUNTIME_CONF = {
    # Timestamps in the tables are naive; pin UTC so casts between
    # TIMESTAMP_NTZ and TIMESTAMP never shift a value.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming session windows: merge each partition's sessions before the
    # shuffle (a map-side combine), so a user with a third of a micro-batch
    # ships a few sessions per task instead of all its events.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Rows with long arrays or texts reach Python in batches of bounded size.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the session leaves unset and make sure a
    checkpoint directory exists.  Idempotent and cheap; called by every table
    read."""
    made = spark.conf.getAll
    for key, value in _RUNTIME_CONF.items():
        if key not in made:
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir``, or a directory already set
    on the context).  Only when neither is set -- local runs and tests -- a
    scratch folder is made; a cluster always names a shared one.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidewater-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for a written intermediate."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewater") -> SparkSession:
    """A local session for tests, the bench and the command line."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
