"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants: adaptive execution (runtime broadcast decisions
# from measured sizes, partition coalescing, skew splitting), UTC dates, no UI.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "setbook",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones anyway).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # Connect sessions have no SparkContext
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (None when unset)."""
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, creating a scratch one only in local mode.

    On a cluster the folder must be shared storage configured by the
    platform (``spark.checkpoint.dir``); a machine-local temp folder would
    not survive executor loss, so we refuse to invent one there.
    """
    sc = _context(spark)
    d = checkpoint_dir(spark)
    if d:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for the cluster")
    d = tempfile.mkdtemp(prefix="setbook-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None:
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    spark.conf.set("spark.checkpoint.dir", d)
    return d


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have the file system delete ``path`` when the application's JVM ends."""
    sc = _context(spark)
    if sc is not None:
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(target)


def delete_now(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and what is below it; nothing may read it any more."""
    sc = _context(spark)
    if sc is not None:
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
