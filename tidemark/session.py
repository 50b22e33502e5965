"""SparkSession defaults and the shared scratch folder.

Everything here is configuration; no data passes through the driver.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library wants. AQE re-plans joins from real
# shuffle sizes (runtime broadcast, skew splitting, partition coalescing),
# which is what keeps the merge and history joins healthy when one key is hot.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster ``master`` stays ``None`` so the launcher decides; tests pass
    ``local[*]``. The web UI is off: nothing here needs a listening port.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only a local session
    (one JVM, as in tests) may leave it unset and gets a private folder; on a
    cluster each executor would write its own disk, so that is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged writes.

    Staged tables, file feeds and streaming checkpoints live there, never in a
    machine-local temp folder, so a lost executor or a new driver sees them.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def drop_shared(spark: SparkSession, path: str) -> None:
    """Delete a staged folder of :func:`shared_dir`; anything outside that folder is refused."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not path.startswith(base + "/") or ".." in path:
        raise ValueError(f"{path} is not below {base}")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme for Python-side listing in tests."""
    if uri.startswith("file:"):
        uri = uri[len("file:"):]
        while uri.startswith("//"):
            uri = uri[1:]
    return os.path.abspath(uri)
