"""Session settings and the shared working folder.

Every job assumes UTC, text-typed partition values and AQE.  The only
place that creates a session is :func:`build_session`; library code
receives a session and never changes its global settings, except that
:func:`shared_dir` falls back to a private checkpoint folder when the
cluster names none (local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that the jobs rely on.  Values are strings because that is
# how SparkConf stores them.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # `id=0001` and `id=null` must stay text in partition discovery.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Delete checkpoint files (batch numbering) once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "seqlake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`JOB_CONF` applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(JOB_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and is visible to every
    executor.  Only when it is unset (local runs, tests) a private folder
    is made and registered, so later ``checkpoint()`` calls work too.
    """
    try:
        sc = spark.sparkContext
    except Exception:        # remote client: only the session setting is visible
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return named
    current = sc.getCheckpointDir()
    if current:
        # Spark appends a random sub-folder per context; use its parent.
        return current.rsplit("/", 1)[0] if "/" in current else current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="seqlake-ckpt-")
    sc.setCheckpointDir(named)
    return named


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/seqlake/{name}-{uuid.uuid4().hex[:12]}"


_sent: dict[str, tempfile.TemporaryDirectory] = {}


def send_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application:
    functions that run inside tasks (copies, listings) are imported there.
    Spark serves the archive itself; no shared folder is needed."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    root = Path(__file__).resolve().parent
    tmp = tempfile.TemporaryDirectory(prefix="seqlake-package-")
    archive = Path(tmp.name) / f"seqlake-tasks-{sc.applicationId}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _sent[sc.applicationId] = tmp
