"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on; sizing stays with the cluster's own settings."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str, cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_LOCAL_BASE: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or a local one where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share; a machine-local one would not reach them")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_BASE:
        _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_BASE[app]


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    path = f"{shared_dir(spark)}/reviewlens/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_paths(spark: SparkSession) -> list[str]:
    """The scratch paths handed out and not cleared, in that order."""
    return list(_SCRATCH.get(spark.sparkContext.applicationId, []))


def clear_scratch(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete what this session has written to its scratch paths, or to some of them; returns their number.

    For the end of a job or of a part of it: frames that still read from them can no longer be computed. Only paths that
    ``scratch_path`` handed out are touched. Checkpoints are Spark's own; ``spark.cleaner.referenceTracking.cleanCheckpoints``
    removes those.
    """
    mine = scratch_paths(spark)
    gone = mine if paths is None else [p for p in paths if p in mine]
    _SCRATCH[spark.sparkContext.applicationId] = [p for p in mine if p not in gone]
    for path in gone:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return len(gone)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative jobs cut their lineage with reliable checkpoints."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark) + "/checkpoints")
