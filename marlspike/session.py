"""Session construction and the reliable-checkpoint directory."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def workers_find_package() -> None:
    """Let the Python workers of a session that starts after this import the package from any working folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def build_session(app: str = "marlspike", cores: int | None = None) -> SparkSession:
    """Local session for tests and benchmarks; clusters bring their own session."""
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    workers_find_package()
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("MARLSPIKE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """Directory the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a fresh temporary folder; a cluster
    session without a shared folder is a configuration error, not a default.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    active = sc._jsc.sc().getCheckpointDir()
    if active.isDefined():
        return configured or active.get()
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="marlspike-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, ends the lineage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder name under the shared checkpoint directory."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on any file system that Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def rename(spark: SparkSession, path: str, target: str) -> bool:
    """Move a file or folder; false if the file system refuses, for example because the target is there."""
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, target))
    files = a.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(b.getParent())
    return not files.exists(b) and files.rename(a, b)


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def fingerprint(df: DataFrame) -> str:
    """Digest of the files a table is read from: paths, sizes and times of change. Small per-file rows only."""
    files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    row = files.agg(F.count("*"), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))).first()
    return hashlib.sha1(repr(tuple(row)).encode()).hexdigest()
