"""Spark session defaults and the shared scratch folder.

Every job in this package is a DataFrame-in, DataFrame-out function; this
module holds the only session-level decisions:

* UTC session time zone, ANSI mode left on (malformed input is handled with
  ``try_*`` functions, never by switching ANSI off);
* adaptive execution with skew-join splitting and partition coalescing;
* no Spark UI;
* a scratch root taken from ``spark.checkpoint.dir``.  On a cluster that
  setting must name a shared folder; without it a job stops with an error.
  Only on a local master do we create one under the system temporary folder
  and register it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Added for cluster runs: streaming state (watermarked de-duplication, the
# state-store variant of the window rule) kept in RocksDB off the JVM heap,
# and writes clustered to ~128 MB files.  Locally the in-memory store is
# faster for small state, so tests and the bench keep the defaults above.
CLUSTER_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(master: str | None = None, app_name: str = "campaignlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, profile: str = "local") -> SparkSession:
    """Create (or reuse) a session with the package defaults
    (``profile="cluster"`` adds ``CLUSTER_DEFAULTS``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if profile == "cluster":
        conf.update(CLUSTER_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  If
    neither is set -- tests and local runs only -- create one and register it
    so that ``DataFrame.checkpoint()`` uses the same place.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {sc.master}")
        root = tempfile.mkdtemp(prefix="campaignlake-")
        sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the scratch root (never reused)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _fs_path(spark: SparkSession, path: str):
    """Hadoop ``Path`` and its ``FileSystem`` (local, HDFS or object store),
    through the session's Hadoop configuration."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists."""
    p, fs = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` (a partition folder); True if it existed."""
    p, fs = _fs_path(spark, path)
    return bool(fs.delete(p, True))


def rename_path(spark: SparkSession, src: str, dst: str) -> None:
    """Move a file or folder; the parent of ``dst`` is created.  An error if it
    cannot be moved (for example because ``dst`` exists)."""
    p, fs = _fs_path(spark, src)
    q, _ = _fs_path(spark, dst)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"cannot move {src} to {dst}")


def list_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> list[str]:
    """Files below ``path`` with this suffix, as paths relative to it, sorted;
    folders whose name starts with '_' or '.' are left out."""
    p, fs = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    root = fs.getFileStatus(p).getPath().toString().rstrip("/")
    found, todo = fs.listFiles(p, True), []
    while found.hasNext():
        f = found.next().getPath().toString()[len(root) + 1:]
        if f.endswith(suffix) and not any(x[0] in "_." for x in f.split("/")):
            todo.append(f)
    return sorted(todo)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in ``path``."""
    p, fs = _fs_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def write_note(spark: SparkSession, path: str, lines: list[str]) -> None:
    """Small text file (a journal entry), complete when it has its name."""
    p, fs = _fs_path(spark, path + ".tmp")
    out = fs.create(p, True)
    out.write(bytearray("\n".join(lines).encode()))
    out.close()
    delete_path(spark, path)
    rename_path(spark, path + ".tmp", path)


def read_note(spark: SparkSession, path: str) -> list[str] | None:
    """Lines of a journal entry, or None if there is none."""
    return [r[0] for r in spark.read.text(path).collect()] if path_exists(spark, path) else None
