"""Spark session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Timestamps are compared and bucketed by day, so
# the session zone must be UTC; AQE re-plans joins (runtime, size-checked
# broadcast) and splits skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "mooclens",
              shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Return (or create) a session with the settings above.

    On a cluster ``master`` stays ``None`` and the launcher decides; locally
    pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir`` (read from the session);
    only when that is unset and the master is local (tests) do we make a scratch
    folder and register it with ``setCheckpointDir``; on a cluster a missing
    setting is an error, since executors would write to their own disks.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="mooclens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path`` (works on cluster storage)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def paths_exist(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or folder matches a pattern."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def escape_partition(spark: SparkSession, value: str) -> str:
    """A value as Spark spells it in a partition folder's name."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


_scopes: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table, in the shared folder; within a ``scratch_scope`` in that scope's folder."""
    base = _scopes[-1] if _scopes else f"{checkpoint_dir(spark)}/mooclens-scratch/{spark.sparkContext.applicationId}"
    return f"{base}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Intermediate tables that are made inside go at the end: for jobs whose output is written by then."""
    path = scratch_path(spark, "job")
    _scopes.append(path)
    try:
        yield
    finally:
        _scopes.remove(path)
        delete_path(spark, path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_end(spark: SparkSession):
    """Shuffle files of a write inside go when it ends: what was written stands in their place.

    Otherwise they stay until the driver happens to collect garbage, which may be after the job.
    """
    old = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, old)


def stored_scratch(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as an intermediate table and read it back: lineage ends there."""
    path = scratch_path(spark, name)
    with shuffles_end(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder that Spark would read (none if it does not exist)."""
    fs, p = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in names if n[0] not in "._")


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target's parent is made, the target must not exist."""
    fs, p = _fs(spark, source)
    _, q = _fs(spark, target)
    fs.mkdirs(q.getParent())
    if fs.exists(q) or not fs.rename(p, q):
        raise OSError(f"could not move {source} to {target}")


def swap_folder(spark: SparkSession, source: str | None, target: str) -> None:
    """Put a finished folder in the place of ``target`` (``None``: only take that away).

    The old folder steps aside under a name that readers skip and goes once the new one stands. A job that dies in between
    leaves it there, and the next swap, or ``settle_folder``, brings it back.
    """
    settle_folder(spark, target)
    parent, _, name = target.rstrip("/").rpartition("/")
    old = f"{parent}/_old-{name}"
    if path_exists(spark, target):
        move_path(spark, target, old)
    if source is not None:
        try:
            move_path(spark, source, target)
        except Exception:
            settle_folder(spark, target)
            raise
    delete_path(spark, old)


def settle_folder(spark: SparkSession, target: str) -> None:
    """Finish a swap that was broken off: the old folder comes back unless the new one stands."""
    parent, _, name = target.rstrip("/").rpartition("/")
    old = f"{parent}/_old-{name}"
    if path_exists(spark, old):
        if path_exists(spark, target):
            delete_path(spark, old)
        else:
            move_path(spark, old, target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written whole or not at all: under another name first, then renamed."""
    fs, _ = _fs(spark, path)
    parent, _, name = path.rpartition("/")
    beside = f"{parent}/_new-{name}-{uuid.uuid4().hex}"
    _, p = _fs(spark, beside)
    out = fs.create(p)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    swap_folder(spark, beside, path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or None."""
    if not path_exists(spark, path):
        return None
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
