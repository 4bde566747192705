"""Session helpers: UTC time zone, RocksDB state store, checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, app: str = "tsquality",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every operator relies on; safe to call on a foreign session."""
    # All times are UTC; naive strings are read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Small per-bucket / per-meter tables are cached; let AQE size their shuffles too.
    spark.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
    # Texts can be long: bound what one Arrow batch to a Python worker holds, by rows and by bytes.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    ship(spark)
    checkpoint_dir(spark)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the time of a block; the caller's come back after it."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Functions sent to Python workers are pickled by module name, and a worker
    does not see the driver's ``sys.path``."""
    sc = spark.sparkContext
    if getattr(sc, "_tsquality_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tsq-ship-"), "tsquality_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    f = os.path.join(d, n)
                    z.write(f, os.path.relpath(f, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._tsquality_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only with a local master, where every task runs on this machine, a folder
    of our own is made when the setting is absent; elsewhere its absence is an
    error, as executors would each write to their own disk.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tsq-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub folder of the shared checkpoint folder, removed when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tsquality/{name}-{uuid.uuid4().hex[:12]}"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever store it names."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def materialize(df, how: str = "checkpoint"):
    """Reuse an intermediate result in several branches of one plan.

    ``checkpoint`` writes it as a parquet table to the shared checkpoint folder
    and reads it back (reliable: survives lost executors, cuts lineage, one
    job); ``cache`` keeps it in executor memory and disk (recomputed from
    lineage when an executor is lost); ``none`` recomputes. ``localCheckpoint``
    is never used.
    """
    if how == "checkpoint":
        spark = df.sparkSession
        path = scratch_path(spark, "mat")
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    if how == "cache":
        return df.cache()
    return df


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file as a whole, replacing what was there."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder; none if it does not exist."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(hpath) if f.isDirectory()] if fs.exists(hpath) else []
