"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every job in this package. AQE re-plans joins at
# runtime (broadcast conversion, skew splitting, partition coalescing).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "shelfwise", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the session the platform gives."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``shelfwise`` importable in Python workers (pandas steps) by
    shipping it with ``addPyFile``, once per SparkContext."""
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    import os
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="shelfwise-py-"), "shelfwise.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we only
    read it. Only a local-mode session without one (tests, laptops) gets a
    fresh temporary folder; a cluster session without one is an error,
    because a machine-local folder does not survive executor loss.
    """
    ship_package(spark)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) before running iterative estimators")
        named = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def hadoop_path(spark: SparkSession, path: str):
    """(path, file system) for what Spark's readers and writers don't do."""
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(sc._jsc.hadoopConfiguration())
