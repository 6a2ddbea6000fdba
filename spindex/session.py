"""Session helpers: a configured local session for tests/bench and the
checkpoint folder used to cut lineage."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "spindex",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # the driver's test tables are single row groups: spread them for tokenizing
    conf.setdefault("spark.spindex.collection.partitions", str(4 * shuffle_partitions))
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that is used
    as is. Only a local-mode session without one (tests, bench) gets a fresh
    scratch folder; on a cluster a missing setting is an error, never a
    machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="spindex-ckpt-", dir=os.environ.get("SPINDEX_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder that Spark names ``file:/...``,
    ``hdfs://...``, ``s3://...`` and so on."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{os.path.abspath(uri)}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``spindex`` importable in local-mode Python workers (once per
    context): the package is zipped and added with ``addPyFile``. On a
    cluster the package is shipped the usual way (``--py-files`` or an
    installed wheel), so nothing is written to a machine-local folder."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED or not sc.master.startswith("local"):
        return
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="spindex-pkg-")
    staging = os.path.join(out, "src")
    shutil.copytree(pkg, os.path.join(staging, "spindex"), ignore=shutil.ignore_patterns("__pycache__", "*.pyc"))
    archive = shutil.make_archive(os.path.join(out, "spindex"), "zip", staging)
    sc.addPyFile(archive)
    _SHIPPED.add(key)
