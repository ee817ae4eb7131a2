"""Session settings the library relies on.

Library functions never build their own session: they take the caller's
``SparkSession``.  ``local_session`` exists for tests, the bench and the
driver entry point; ``ensure_checkpoint_dir`` reads the cluster's shared
checkpoint folder and only fills it in when nothing is configured.
"""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes (see README "Session").
REQUIRED_CONF = {
    # epoch seconds -> year must not depend on the machine's zone
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # switch to broadcast when a side turns out small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "ratewise") -> SparkSession:
    """Local session for tests / bench.  UI off, Arrow on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.worker.reuse", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach (HDFS / object store); it is used as is.  Only when it is unset and
    the master is local (tests) a fresh scratch folder is made and registered;
    on any other master the setting is required.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="ratewise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def ship_package(spark: SparkSession) -> None:
    """Make ``ratewise`` importable in the Python workers (pandas UDFs pickle
    references to its functions).  The package is zipped once per
    SparkContext and added with ``addPyFile``, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_ratewise_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    staging = tempfile.mkdtemp(prefix="ratewise-pkg-")
    archive = shutil.make_archive(os.path.join(staging, "ratewise"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="ratewise")
    sc.addPyFile(archive)
    sc._ratewise_shipped = True
