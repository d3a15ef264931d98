"""Session-level helpers: shared folders for checkpoints and scratch output.

Library code never sets ``master``, memory or partition counts; those belong
to whoever builds the session. The only thing read here is where shared,
fault-tolerant storage lives (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_base(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    Uses ``spark.checkpoint.dir`` from the session. Only when that is unset
    *and* the session is local (tests, the bench) is a private temporary
    folder created; a cluster without the setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # SparkContext appends a random sub-folder to the configured one.
        return os.path.dirname(current.rstrip("/"))
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, object store) before running jobs that cut lineage"
        )
    base = tempfile.mkdtemp(prefix="verso-ckpt-")
    sc.setCheckpointDir(base)
    return base


_scratch_roots: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint base. All of a
    session's scratch is in one folder, which is deleted when the session's
    JVM ends."""
    app = spark.sparkContext.applicationId
    if app not in _scratch_roots:
        root = f"{checkpoint_base(spark)}/verso-scratch-{app}-{uuid.uuid4().hex[:8]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _scratch_roots[app] = root
    return f"{_scratch_roots[app]}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where a plan would otherwise evaluate a non-deterministic
    expression twice (e.g. ids assigned after a sort).
    """
    checkpoint_base(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Deal rows round-robin if the input has few splits (a file with one row
    group would run every row-local step in a single task). For row-local
    steps only: it changes no result. A large input already has many splits
    and is left alone."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= target else df.repartition(target)
