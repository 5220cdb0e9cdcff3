"""Session helpers: a local session for tests and the shared scratch folder.

Everything that has to be written during a job (landed files, bronze and silver
tables built by the registered queries, stream checkpoints) goes below the folder
named by ``spark.checkpoint.dir``. On a cluster that setting points at shared
storage; we only choose one ourselves when the session has none (local tests).
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "layerflow") -> SparkSession:
    """A local-mode session configured the way the library expects (UTC, AQE, no UI)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide checkpoint folder, as a URI or path.

    Read from the session (``spark.checkpoint.dir`` or a folder already set on
    the context). Only when neither exists, and in local mode only, a fresh folder is
    created and registered as the context's checkpoint folder; on a cluster a
    machine-local folder would not be shared, so the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(_own_scratch())
    return sc.getCheckpointDir()


def _own_scratch() -> str:
    """A folder of this process, removed when it ends (local mode only)."""
    path = tempfile.mkdtemp(prefix="layerflow-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique location below the shared folder for one job's files."""
    base = shared_dir(spark).rstrip("/")
    return "/".join([base, "layerflow", *parts, uuid.uuid4().hex])

