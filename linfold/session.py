"""Spark session helpers and the shared scratch folder.

On a cluster the scratch folder is the one named by ``spark.checkpoint.dir`` (a shared
file system every executor can reach). Only when that setting is missing -- local runs
and tests -- do we create a folder of our own and register it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app_name: str = "linfold",
              conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or an already registered checkpoint
    folder); a temporary folder is created only when neither is set.
    """
    sc = _context(spark)
    if sc is None:   # Spark Connect: the server-side setting is the only source
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach; "
                               "a machine-local temporary folder does not work on a cluster.")
        configured = tempfile.mkdtemp(prefix="linfold-ckpt-")   # local runs and tests only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, how: str = "persist") -> DataFrame:
    """Keep ``df`` for repeated passes.

    ``persist``: MEMORY_AND_DISK cache; a lost executor recomputes its partitions from
    lineage. ``checkpoint``: written to the shared checkpoint folder with the lineage cut,
    so a lost executor re-reads instead of recomputing (for long iterative jobs).
    ``none``: leave as is.
    """
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "none":
        return df
    raise ValueError("how must be 'persist', 'checkpoint' or 'none'.")


_SHIPPED: set[str] = set()
_ZIP: list[str] = []


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session (which has none)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 -- Connect raises on sparkContext
        return None


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return max(1, sc.defaultParallelism)
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))


def ship_package(spark: SparkSession) -> None:
    """Make ``linfold`` importable in the executors' Python workers (the Arrow kernels live
    in it): zip the package once per process and ``addPyFile`` it once per application
    (``addArtifacts`` on Spark Connect). Spark distributes the file itself, so no shared
    folder is involved."""
    sc = _context(spark)
    app = sc.applicationId if sc is not None else f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    if not _ZIP:
        import zipfile

        import linfold
        package = os.path.dirname(os.path.abspath(linfold.__file__))
        root = os.path.dirname(package)
        fd, path = tempfile.mkstemp(prefix="linfold-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(path, "w") as archive:
            for dirpath, _, files in os.walk(package):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(dirpath, name)
                        archive.write(full, os.path.relpath(full, root))
        _ZIP.append(path)
    if sc is not None:
        sc.addPyFile(_ZIP[0])
    else:
        spark.addArtifacts(_ZIP[0], pyfile=True)
    _SHIPPED.add(app)
