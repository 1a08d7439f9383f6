"""Session construction and the shared scratch folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; it
is read from the session and never replaced.  Only when the setting is absent
(local runs, tests) is a private folder created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(cores: int | str = "*", shuffle_partitions: int | None = None,
              app_name: str = "tessera") -> SparkSession:
    """Local session with the settings the engine expects (tests, bench).

    AQE is on so that shuffle partitions coalesce and skewed join partitions
    split at run time; the UI stays off.
    """
    parts = shuffle_partitions or (8 if cores == "*" else int(cores))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering a private one only if unset."""
    registered = spark.sparkContext.getCheckpointDir()
    if registered:
        return registered
    current = spark.conf.get(_CHECKPOINT_KEY, None)
    if not current:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique path under the shared checkpoint folder; what is written
    there is deleted when the application ends."""
    parent = os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), f"{name}-{uuid.uuid4().hex}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return os.path.join(parent, name)


def local_path(path: str) -> str:
    """A ``file:`` URI as a plain path for Python file IO (other schemes unchanged)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in the Python workers (once per application).

    Pandas UDFs and ``mapInPandas`` functions defined in this package are
    pickled by reference; the executors import them, so the package is zipped
    on the driver and distributed with ``SparkContext.addPyFile``.
    """
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    import tessera
    root = os.path.dirname(os.path.dirname(os.path.abspath(tessera.__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-py-"), "tessera.zip")
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(os.path.join(root, "tessera")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
