"""Session helpers: shared folders and recommended settings."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job wants; they are applied only where the session leaves them unset.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and written tables.

    Reads ``spark.checkpoint.dir`` from the session. Only a local session may leave it
    unset: then a fresh local folder is made and registered, and removed when Python
    ends. On a cluster an unset folder is an error, as executors would each write to
    their own disk.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            base = None
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quarry-ckpt-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        sc.setCheckpointDir(base)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def is_local(master: str) -> bool:
    """Whether executors run inside the driver (``local``, ``local[n]``)."""
    return master == "local" or master.startswith("local[")


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below :func:`shared_root`; ``unique`` adds a fresh run folder."""
    segs = [shared_root(spark), "quarry"]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    segs.extend(parts)
    return "/".join(segs)


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark
