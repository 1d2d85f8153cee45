"""Session helpers: local sessions for tests/bench and the checkpoint folder."""

from __future__ import annotations

import tempfile
import threading
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tripwise") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, registered as checkpoint folder.

    On a cluster the deployment must set it (a folder every executor can reach);
    without it this raises.  A local session, as in tests, shares its machine's
    folders, so there an unset key means a fresh temporary folder.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tripwise-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, wherever they run (once a session, from whichever thread)."""
    sc = spark.sparkContext
    # Spark refuses a second file of the same name, so fits started together must not both add it
    with _SHIPPING:
        if sc.applicationId in _SHIPPED:
            return
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="tripwise-ship-")) / "tripwise-core.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f"{root.name}/{f.relative_to(root)}")
        sc.addPyFile(str(archive))
        _SHIPPED.add(sc.applicationId)
