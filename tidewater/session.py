"""Session for local runs, and the shared folder that iterative jobs write to."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tidewater", cpus: int | None = None, partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings its own."""
    cpus = cpus or os.cpu_count() or 4
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    ship_package(session)
    return session


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for each application, wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    target = Path(tempfile.mkdtemp(prefix="tidewater-")) / "tidewater.zip"  # Spark copies it to every executor
    target.write_bytes(held.getvalue())
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local folder would lose data with its executor, so that is refused.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
        elif sc.master.startswith("local"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidewater-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


TASK_ROWS = 1_000_000  # rows whose groups one task holds


def by_rows(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> int:
    """Partitions of at most about `task_rows` rows, one for each core at least; adaptive execution leaves them as they are."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // task_rows))
