"""A session with the settings that the engine expects, and the package for its workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import SparkSession

#: Size of the batches that go to Python workers, as Spark has it and as it becomes unless it was set otherwise: texts are long.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}
_shipped: set[str] = set()
_own_dir: dict[str, str] = {}


def builder(app: str = "furrow") -> SparkSession.Builder:
    """UTC, adaptive execution with skew handling; sizes are left to the cluster's settings."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )


def ship(spark: SparkSession) -> None:
    """Give this package to Python workers, once for each application: they need not have it installed. Their batches are kept small."""
    for key, (usual, small) in BATCHES.items():
        if spark.conf.get(key, usual) == usual:
            spark.conf.set(key, small)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="furrow-")) / "furrow.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted([*root.rglob("*.py"), *root.rglob("*.tsv"), *root.rglob("*.json")]):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or a local one where that is unset and the driver is the only machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        key = spark.sparkContext.applicationId
        path = _own_dir.setdefault(key, _own_dir.get(key) or tempfile.mkdtemp(prefix="furrow-"))
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used, below a folder of the application."""
    return f"{shared_dir(spark)}/furrow-{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"
