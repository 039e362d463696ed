"""Session settings the plans here are made for."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    # Partition counts, skewed joins and broadcasts are decided from measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet is several times larger in memory than on disk; without this a table of
    # ten megabytes on disk would be broadcast.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # The rank limit below the shuffle keeps as-of reads safe from large ids.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.session.timeZone": "UTC",
}


def build(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the session's setting, or one for local runs.

    On a cluster the setting must name storage every executor reaches, so nothing is
    made up there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", named)
    spark.sparkContext.setCheckpointDir(named)
    return named


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Python functions in plans refer to it, and workers see the driver's folders only by chance.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
