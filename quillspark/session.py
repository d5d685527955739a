"""Session factory with the settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.showConsoleProgress": "false",
}


def make_session(master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; on a cluster the master comes from the submit command."""
    builder = SparkSession.builder.config(map=SETTINGS | extra)
    return (builder.master(master) if master else builder).getOrCreate()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, where their path doesn't have it already."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or root in map(os.path.abspath, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="quillspark-"), "quillspark.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(os.path.join(root, "quillspark")):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
