"""The package goes to the executors with the job, so a cluster needs no installation of it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(), f"{top.name}_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
