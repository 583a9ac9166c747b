"""Make this package importable in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{root.name}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _shipped[context.applicationId] = path
