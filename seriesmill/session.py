"""Making the package known to Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the application's Python workers, once; nothing is sent where PYTHONPATH already names it."""
    root, context = Path(__file__).resolve().parents[1], spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _shipped:
        return
    target = Path(tempfile.mkdtemp(prefix="seriesmill-")) / "seriesmill.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted((root / "seriesmill").rglob("*.py")):
            archive.write(file, file.relative_to(root))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)
