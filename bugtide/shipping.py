"""Make this package importable in Python tasks."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's source to the workers, once per application.

    Called by the steps that run Python in tasks, so that they also work where
    the package is installed on the driver alone.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="bugtide-")) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(_PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
