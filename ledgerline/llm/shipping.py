"""The package itself, for Python workers that do not have it on their path."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_SENT: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to all executors once per application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app not in _SENT:
        made = Path(tempfile.mkdtemp(prefix="package-")) / PACKAGE.name
        archive = shutil.make_archive(str(made), "zip", PACKAGE.parent, PACKAGE.name)
        spark.sparkContext.addPyFile(archive)
        _SENT.add(app)
