"""Python workers import this package; Spark takes it to them."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import stratum

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once per application.

    The archive is made on the driver and served by Spark, so executors need
    neither the driver's folders nor its PYTHONPATH.
    """
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    top = Path(stratum.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="stratum-")) / "stratum_package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(path))
    _sent.add(sc.applicationId)
