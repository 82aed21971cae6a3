"""Make this package importable in the executors' Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the application's Python files, once (as ``--py-files`` would)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="py-files-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent).as_posix())
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)
