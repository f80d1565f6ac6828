"""Getting this package to Python workers that do not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]


def ship_code(spark: SparkSession) -> SparkSession:
    """Send the package's sources to all executors, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if not any(name.endswith(f"{PACKAGE.name}-src.zip") for name in context.listFiles):
        archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{PACKAGE.name}-src.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for source in sorted(PACKAGE.rglob("*.py")):
                out.write(source, source.relative_to(PACKAGE.parent))
        context.addPyFile(str(archive))
    return spark
