"""Sending the package's code to the workers that run its Python functions."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send the package's code to the workers, once per application, wherever it is imported from."""
    context = spark.sparkContext
    if _SHIPPED.get("application") == context.applicationId:
        return
    package = Path(__file__).resolve().parents[1]
    # The context keeps the archive under this name until it stops; it holds code only.
    archive = Path(tempfile.mkdtemp(prefix="opsloom-code-")) / "opsloom_code.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for module in sorted(package.rglob("*.py")):
            target.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED["application"] = context.applicationId
