"""Getting this package to the Python workers of a cluster."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parents[2]
_PACKAGE = __package__.partition(".")[0]
_shipped: set[str] = set()


def packed(folder: str) -> str:
    """The package's modules as a zip file in a folder."""
    path = f"{folder}/{_PACKAGE}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for module in sorted((_ROOT / _PACKAGE).rglob("*.py")):
            out.write(module, module.relative_to(_ROOT))
    return path


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package; done once for each Spark application.

    Workers on the driver's machine find it where the driver has it. Other
    machines get its modules from Spark, as a zip of some 100 kB. Where the
    package is installed on every machine, neither does harm.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped or not _ROOT.is_dir():
        return
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if str(_ROOT) not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), str(_ROOT)])
    if not re.match(r"local(\[|$)", context.master):
        # Spark serves the file to its executors; nothing else reads this folder.
        context.addPyFile(packed(tempfile.mkdtemp(prefix="stationkit-")))
    _shipped.add(context.applicationId)
