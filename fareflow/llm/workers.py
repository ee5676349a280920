"""Makes this package importable in the Python workers of a session that was made elsewhere."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Let Spark send the package to its workers, unless their path holds it already."""
    sc = spark.sparkContext
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if sc.applicationId in _sent or _ROOT in map(os.path.abspath, filter(None, paths)):
        return
    _sent.add(sc.applicationId)
    folder = tempfile.mkdtemp(prefix="fareflow-package-")
    shutil.copytree(os.path.join(_ROOT, "fareflow"), os.path.join(folder, "tree", "fareflow"),
                    ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "fareflow"), "zip", os.path.join(folder, "tree")))
