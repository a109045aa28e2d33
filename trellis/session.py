"""Session settings that the queries assume."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "trellis", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as a zip that Spark distributes."""
    context = spark.sparkContext
    if getattr(context, "_trellis_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="trellis-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/trellis_code.zip", "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, str(path.relative_to(root.parent)))
    context.addPyFile(f"{folder}/trellis_code.zip")
    context._trellis_shipped = True
