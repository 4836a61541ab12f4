"""Session builder with the settings the engine relies on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Needed for right results: UTC timestamps and last-wins duplicate tag keys.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

#: Performance defaults; a cluster's own settings win.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", app: str = "urbanframe") -> SparkSession:
    """A local session for tests and benchmarks."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in (REQUIRED | DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": memory}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each application, wherever the driver was started."""
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    if getattr(context, "_urbanframe_sent", False):
        return
    archive = Path(tempfile.mkdtemp()) / "urbanframe.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._urbanframe_sent = True
