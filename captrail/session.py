"""Sessions and the shipping of this package to Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
#: Rows of a batch between Spark and Python workers: texts and records are large, so Spark's default would hold too much.
BATCH_ROWS, SPARK_DEFAULT = "1000", "10000"


def ship(spark: SparkSession) -> None:
    """Gives Python workers this package, as --py-files would: they need not share the driver's folders or search path.

    From then on batches have BATCH_ROWS rows in the whole session, unless it has chosen a number of its own."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", SPARK_DEFAULT) == SPARK_DEFAULT:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), "captrail.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def local_session(cores: int = 8, partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("captrail").config("spark.sql.shuffle.partitions", partitions)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    for k, v in (fixed | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()
