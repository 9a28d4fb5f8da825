"""Session factory with the settings the operators are planned for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster pass no master and submit as usual.

    AQE stays on: it coalesces small shuffle partitions and splits skewed join partitions.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName("corpusmill")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.driver.memory", os.environ.get("CORPUSMILL_DRIVER_MEMORY", "6g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once a Spark application; needed where they don't have it installed."""
    import tempfile
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_corpusmill_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="corpusmill-")) / "corpusmill.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*")):
            if file.suffix in {".py", ".json", ".csv", ".txt"}:
                out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._corpusmill_shipped = True
