"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# ANSI keeps strict casts strict; UTC keeps dates independent of the host.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # call-site capture for error messages costs more than building the plans themselves
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def build_session(master: str | None = None, **extra: str) -> SparkSession:
    """Session with the library's settings; ``master`` is left to spark-submit on a cluster."""
    builder = SparkSession.builder.appName("salesmart")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, so that its Python stages run wherever the driver was
    started. ``spark-submit --py-files`` with a zip of the package does the same."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # executors fetch the file from the driver when they start, so it stays until the program ends
    folder = tempfile.TemporaryDirectory(prefix="salesmart-package-")
    archive = os.path.join(folder.name, "salesmart.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for place, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(place, name)
                out.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED[application] = folder


_LOCAL: list[tempfile.TemporaryDirectory] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a master in this very process may fall back to a temporary folder, which ends with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.TemporaryDirectory(prefix="salesmart-local-", ignore_cleanup_errors=True))
    return _LOCAL[0].name


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a fresh folder below the shared one; nothing is ever reused or cleared."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that belongs to the caller, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
