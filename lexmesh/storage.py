"""Reading driver tables and cutting lineage through tables in shared storage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once an application.

    Functions that run in workers are pickled by reference to their module, and a
    worker need not have the package on its path.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(root):
        return  # already imported from an archive
    folder = tempfile.mkdtemp(prefix="lexmesh-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = f"{folder}/lexmesh_package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for base, _, files in sorted(os.walk(root)):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(base, name)
                    archive.write(path, os.path.join("lexmesh", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(target)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``, deleted when the driver ends.

    The setting is read from the session. Where it is unset, a session within one
    machine (tests) gets a temporary folder; a cluster's session is an error, since its
    executors share no such folder.
    """
    ship_package(spark)
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        base = spark.conf.get("spark.checkpoint.dir", None) or _context_dir(spark)
        if not base and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not base:
            base = tempfile.mkdtemp(prefix="lexmesh-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
        _OWN[app] = f"{base.rstrip('/')}/lexmesh-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_clear, spark, _OWN[app])
    return _OWN[app]


def _clear(spark: SparkSession, path: str) -> None:
    """Delete a folder at the driver's end, if its session still lives."""
    try:
        if spark.sparkContext._jsc is not None:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session is gone; the folder stays for its owner to clear
        pass


def _context_dir(spark: SparkSession) -> str | None:
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    return found.get() if found.isDefined() else None


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage without depending on any executor's local disk, keeps exact
    sizes for Catalyst's join choices and answers counts from footers.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized frame that nothing needs any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for name in {os.path.dirname(f) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        if scratch_dir(spark).rpartition("/")[2] in name:
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def empty_like(df: DataFrame) -> DataFrame:
    return df.filter(F.lit(False))
