"""Session helpers: settings the jobs rely on and the shared folder for checkpoints."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", app: str = "caudal", **conf: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else one beside the warehouse's tables."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stage"


def work_dir(spark: SparkSession) -> str:
    """A new folder in the shared one, which goes when the session ends."""
    name = f"{shared_dir(spark)}/work-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return name


def remove(spark: SparkSession, name: str) -> None:
    """Delete a folder, wherever it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several later jobs read."""
    context = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, whose functions run in their Python workers; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    name = f"{shared_dir(spark)}/caudal-{uuid.uuid4().hex}.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(path)
    stream.write(bytearray(archive.getvalue()))
    stream.close()
    system.deleteOnExit(path)
    context.addPyFile(name)
    _shipped.add(context.applicationId)
