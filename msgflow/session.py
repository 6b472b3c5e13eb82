"""Session helpers: shared folder for checkpoints and materialised small frames."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its
    own; on a cluster every executor must see the folder, so it must be named.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="msgflow-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return path


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/msgflow-{spark.sparkContext.applicationId}"


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for one run inside the application's part of the shared folder (never reused)."""
    return f"{_application_dir(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path in the shared folder, for tasks that write files of their own.

    Local or mounted folders, HDFS and object stores, as far as pyarrow is built with them.
    """
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def clean_up(spark: SparkSession) -> None:
    """Delete the tables this application has written for itself. No frame made before may be read later."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a table of the shared folder and read it back.

    Cuts the lineage and survives the loss of executors. Unlike an eager
    checkpoint it runs the plan once, and the files carry row counts and sizes.
    """
    spark = df.sparkSession
    path = run_dir(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def planned_bytes(df: DataFrame) -> int:
    """Bytes that the planner expects of a frame; of a table, those of its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def ship_package(spark: SparkSession) -> str:
    """Give the package to executors that do not have it installed.

    Python functions travel by the name of their module, so workers import it. Writes a zip
    of the package into the shared folder and adds it to the session; returns its path.
    """
    import io
    import pathlib
    import zipfile

    top = pathlib.Path(__file__).resolve().parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent))
    path = f"{run_dir(spark, 'package')}/{top.name}.zip"
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(buffer.getvalue()))
    out.close()
    context.addPyFile(path)
    return path
