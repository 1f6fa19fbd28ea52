"""The folder that driver and executors share, and the package on the Python workers."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir; where it is unset one of our own, in a local session alone."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="gondola-"))
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the driver ends."""
    name = f"{shared_dir(spark)}/gondola-{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return name


def materialise(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts the lineage, fixes row ids, survives lost executors.

    zstd is for wide binary columns: its buffers lie outside the heap, and many small writes pile them up.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """df dealt to as many tasks as a shuffle has, by columns of many values."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application: they may not have it on their path."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="gondola-code-")) / "gondola.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(root.rglob("*.py")):
                z.write(file, file.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(app)
