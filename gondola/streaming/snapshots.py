"""The same merge over arriving files: each micro-batch is upserted into the stored snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gondola.operators.dedup import keep_last
from gondola.operators.merge import upsert


def _read_version(spark: SparkSession, path: str, schema) -> tuple[DataFrame, int]:
    """The newest complete version under path (batch number in the folder's name), or an empty table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    done = [int(n[2:]) for n in found if n.startswith("v=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    if not done:
        return spark.createDataFrame([], schema), -1
    return spark.read.schema(schema).parquet(f"{path}/v={max(done)}"), max(done)


def current(spark: SparkSession, path: str, schema) -> DataFrame:
    return _read_version(spark, path, schema)[0]


def merge_stream(rows: DataFrame, path: str, checkpoint: str, key: str, order: list[str]) -> StreamingQuery:
    """Upsert a stream of rows into versions under path; a batch that is run again writes its version again.

    Runs over what there is and stops; start it again for what comes later.
    """
    spark, schema = rows.sparkSession, rows.schema

    def merge(batch: DataFrame, number: int) -> None:
        stored, version = _read_version(spark, path, schema)
        if version >= number:
            return
        upsert(stored, keep_last(batch, [key], order), key).write.mode("overwrite").parquet(f"{path}/v={number}")

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
