"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.functions.keys import uuid5
from gondola.functions.text import sheet_name
from gondola.sources.shared import materialise


def write_tables(path: str, **tables: DataFrame) -> None:
    """Overwrite each table in the order given (parents first)."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def with_uuid_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: uuid5(F.col(c)) for c in columns})


def append_conflicts(conflicts: DataFrame, path: str) -> None:
    conflicts.withColumn("timestamp", F.current_timestamp()).write.mode("append").json(path)


def write_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_report(anomalies: DataFrame, path: str) -> bool:
    """Write an audit's anomalies if there are any."""
    found = not anomalies.isEmpty()
    if found:
        anomalies.write.mode("overwrite").json(path)
    return found


def write_catalogue(rows: DataFrame, *paths: str, order: str = "id") -> None:
    """Export rows as one JSON array to each path: a folder of text parts that are the array when read one after the other.

    Every task writes its own part, an object a line. The first line of all opens the array, the
    others begin with a comma, the last one closes it, so no task holds more than its rows. Rows
    stand by order, equal ones by their text; no rows make an empty array.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    said = rows.select(F.col(order).alias("_order"), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))
    placed = said.repartitionByRange(parts, "_order", "value").sortWithinPartitions("_order", "value")
    # ids say which row is the first and which the last, also among equal rows
    placed = materialise(placed.withColumn("_id", F.monotonically_increasing_id()), "catalogue")
    ends = placed.agg(F.min("_id").alias("first"), F.max("_id").alias("last")).first()
    if ends["first"] is None:
        lines = spark.createDataFrame([("[]",)], "value string")
    else:
        before = F.when(F.col("_id") == ends["first"], F.lit("[")).otherwise(F.lit(","))
        after = F.when(F.col("_id") == ends["last"], F.lit("]")).otherwise(F.lit(""))
        lines = placed.repartitionByRange(parts, "_id").sortWithinPartitions("_id").select(F.concat(before, "value", after).alias("value"))
    for path in paths:
        lines.write.mode("overwrite").text(path)


def write_sheets(rows: DataFrame, group: str, path: str) -> None:
    """One CSV folder a group, named as a sheet would be; with the groups' counts beside them."""
    rows.withColumn("sheet", sheet_name(F.coalesce(group, F.lit("N/D")))).write.mode("overwrite").option("header", True).partitionBy("sheet").csv(f"{path}/sheets")
    rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("header", True).csv(f"{path}/summary")


def write_workbook(path: str, sheets: dict[str, DataFrame]) -> None:
    """One CSV folder a sheet, of any columns (products and codes of a supplier, a subset), in the order given."""
    for name, rows in sheets.items():
        rows.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def wipe(tables: dict[str, DataFrame], path: str) -> None:
    """Empty tables of the same schemas, children first."""
    for name, df in reversed(list(tables.items())):
        df.limit(0).write.mode("overwrite").parquet(f"{path}/{name}")
