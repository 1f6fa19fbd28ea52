"""Workbooks: sheets of one file are parsed by different tasks, rows are made by Spark as Python makes them."""

from pyspark.sql import functions as F

from gondola.sources import workbook


def test_sheets_of_a_file_are_dealt_to_tasks(spark, tmp_path):
    rows = spark.range(200).select(F.lit("b").alias("book"), F.concat(F.lit("s"), F.col("id") % 20).alias("s"), "id")
    workbook.write_books([workbook.sheet(rows, F.col("book"), 0, F.col("s"), ["id"], hidden=("book",))], f"file://{tmp_path}")
    read = workbook.read_books(spark, f"file://{tmp_path}").withColumn("task", F.spark_partition_id())
    assert read.count() == 220 and read.select("task").distinct().count() > 1


def test_rows_as_python_writes_them(spark):
    cells = [("a & <b> \"c\"", False), ("12.5", True), (None, False), (None, True), ("x\x01y\x0b￾z\n\té", False), ("w" * 40_000, False), ("", False)]
    df = spark.createDataFrame([([{"text": t, "number": n} for t, n in cells],)], "cells array<struct<text:string,number:boolean>>")
    want = "".join(workbook._cell({"text": t, "number": n}) for t, n in cells)
    assert df.select(workbook._row_xml(F.col("cells"))).first()[0] == f"<row>{want}</row>"
