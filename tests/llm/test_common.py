"""Pieces that several corpus operators share."""

import random

from pyspark.sql import functions as F

from gondola.llm import common


def test_numbering_keeps_columns_of_its_own_names(spark):
    df = spark.range(1000).select("id", *[F.lit("clash").alias(c) for c in ("_at", "_part", "_before")])
    got = common.numbered(df.repartition(7), "index", "test").collect()
    assert sorted(r["index"] for r in got) == list(range(1000)) and all(r[c] == "clash" for r in got for c in ("_at", "_part", "_before"))


def test_global_index(spark):
    values = [random.Random(1).randrange(50) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = common.with_global_index(df, [F.col("v").desc()], "index").orderBy("index").collect()
    assert [r["v"] for r in got] == sorted(values, reverse=True) and [r["index"] for r in got] == list(range(500))


def test_components_of_stars_chains_and_a_giant(spark):
    edges = [(0, k) for k in range(1, 300)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5001), (5001, 5000), (7, 7)]
    got = {r["node"]: r["component"] for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(300)) and all(got[1000 + k] == 1000 for k in range(61)) and got[5000] == got[5001] == 5000
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
