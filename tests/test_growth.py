"""Steps whose cost once grew faster than their input, or stayed in one task."""

import re

import pytest
from pyspark.sql import functions as F

from gondola.plans import demo
from gondola.sources import tables


@pytest.mark.parametrize("name", ["titulos", "rotulos"])
def test_texts_are_dealt_to_all_tasks(spark, name):
    rows = demo.table(spark, "/root/testdata/sf0.001", name).withColumn("task", F.spark_partition_id())
    assert rows.select("task").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_the_matchs_texts_are_dealt_to_all_tasks(spark):
    from gondola.operators import match

    products = spark.createDataFrame([(k, f"sku{k}", f"Frango {k} inteiro") for k in range(40)], "id long, sku string, title string").coalesce(1)
    images = spark.createDataFrame([(f"https://a/produto/frango-{k}-inteiro/", f"https://a/{k}.png", k) for k in range(40)], "url string, image_url string, ordinal long").coalesce(1)
    seen = []
    whole = match.materialise
    match.materialise = lambda df, label: seen.append(df.rdd.getNumPartitions()) or whole(df, label)
    try:
        assert match.image_match(products, images).count() == 40
    finally:
        match.materialise = whole
    assert seen and max(seen) > 1


@pytest.mark.parametrize("kind", ["long", "string", "double"])
def test_bounds_are_found_by_halving(spark, kind):
    """Ranges of any number, with a plan and work a row that don't grow with it."""
    made = {"long": lambda k: 3 * k, "string": lambda k: f"k\"{k:05d}'", "double": lambda k: k / 7}[kind]
    for n in (1, 2, 3, 7, 8, 1000):
        lows = [made(k) for k in range(n)]
        keys = [made(0), made(n - 1), None] + [made(k) for k in range(-1 if kind != "string" else 0, n + 2)]
        df = spark.createDataFrame([(k,) for k in keys], f"k {kind}").select("k", tables._at_or_below(F.col("k"), lows, kind).alias("got"))
        assert all(r["got"] == (0 if r["k"] is None else sum(low <= r["k"] for low in lows)) for r in df.collect())
    assert len(df._jdf.queryExecution().analyzed().toString()) < 100_000


def test_the_bands_pairs_are_made_by_many_tasks(spark, tmp_path, monkeypatch):
    """One file of points, with values that many rows have: before, a small table's pairs were one task's work."""
    from gondola.operators import match

    monkeypatch.setattr(match, "RUN_ROWS", 3, raising=False)
    values = [None if k % 11 == 10 else k % 13 * 0.5 for k in range(80)]
    made = spark.createDataFrame([(k, "ab"[k % 2] if k % 7 else None, v) for k, v in enumerate(values)], "p long, g string, v double")
    made.coalesce(1).write.parquet(str(tmp_path / "points"))
    points = spark.read.parquet(str(tmp_path / "points"))
    targets = points.selectExpr("p AS t", "g", "v AS w")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = match.band_join(points, targets, ["g"], F.col("w"), F.col("w") + 1.2, F.col("v"), 1.2).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got[0].asDict().keys() == {"g", "p", "v", "t", "w", "task"} and len({r["task"] for r in got}) > 1
    ok = [k for k in range(80) if k % 7 and values[k] is not None]
    assert sorted((r["p"], r["t"]) for r in got) == [(p, t) for p in ok for t in ok if p % 2 == t % 2 and values[t] < values[p] < values[t] + 1.2]


def test_the_match_broadcasts_no_products(spark):
    """Equal titles make a small file of many rows: before, by its bytes all products were sent to the driver. An id's rows stay as many as they are."""
    from gondola.operators import match

    def broadcasts(node):
        inner = [node.plan()] if "QueryStage" in node.nodeName() else [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else []
        found = [node.metrics().apply("numOutputRows").value()] if node.nodeName() == "BroadcastExchange" else []
        under = inner + [node.children().apply(k) for k in range(node.children().size())]
        return sum((broadcasts(x) for x in under), found)

    n = 3000
    products = spark.createDataFrame([(k // 2, f"sku{k // 2}", f"Frango inteiro {k // 2 % 2}") for k in range(2 * n)], "id long, sku string, title string")
    images = spark.createDataFrame([(f"https://a/produto/frango-inteiro-{k % 2}/", f"https://a/x_sku{2 * k}.png", k) for k in range(n)], "url string, image_url string, ordinal long")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "20k")  # what is sent by its measured size is no matter here
    try:
        out = match.image_match(products, images)
        got = out.collect()
        sent = broadcasts(out._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert max(sent, default=0) < n / 10
    first = {}
    for k in range(n):  # the SKU up to a digit counts, and the image of the smallest ordinal
        for cut in range(len(str(2 * k))):
            first.setdefault(int(str(2 * k)[: cut + 1]), f"https://a/x_sku{2 * k}.png")
    assert sorted((r["id"], r["image_url"]) for r in got) == [(k // 2, first.get(k // 2, f"https://a/x_sku{2 * (k // 2 % 2)}.png")) for k in range(2 * n)]


def test_a_full_buckets_pairs_are_many_tasks_work(spark, monkeypatch):
    """All points in one bucket: before, one task made all pairs, and held as many at once as two runs have. Nulls and equal rows stay."""
    from gondola.operators import match

    monkeypatch.setattr(match, "RUN_ROWS", 3)
    monkeypatch.setattr(match, "BLOCK_RUNS", 2, raising=False)
    rows = [(None if k % 13 == 0 else k // 2, "a", k % 16 / 16) for k in range(120)]
    points = spark.createDataFrame(rows, "p long, g string, v double")
    targets = points.selectExpr("p AS t", "g", "v AS w")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = lambda **more: match.band_join(points, targets, ["g"], F.col("w"), F.col("w") + 1.2, F.col("v"), 1.2, **more)
        got = pairs().withColumn("task", F.spark_partition_id()).collect()
        less = pairs(keep=["p"]).collect() if "keep" in match.band_join.__code__.co_varnames else None
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = lambda found: sorted(found, key=str)
    want = order((p, v, t, w) for p, _, v in rows for t, _, w in rows if w < v < w + 1.2)
    assert order((r["p"], r["v"], r["t"], r["w"]) for r in got) == want and len({r["task"] for r in got}) > 1
    assert less[0].asDict().keys() == {"g", "p", "t", "w"} and order((r["p"], r["t"], r["w"]) for r in less) == order((p, t, w) for p, _, t, w in want)


def test_an_orders_lines_are_exchanged_once(spark, tmp_path):
    """Also with nulls, a line that comes twice and lines without an order."""
    from gondola.plans.relational import dedup_lines

    lines = [(1, 3, None, 5, 3.0), (1, 2, 12, 5, 2.0), (1, 1, 10, 5, 1.0), (1, 2, 12, 5, 2.0), (2, 1, None, 1, None), (None, 1, 7, 1, 1.0), (None, None, 9, None, 1.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = dedup_lines(spark, str(tmp_path))
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert got.dtypes[-1] == ("parts", "bigint")
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == {
        1: (10, None, "7890000000012", "P: 10 | P: 12 | P: 12", 2),
        2: (None, None, None, "", 0),
        None: (9, 7, "7890000000009", "P: 9 | P: 7", 2),
    }


def test_only_texts_with_a_brace_are_parsed(spark):
    """The text is the one that parsing every row gives."""
    from gondola.functions.text import text_or
    from gondola.operators import export

    heads = [None, "", " ", "plain ring", "[1, 2]", '"title_clean"', "a { b", "{bad", '{"title_clean": "T"}', ' {"title_clean": "", "formatted_description": "F"}', '{"title_clean": null}', '[{"title_clean": "in a list"}]', '﻿{"title_clean": "mark"}', "{'title_clean': 'single'}", '{"title_clean": {"a": 1}}', "[object Object]"]
    df = spark.createDataFrame([(h, o) for h in heads for o in (None, "", "other")], "head string, other string")
    parsed = text_or(F.get_json_object("head", "$.formatted_description"), F.get_json_object("head", "$.title_clean"))
    rows = df.select(export.description_of(F.col("head"), F.col("other")).alias("got"), F.coalesce(text_or(parsed, F.col("head"), F.col("other")), F.lit("")).alias("want"))
    assert all(r["got"] == r["want"] for r in rows.collect())
    plan = df.select(export.description_of(F.col("head"), F.col("other")))._jdf.queryExecution().optimizedPlan().toString()
    parses = re.findall(r"(?i)(contains\(head[#0-9]*, \{\) THEN )?\(?get_json_object\(", plan)
    assert parses and all(parses)
