"""Every catalogue query against its SQL in DuckDB, and the plans' shapes."""

import duckdb
import pytest

from gondola.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(pdf):
    def cell(x):
        if x is None or x != x:
            return None
        return round(float(x), 9) if isinstance(x, (int, float)) and not isinstance(x, bool) else x.item() if hasattr(x, "item") else x

    pdf = pdf[sorted(pdf.columns)].astype(object)
    return sorted((tuple(cell(x) for x in r) for r in pdf.where(pdf.notna(), None).itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", [n for n in catalogue.queries() if n in catalogue.oracle_sql()])
def test_query_equals_sql(spark, duck, name):
    got, want = catalogue.queries()[name](spark, SF).toPandas(), duck.sql(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_queries_without_sql_run(spark):
    for name in set(catalogue.queries()) - set(catalogue.oracle_sql()):
        assert catalogue.queries()[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", ["numeric_products", "field_diff", "audit_rules", "export_catalogue", "sync_tables"])
def test_no_python_on_the_executors(spark, name):
    plan = catalogue.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filters_reach_the_scan(spark):
    plan = catalogue.queries()["upsert_merge"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in plan and "PushedFilters: [IsNotNull(o_orderkey)" in plan


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize(("name", "column"), [("brand_pages", "image_url"), ("trade_pages", "image_url"), ("shop_pages", "image_url"), ("shop_pages", "ean"), ("gtin_pages", "image_url"), ("image_subset", "origem")])
def test_every_form_has_rows(spark, name, column):
    """Found and not found, and every origin of an image."""
    found = [r[column] for r in catalogue.queries()[name](spark, SF).collect()]
    assert any(found) and (len(set(found)) == 2 if name == "image_subset" else any(not x for x in found))


def test_the_matchs_plan_is_small(spark):
    plan = catalogue.queries()["image_match"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 50_000
