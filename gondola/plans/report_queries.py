"""Registered queries of the reports and the sync dataflow, each with its SQL where it has one."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.operators import cdc, export, reports
from gondola.plans.demo import cte, table
from gondola.plans.relational import DIFF_SQL, EXPORT_SQL, export_catalogue
from gondola.plans.scalars import _read, _uuid_sql
from gondola.plans.sync import Staging, prepare, sync


def _pct(a: str, b: str) -> str:
    return f"coalesce(round(CAST({a} AS DOUBLE) * 100 / nullif(CAST({b} AS DOUBLE), 0), 2), 0)"


def holding_status(spark, sf_dir):
    f, m, p = (table(spark, sf_dir, t) for t in ("fabricantes", "marcas", "produtos"))
    return reports.holding_status(f, m, p, export_catalogue(spark, sf_dir))


HOLDING_SQL = f"""WITH e AS ({EXPORT_SQL}), {cte("fabricantes", "marcas", "produtos").removeprefix("WITH ")},
r AS (SELECT m.fabricante_id AS id, m.nome, p.id AS pid, e.id IS NOT NULL AS x FROM produtos p JOIN marcas m ON m.id = p.marca_id LEFT JOIN e ON e.id = p.id),
g AS (SELECT id, count(*) AS total, count(*) FILTER (x) AS exported, list_sort(list(DISTINCT nome)) AS b FROM r GROUP BY 1)
SELECT f.nome, total, exported, {_pct("exported", "total")} AS pct, concat(array_to_string(b[1:5], ', '), CASE WHEN len(b) > 5 THEN concat(' (+', len(b) - 5, ')') ELSE '' END) AS marcas FROM g JOIN fabricantes f ON f.id = g.id"""


def ean_coverage(spark, sf_dir):
    c = table(spark, sf_dir, "codigos")
    parts = [reports.code_coverage(c.where(f"ordinal % 3 = {k}"), name, F.col("codigo")) for k, name in enumerate(("old", "staging", "stored"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


COVERAGE_SQL = f"""{cte("codigos")}, c AS (SELECT *, CASE WHEN regexp_matches(codigo, '^[0-9]{{13}}$') THEN codigo END AS e FROM codigos)
SELECT CASE ordinal % 3 WHEN 0 THEN 'old' WHEN 1 THEN 'staging' ELSE 'stored' END AS label, count(*) AS total, count(e) AS with_ean, count(DISTINCT e) AS unique_ean, {_pct("count(e)", "count(*)")} AS pct FROM c GROUP BY 1"""


def reconciliation(spark, sf_dir):
    """Rows of the table, of the view with brands, and distinct products among barcodes."""
    m, p, c = (table(spark, sf_dir, t) for t in ("marcas", "produtos", "codigos"))
    view = p.join(m.select(F.col("id").alias("marca_id"), "nome"), "marca_id", "left")
    count = lambda d, what: d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")
    distinct = c.agg(F.count_distinct("produto_id").alias("n")).select(F.lit("coded").alias("what"), "n")
    return count(p, "table").unionByName(count(view, "view")).unionByName(distinct)


RECONCILIATION_SQL = f"""{cte("marcas", "produtos", "codigos")} SELECT 'table' AS what, count(*) AS n FROM produtos UNION ALL SELECT 'view', count(*) FROM produtos p LEFT JOIN marcas m ON m.id = p.marca_id UNION ALL SELECT 'coded', count(DISTINCT produto_id) FROM codigos"""


def barcode_population(spark, sf_dir):
    return reports.barcode_population(table(spark, sf_dir, "produtos"), table(spark, sf_dir, "codigos"))


POPULATION_SQL = f"""{cte("produtos", "codigos")}, h AS (SELECT produto_id, bool_or(tipo = 'EAN' AND n) AS ean, bool_or(tipo LIKE '%DUN%' AND n) AS dun, bool_or(n) AS a FROM (SELECT *, regexp_matches(codigo, '^[0-9]+$') AS n FROM codigos) GROUP BY 1)
SELECT count(*) AS products, count(*) FILTER (ean) AS with_ean, count(*) FILTER (dun) AS with_dun, count(*) FILTER (a) AS with_any, count(*) FILTER (NOT coalesce(a, false)) AS without FROM produtos LEFT JOIN h ON h.produto_id = id"""


def without_code(spark, sf_dir):
    return reports.without_code_by_brand(*(table(spark, sf_dir, t) for t in ("produtos", "marcas", "codigos")))


WITHOUT_SQL = f"""{cte("produtos", "marcas", "codigos")} SELECT coalesce(nome, 'N/D') AS marca, count(*) AS n FROM produtos p LEFT JOIN marcas m ON m.id = p.marca_id WHERE p.id NOT IN (SELECT produto_id FROM codigos WHERE regexp_matches(codigo, '^[0-9]+$')) GROUP BY 1"""


def image_presence(spark, sf_dir):
    files = _read(spark, sf_dir, "part").where("p_partkey % 4 = 0").select(F.concat(F.lit("/x/"), F.col("p_partkey"), F.lit(".webp")).alias("path"))
    return reports.image_presence(table(spark, sf_dir, "produtos"), files)


PRESENCE_SQL = f"""{cte("produtos")} SELECT CASE WHEN imagem_url IS NULL THEN 'none' WHEN imagem_url LIKE 'http%' THEN 'web' WHEN ordinal % 4 = 0 AND ordinal % 6 = 2 THEN 'found' ELSE 'missing' END AS kind, count(*) AS n FROM produtos GROUP BY 1"""


def image_origins(spark, sf_dir):
    return reports.image_origins(table(spark, sf_dir, "produtos"), ["example.org/storage"])


ORIGINS_SQL = f"""{cte("produtos")}, k AS (SELECT imagem_url AS u, CASE WHEN coalesce(imagem_url, '') = '' THEN 'empty' WHEN contains(imagem_url, 'example.org/storage') THEN 'storage' WHEN imagem_url LIKE 'http%' THEN 'web' WHEN imagem_url LIKE '/%' THEN 'relative' ELSE 'file' END AS name FROM produtos)
SELECT name, count(*) AS n, 'kind' AS what FROM k GROUP BY 1 UNION ALL SELECT regexp_extract(u, '^https?://([^/]+)', 1), count(*), 'host' FROM k WHERE name = 'web' GROUP BY 1"""


def brand_coverage(spark, sf_dir):
    m, p = table(spark, sf_dir, "marcas"), table(spark, sf_dir, "produtos")
    rows = p.join(m.select(F.col("id").alias("marca_id"), F.col("nome").alias("marca")), "marca_id").withColumn("title", F.col("descricao_original"))
    return reports.brand_coverage(rows, ["a", "united"], ["ring"])


BRAND_COVERAGE_SQL = f"""{cte("marcas", "produtos")} SELECT nome AS marca, count(*) AS total, count(*) FILTER (imagem_url <> '' AND imagem_url NOT LIKE 'http%') AS local, count(*) FILTER (imagem_url LIKE 'http%') AS web, count(*) FILTER (imagem_url IS NULL) AS none,
 {_pct("count(imagem_url)", "count(*)")} AS pct FROM produtos p JOIN marcas m ON m.id = p.marca_id WHERE contains(lower(nome), 'a') OR contains(lower(nome), 'united') OR contains(lower(descricao_original), 'ring') GROUP BY 1"""


def supplier_summary(spark, sf_dir):
    return reports.supplier_summary(table(spark, sf_dir, "produtos"))


SUMMARY_SQL = f"{cte('produtos')} SELECT classe, count(*) AS total, count(*) FILTER (NOT fracionado) AS fixed, count(*) FILTER (fracionado) AS open FROM produtos GROUP BY 1"


def enrichment_candidates(spark, sf_dir):
    """Products without an image that have a 13-digit EAN (the last one) and no local file."""
    p, c = table(spark, sf_dir, "produtos"), table(spark, sf_dir, "codigos")
    files = _read(spark, sf_dir, "part").where("p_partkey % 4 = 0").select(F.concat(F.lit("790"), F.lpad(F.col("p_partkey").cast("string"), 10, "0")).alias("ean"))
    wanting = p.where(F.coalesce("imagem_url", F.lit("")) == "").select("id")
    eans = export.codes_by_product(c).where("ean is not null").select(F.col("produto_id").alias("id"), "ean")
    return wanting.join(eans, "id").join(files, "ean", "left_anti")


ENRICH_SQL = f"""{cte("produtos", "codigos")}, e AS (SELECT produto_id, arg_max(codigo, ordinal) AS ean FROM codigos WHERE regexp_matches(codigo, '^[0-9]{{13}}$') AND tipo = 'EAN' GROUP BY 1)
SELECT ean, id FROM produtos JOIN e ON e.produto_id = id WHERE imagem_url IS NULL AND ean NOT IN (SELECT concat('790', lpad(CAST(p_partkey AS VARCHAR), 10, '0')) FROM part WHERE p_partkey % 4 = 0)"""


def run_report(spark, sf_dir):
    """A stage for every order, the totals, the holdings, and the heads of the new and changed products."""
    f, m, p, c, a = (table(spark, sf_dir, t) for t in ("fabricantes", "marcas", "produtos", "codigos", "antes"))
    o = _read(spark, sf_dir, "orders")
    stages = o.select(F.col("o_orderkey").alias("name"), F.col("o_orderstatus").alias("status"), (F.floor("o_totalprice").cast("double") / 100).alias("seconds"))
    named = lambda d: d.join(p.select("id", F.col("descricao_original").alias("name")), "id")
    new, changed = named(cdc.new_rows(p, a).select("id")), named(cdc.field_changes(p, a).select("id"))
    return reports.run_report(stages, f, m, p, c, export_catalogue(spark, sf_dir), new, changed)


RUN_SQL = f"""WITH e AS ({EXPORT_SQL}), hs AS ({HOLDING_SQL}), df AS ({DIFF_SQL}), {cte("fabricantes", "marcas", "produtos", "codigos", "antes").removeprefix("WITH ")},
s AS (SELECT o_orderkey, o_orderstatus, floor(o_totalprice) / 100 AS s FROM orders), t AS (SELECT count(*) AS total, count(e.id) AS approved FROM produtos p LEFT JOIN e ON e.id = p.id),
nw AS (SELECT id, descricao_original AS name FROM produtos WHERE id NOT IN (SELECT id FROM antes)), ch AS (SELECT id, descricao_original AS name FROM produtos WHERE id IN (SELECT id FROM df))
SELECT 'stage' AS section, CAST(o_orderkey AS VARCHAR) AS name, concat(o_orderstatus, ' ', CASE WHEN s >= 60 THEN concat(CAST(floor(s / 60) AS BIGINT), ' min ', printf('%.2f s', s - floor(s / 60) * 60)) ELSE printf('%.2f s', s) END) AS value FROM s
UNION ALL SELECT 'total', 'products', CAST(total AS VARCHAR) FROM t
UNION ALL SELECT 'total', 'approved', concat(approved, printf(' (%.2f%%)', {_pct("approved", "total")})) FROM t
UNION ALL SELECT 'total', 'pending', concat(total - approved, printf(' (%.2f%%)', {_pct("(total - approved)", "total")})) FROM t
UNION ALL SELECT 'total', 'holdings', CAST(count(*) AS VARCHAR) FROM fabricantes UNION ALL SELECT 'total', 'brands', CAST(count(*) AS VARCHAR) FROM marcas UNION ALL SELECT 'total', 'codes', CAST(count(*) AS VARCHAR) FROM codigos
UNION ALL SELECT 'holding', nome, concat(total, ' | ', exported, printf(' (%.2f%%)', pct), ' | ', marcas) FROM hs
UNION ALL SELECT 'total', 'new', CAST(count(*) AS VARCHAR) FROM nw UNION ALL SELECT 'total', 'changed', CAST(count(*) AS VARCHAR) FROM ch
UNION ALL (SELECT 'new', id, name FROM nw ORDER BY id LIMIT 8) UNION ALL (SELECT 'changed', id, name FROM ch ORDER BY id LIMIT 8)"""


def verified_sample(spark, sf_dir):
    """Ten barcodes drawn by hash, with product and brand."""
    m, p, c = (table(spark, sf_dir, t) for t in ("marcas", "produtos", "codigos"))
    rows = c.where("tipo = 'EAN'").join(p.select(F.col("id").alias("produto_id"), "marca_id", "descricao_original"), "produto_id").join(m.select(F.col("id").alias("marca_id"), "nome"), "marca_id")
    return reports.sample(rows.select("id", "codigo", "descricao_original", "nome"), "id")


SAMPLE_SQL = f"""{cte("marcas", "produtos", "codigos")} SELECT c.id, codigo, descricao_original, nome FROM codigos c JOIN produtos p ON p.id = produto_id JOIN marcas m ON m.id = marca_id WHERE tipo = 'EAN' ORDER BY md5(concat('42', c.id)), c.id LIMIT 10"""


def _staging(spark, sf_dir) -> Staging:
    f, m, p, c = (table(spark, sf_dir, t) for t in ("fabricantes", "marcas", "produtos", "codigos"))
    in_file = lambda d, k: d.withColumn("file", F.concat(F.lit("f"), k.cast("string")))
    one = F.lit(0)
    brands = in_file(m, one).unionByName(in_file(m, F.lit(1))).withColumn("ordinal", F.lit(0).cast("long"))
    number = F.regexp_extract("produto_id", "([0-9]+)$", 1).cast("long")
    return Staging(in_file(f, one), brands, in_file(p, F.col("ordinal") % 2), in_file(c, number % 2))


def sync_tables(spark, sf_dir):
    """Staging of two files over the stored snapshot: merged products, owned codes, conflicts, new and changed rows."""
    a, m, c = table(spark, sf_dir, "antes"), table(spark, sf_dir, "marcas"), table(spark, sf_dir, "codigos")
    from gondola.functions.keys import uuid5

    stored = a.withColumns({"id": uuid5(F.col("id")), "marca_id": uuid5(F.col("marca_id"))}).drop("ordinal")
    none = c.select("id", "produto_id", "tipo", "codigo").limit(0)
    out = sync(_staging(spark, sf_dir), stored, m.limit(0), none)
    tag = lambda d, what, value: d.select("id", F.lit(what).alias("what"), value.cast("string").alias("value"))
    return (
        tag(out.products, "product", F.coalesce("status_imagem", F.lit("-")))
        .unionByName(tag(out.codes, "code", F.col("codigo")))
        .unionByName(tag(out.conflicts, "conflict", F.col("codigo")))
        .unionByName(tag(out.new, "new", F.col("ean")))
        .unionByName(tag(out.brands, "brand", F.col("nome")))
    )


SYNC_SQL = f"""{cte("produtos", "marcas", "codigos", "antes")},
c AS (SELECT *, CAST(regexp_extract(produto_id, '([0-9]+)$', 1) AS BIGINT) % 2 AS f FROM codigos), r AS (SELECT *, row_number() OVER (PARTITION BY f, trim(codigo) ORDER BY ordinal) AS n FROM c),
g AS (SELECT * FROM r WHERE n = 1 AND regexp_matches(codigo, '^[0-9]+$')), p AS (SELECT * FROM produtos WHERE id IN (SELECT produto_id FROM g)),
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY codigo ORDER BY f DESC, ordinal DESC) AS k FROM g) WHERE k = 1),
l AS (SELECT produto_id, arg_max(codigo, ordinal) AS codigo FROM g GROUP BY 1)
SELECT {_uuid_sql("p.id")} AS id, 'product' AS what, coalesce(CASE WHEN a.status_imagem IN ('aprovado', 'reprovado') THEN a.status_imagem ELSE p.status_imagem END, '-') AS value FROM p LEFT JOIN antes a ON a.id = p.id
UNION ALL SELECT {_uuid_sql("id")}, 'product', coalesce(status_imagem, '-') FROM antes WHERE id NOT IN (SELECT id FROM p)
UNION ALL SELECT {_uuid_sql("id")}, 'code', codigo FROM o UNION ALL SELECT {_uuid_sql("id")}, 'conflict', codigo FROM r WHERE n > 1
UNION ALL SELECT {_uuid_sql("p.id")}, 'new', coalesce(l.codigo, '') FROM p LEFT JOIN l ON l.produto_id = p.id WHERE p.id NOT IN (SELECT id FROM antes)
UNION ALL SELECT {_uuid_sql("id")}, 'brand', nome FROM marcas WHERE id IN (SELECT marca_id FROM p)"""


def staged_products(spark, sf_dir):
    """Staged products with keys, descriptions and final weights."""
    return prepare(_staging(spark, sf_dir))[1].select("id", "marca_id", F.col("peso_gramas").cast("string").alias("peso_gramas"), "fracionado")


STAGED_SQL = f"""{cte("produtos", "codigos")}, c AS (SELECT *, CAST(regexp_extract(produto_id, '([0-9]+)$', 1) AS BIGINT) % 2 AS f FROM codigos), r AS (SELECT *, row_number() OVER (PARTITION BY f, trim(codigo) ORDER BY ordinal) AS n FROM c),
p AS (SELECT *, peso_gramas > 0 AND NOT fracionado AS known FROM produtos WHERE id IN (SELECT produto_id FROM r WHERE n = 1 AND regexp_matches(codigo, '^[0-9]+$')))
SELECT {_uuid_sql("id")} AS id, {_uuid_sql("marca_id")} AS marca_id, CAST(peso_gramas AS VARCHAR) AS peso_gramas, NOT coalesce(known, false) AS fracionado FROM p"""

QUERIES = {
    "holding_status": (holding_status, HOLDING_SQL),
    "ean_coverage": (ean_coverage, COVERAGE_SQL),
    "reconciliation": (reconciliation, RECONCILIATION_SQL),
    "barcode_population": (barcode_population, POPULATION_SQL),
    "without_code": (without_code, WITHOUT_SQL),
    "image_presence": (image_presence, PRESENCE_SQL),
    "image_origins": (image_origins, ORIGINS_SQL),
    "brand_coverage": (brand_coverage, BRAND_COVERAGE_SQL),
    "supplier_summary": (supplier_summary, SUMMARY_SQL),
    "enrichment_candidates": (enrichment_candidates, ENRICH_SQL),
    "run_report": (run_report, RUN_SQL),
    "verified_sample": (verified_sample, SAMPLE_SQL),
    "staged_products": (staged_products, STAGED_SQL),
    "sync_tables": (sync_tables, SYNC_SQL),
}
