"""Registered queries that write files or stored tables and return what is read back, and SQL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.functions import sql
from gondola.functions.text import sheet_name
from gondola.operators import export, merge
from gondola.plans.demo import cte, table
from gondola.plans.relational import CODE_SHEET_SQL, EXPORT_SQL, SHEET_SQL, UPSERT_SQL, code_sheet, export_catalogue
from gondola.plans.scalars import CODES_SQL, _read
from gondola.sources import readers, tables, workbook, writers
from gondola.sources.shared import shared_path


def catalogue_array(spark, sf_dir):
    """The published catalogue as one JSON array, read back."""
    rows, path = export_catalogue(spark, sf_dir), shared_path(spark, "catalogue-array")
    writers.write_catalogue(rows, path)
    return readers.catalogue_file(spark, path, ", ".join(f"`{n}` {t}" for n, t in rows.dtypes))


def workbooks(spark, sf_dir):
    """A workbook a holding: all its products, a sheet for each of its brands, a summary, the codes; read back cell by cell."""
    f, m, p, c = (table(spark, sf_dir, t) for t in ("fabricantes", "marcas", "produtos", "codigos"))
    holdings = m.select(F.col("id").alias("marca_id"), F.col("fabricante_id")).join(f.select(F.col("id").alias("fabricante_id"), F.col("nome").alias("holding")), "fabricante_id")
    owner = p.join(holdings, "marca_id", "left").select("id", F.coalesce("holding", F.lit("N/D")).alias("holding"))
    rows = export.sheet_rows(p, m, c).join(owner, "id")
    counts = rows.groupBy("holding", "marca").agg(F.count(F.lit(1)).alias("n"))
    codes = code_sheet(spark, sf_dir).join(owner.withColumnRenamed("id", "produto_id"), "produto_id")
    path = shared_path(spark, "workbooks")
    book = F.col("holding")
    workbook.write_books(
        [
            workbook.sheet(rows, book, 0, F.lit("Todos"), ["id"], hidden=("holding",)),
            workbook.sheet(rows, book, 1, sheet_name(F.col("marca")), ["id"], hidden=("holding",)),
            workbook.sheet(counts, book, 2, F.lit("Resumo"), ["marca"], hidden=("holding",)),
            workbook.sheet(codes.select("holding", "id", "produto_id", "produto", "tipo", "codigo"), book, 3, F.lit("EAN-DUN"), ["id"], hidden=("holding",)),
        ],
        path,
    )
    read = workbook.read_books(spark, path)
    return read.select(F.regexp_extract("path", r"([^/]+)\.xlsx$", 1).alias("book"), "sheet", F.col("row").alias("line"), F.array_join("cells", "|", "-").alias("cells"))


_BOOKS = f"""WITH s AS ({SHEET_SQL}), k AS ({CODE_SHEET_SQL}), {cte("fabricantes", "marcas", "produtos").removeprefix("WITH ")},
o AS (SELECT p.id, regexp_replace(coalesce(f.nome, 'N/D'), '[^A-Za-z0-9_. -]', '_', 'g') AS book FROM produtos p LEFT JOIN marcas m ON m.id = p.marca_id LEFT JOIN fabricantes f ON f.id = m.fabricante_id),
r AS (SELECT book, s.*, concat_ws('|', s.id, marca, descricao, peso, fracionado, codigos) AS cells FROM s JOIN o ON o.id = s.id),
a AS (SELECT book, 'Todos' AS sheet, id AS pos, cells, 'id|marca|descricao|peso|fracionado|codigos' AS titles FROM r
 UNION ALL SELECT book, substr(regexp_replace(marca, '[\\\\/?*\\[\\]:]', '_', 'g'), 1, 31), id, cells, 'id|marca|descricao|peso|fracionado|codigos' FROM r
 UNION ALL SELECT book, 'Resumo', marca, concat(marca, '|', count(*)), 'marca|n' FROM r GROUP BY book, marca
 UNION ALL SELECT book, 'EAN-DUN', k.id, concat_ws('|', k.id, produto_id, produto, tipo, codigo), 'id|produto_id|produto|tipo|codigo' FROM k JOIN o ON o.id = produto_id)"""
BOOKS_SQL = f"{_BOOKS} SELECT book, sheet, row_number() OVER (PARTITION BY book, sheet ORDER BY pos, cells) AS line, cells FROM a UNION ALL SELECT DISTINCT book, sheet, CAST(0 AS BIGINT), titles FROM a"


def stored_upsert(spark, sf_dir):
    """A stored table of orders: created, a batch upserted, rows deleted, rows updated, each a version; the last one read."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = shared_path(spark, "orders-table")
    tables.create(o.where("o_orderkey % 3 <> 0"), path, "o_orderkey", file_rows=5000)
    tables.upsert(spark, path, o.where("o_orderkey % 5 <> 0").withColumn("o_totalprice", F.col("o_totalprice") * 2))
    tables.delete(spark, path, o.where("o_orderkey % 7 = 0"))
    tables.change(spark, path, o.where("o_orderkey % 11 = 0"), lambda rows: merge.update_where(rows, F.col("o_orderkey") % 11 == 0, {"o_orderstatus": F.lit("X")}))
    none = o.where("o_orderkey % 13 = 0").withColumn("o_orderstatus", F.lit(None).cast("string"))
    tables.change(spark, path, none, lambda rows: merge.update_from(rows, none, "o_orderkey", ["o_orderstatus"]))
    return tables.read(spark, path)


def sql_functions(spark, sf_dir):
    """The check-digit functions, called from SQL."""
    sql.register(spark)
    return spark.sql("SELECT id, gs1_ean13(codigo) AS ean_table, gs1_check_digit(lpad(gs1_digits(codigo), 12, '0')) AS digit FROM {c}", c=table(spark, sf_dir, "codigos"))


_TWELVE = "substr(lpad(d, 12, '0'), 1, 12)"
SQL_FUNCTIONS_SQL = f"""{CODES_SQL} SELECT id, ean_table,
 CAST((10 - ({' + '.join(f"CAST(substr({_TWELVE}, {i}, 1) AS INTEGER) * {1 if i % 2 else 3}" for i in range(1, 13))}) % 10) % 10 AS VARCHAR) AS digit FROM c5"""

QUERIES = {
    "catalogue_array": (catalogue_array, EXPORT_SQL),
    "workbooks": (workbooks, BOOKS_SQL),
    "stored_upsert": (stored_upsert, UPSERT_SQL),
    "sql_functions": (sql_functions, SQL_FUNCTIONS_SQL),
}
