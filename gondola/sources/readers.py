"""Sources as DataFrames with explicit schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola import schemas
from gondola.plans.sync import Staging
from gondola.sources import workbook
from gondola.sources.shared import ship
from gondola.sources.sqlite import SqliteSource


def staging(spark: SparkSession, glob: str) -> Staging:
    """Staging documents (one JSON object a file), an array a table; place in file and array kept."""
    docs = spark.read.schema(schemas.STAGING).option("multiLine", True).json(glob).withColumn("file", F.regexp_extract(F.input_file_name(), "([^/]+)$", 1))
    rows = lambda name: docs.select("file", F.posexplode(name).alias("ordinal", "_row")).select("file", F.col("ordinal").cast("long").alias("ordinal"), "_row.*")
    return Staging(rows("fabricantes"), rows("marcas"), rows("produtos"), rows("codigos_barras"))


def raw_products(spark: SparkSession, supplier: str, path: str, kind: str = "parquet", **options: str) -> DataFrame:
    """A supplier's raw rows, all strings: parquet, json, csv, sqlite (with the option table), or jdbc with its options."""
    if kind == "sqlite":
        rows = sqlite_table(spark, path, **options)
    else:
        reader = spark.read.format(kind).options(**options)
        rows = reader.load() if kind == "jdbc" else (reader if kind == "parquet" else reader.schema(schemas.RAW_PRODUCTS)).load(path)
    names = [f.split()[0] for f in schemas.RAW_PRODUCTS.split(", ")]
    have = set(rows.columns)
    return rows.select(*[(F.col(n) if n in have else F.lit(None)).cast("string").alias(n) for n in names], F.lit(supplier).alias("supplier"))


def first_available(spark: SparkSession, schema: str, *reads) -> DataFrame:
    """The first of several reads whose path exists; an empty table of the schema if none does."""
    from pyspark.errors import AnalysisException

    for read in reads:
        try:
            return read()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)


def live_with_saved(live: DataFrame, saved: DataFrame, key: str = "url", image: str = "image_url") -> DataFrame:
    """Live rows, and the saved ones with an image whose key isn't live."""
    return live.unionByName(saved.where(F.coalesce(image, F.lit("")) != "").join(live.select(key), key, "left_anti"))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """Cached HTML files: url from the file's name (parts parted by two underscores), html."""
    rows = spark.read.text(folder, wholetext=True, pathGlobFilter="*.html")
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.html$", 1)
    return rows.select(F.concat(F.lit("https://"), F.replace(name, F.lit("__"), F.lit("/"))).alias("url"), F.col("value").alias("html"))


def catalogue_file(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """An exported catalogue (one JSON array): a file of any layout; with a schema, the parts that write_catalogue made (an object a line)."""
    if schema is None:
        return spark.read.option("multiLine", True).json(path)
    line = F.regexp_replace(F.trim("value"), r"^\[\]$|^[\[,]\s*|(?<=\})\s*\]$", "")
    return spark.read.text(path).select(line.alias("line")).where("line <> ''").select(F.from_json("line", schema).alias("row")).select("row.*")


def change_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CHANGES).option("multiLine", True).json(path)


def new_product_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.NEW_PRODUCTS).option("multiLine", True).json(path)


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    held = "array<struct<id:string,nome:string,marcas:array<string>,aliases_scraper:array<string>>>"
    rows = spark.read.schema(f"manifesto_holdings {held}, holdings {held}, manifesto_aliases map<string,string>").option("multiLine", True).json(path)
    return rows.select(F.coalesce("manifesto_holdings", "holdings").alias("holdings"), F.col("manifesto_aliases").alias("aliases"))


def manifest_brands(spark: SparkSession, path: str) -> DataFrame:
    """Brand names declared in a manifest: holding, brand."""
    return _manifest(spark, path).select(F.inline("holdings")).select(F.col("nome").alias("holding"), F.explode("marcas").alias("marca"))


def manifest_aliases(spark: SparkSession, path: str) -> DataFrame:
    """alias, meaning, holding: the manifest's commands (no holding) and those of its holdings' scrapers (no meaning)."""
    rows, none = _manifest(spark, path), F.lit(None).cast("string")
    shared = rows.select(F.explode("aliases").alias("alias", "meaning")).withColumn("holding", none)
    own = rows.select(F.inline("holdings")).select(F.explode("aliases_scraper").alias("alias"), none.alias("meaning"), F.col("nome").alias("holding"))
    return shared.unionByName(own)


def image_files(spark: SparkSession, folder: str, glob: str = "*.webp") -> DataFrame:
    """path and length of files; their bytes are never read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", "length")


def readiness(spark: SparkSession, names: list[str]) -> DataFrame:
    """table, status, rows of each table or view: one union of counts, no rows read twice."""
    there = [n for n in names if spark.catalog.tableExists(n)]
    counts = [spark.table(n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), F.lit("ready").alias("status"), "rows") for n in there]
    missing = spark.createDataFrame([(n, "missing", None) for n in names if n not in there], "table string, status string, rows long")
    return reduce(DataFrame.unionByName, counts, missing)


def column_types(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in spark.table(name).schema], "column string, type string, nullable boolean")


def spreadsheet(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """path, sheet and named columns (texts) of the first sheet of every workbook of a folder; a file is one task's work."""
    return workbook.table_of(workbook.read_books(spark, path).where("place = 0"), columns)


def sqlite_table(spark: SparkSession, path: str, table: str, partitions: int = 2, where: str = "1", schema: str | None = None) -> DataFrame:
    """A table of an SQLite file, in so many ranges of row ids; where: a condition that SQLite tests; schema: the columns wanted, all if None."""
    ship(spark)
    spark.dataSource.register(SqliteSource)
    reader = spark.read.format("sqlite").options(path=path, table=table, partitions=partitions, where=where)
    return (reader.schema(schema) if schema else reader).load()
