"""Coverage and comparison reports: aggregations over the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gondola.functions.barcode import has_digits, is_digits
from gondola.functions.web import host, origin_class


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals; 0 where there is nothing."""
    return F.coalesce(F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), 2), F.lit(0.0))


def preview(names: Column, n: int = 5) -> Column:
    """The first names of an array, and how many more there are."""
    rest = F.size(names) - n
    return F.concat(F.array_join(F.slice(names, 1, n), ", "), F.when(rest > 0, F.concat(F.lit(" (+"), rest.cast("string"), F.lit(")"))).otherwise(F.lit("")))


def holding_status(holdings: DataFrame, brands: DataFrame, products: DataFrame, exported: DataFrame) -> DataFrame:
    """Products, exported products and brands of each holding, the largest first."""
    owned = brands.select(F.col("id").alias("marca_id"), F.col("nome").alias("marca"), F.col("fabricante_id").alias("id"))
    flagged = products.select(F.col("id").alias("produto_id"), "marca_id").join(exported.select(F.col("id").alias("produto_id"), F.lit(1).alias("_out")), "produto_id", "left")
    # counted by brand first: a holding's products meet as a few rows
    by_brand = flagged.groupBy("marca_id").agg(F.count(F.lit(1)).alias("total"), F.count("_out").alias("exported"))
    rows = by_brand.join(owned, "marca_id").groupBy("id").agg(F.sum("total").alias("total"), F.sum("exported").alias("exported"), F.array_sort(F.collect_set("marca")).alias("_brands"))
    named = rows.join(holdings.select("id", "nome"), "id")
    return named.select("nome", "total", "exported", percent(F.col("exported"), F.col("total")).alias("pct"), preview(F.col("_brands")).alias("marcas")).orderBy(F.desc("total"), "nome")


def code_coverage(rows: DataFrame, label: str, code: Column) -> DataFrame:
    """total, with a 13-digit code, distinct such codes, percent."""
    full = F.when(has_digits(code, 13), code)
    counted = rows.agg(F.count(F.lit(1)).alias("total"), F.count(full).alias("with_ean"), F.count_distinct(full).alias("unique_ean"))
    return counted.select(F.lit(label).alias("label"), "total", "with_ean", "unique_ean", percent(F.col("with_ean"), F.col("total")).alias("pct"))


def barcode_population(products: DataFrame, codes: DataFrame) -> DataFrame:
    """How many products have an EAN, a DUN, any numeric code, none."""
    numeric = is_digits(F.col("codigo"))
    held = codes.groupBy(F.col("produto_id").alias("id")).agg(
        F.bool_or((F.col("tipo") == "EAN") & numeric).alias("ean"), F.bool_or(F.col("tipo").contains("DUN") & numeric).alias("dun"), F.bool_or(numeric).alias("any")
    )
    rows = products.select("id").join(held, "id", "left")
    return rows.agg(
        F.count(F.lit(1)).alias("products"), F.count_if("ean").alias("with_ean"), F.count_if("dun").alias("with_dun"), F.count_if("any").alias("with_any"), F.count_if(~F.coalesce("any", F.lit(False))).alias("without")
    )


def without_code_by_brand(products: DataFrame, brands: DataFrame, codes: DataFrame) -> DataFrame:
    coded = codes.where(is_digits(F.col("codigo"))).select(F.col("produto_id").alias("id"))
    counts = products.join(coded, "id", "left_anti").groupBy("marca_id").agg(F.count(F.lit(1)).alias("n"))
    named = counts.join(brands.select(F.col("id").alias("marca_id"), "nome"), "marca_id", "left")
    return named.groupBy(F.coalesce("nome", F.lit("N/D")).alias("marca")).agg(F.sum("n").alias("n"))


def image_presence(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Images of rows(imagem_url) by kind: web, local found, local missing, none."""
    local = files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("_file")).distinct().withColumn("_there", F.lit(True))
    joined = rows.withColumn("_file", F.regexp_extract(F.coalesce("imagem_url", F.lit("")), "([^/]+)$", 1)).join(local, "_file", "left")
    web, none = F.coalesce(F.col("imagem_url").rlike("^https?://"), F.lit(False)), F.coalesce("imagem_url", F.lit("")) == ""
    kind = F.when(none, F.lit("none")).when(web, F.lit("web")).when(F.col("_there"), F.lit("found")).otherwise(F.lit("missing"))
    return joined.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def image_origins(rows: DataFrame, storage: list[str]) -> DataFrame:
    """Images by kind of address, and web addresses by host."""
    url = F.col("imagem_url")
    kinds = rows.groupBy(origin_class(url, storage).alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("kind"))
    web = rows.where(origin_class(url, storage) == "web")
    hosts = web.groupBy(host(url).alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("host"))
    return kinds.unionByName(hosts)


def brand_coverage(rows: DataFrame, tokens: list[str], title_tokens: list[str]) -> DataFrame:
    """Of the rows(marca, title, imagem_url) of a family of brands: total, with local image, with web image, without, by brand."""
    member = F.exists(F.array(*map(F.lit, tokens)), lambda t: F.contains(F.lower("marca"), t)) | F.exists(F.array(*map(F.lit, title_tokens)), lambda t: F.contains(F.lower("title"), t))
    web = F.coalesce(F.col("imagem_url").rlike("^https?://"), F.lit(False))
    local = F.coalesce(F.col("imagem_url") != "", F.lit(False)) & ~web
    counted = rows.where(member).groupBy("marca").agg(F.count(F.lit(1)).alias("total"), F.count_if(local).alias("local"), F.count_if(web).alias("web"))
    return counted.select("marca", "total", "local", "web", (F.col("total") - F.col("local") - F.col("web")).alias("none"), percent(F.col("local") + F.col("web"), F.col("total")).alias("pct"))


def supplier_summary(products: DataFrame) -> DataFrame:
    """Products by class: total, fixed weight, sold by weight."""
    return products.groupBy("classe").agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("fracionado")).alias("fixed"), F.count_if("fracionado").alias("open"))


def sample(rows: DataFrame, key: str, n: int = 10, seed: str = "42") -> DataFrame:
    """n rows drawn by the MD5 of the seed and a key: any engine draws the same ones, and tasks keep n each."""
    return rows.orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary")), key).limit(n)


def duration(seconds: Column) -> Column:
    """59.31 s or 2 min 13.10 s."""
    minutes = F.floor(seconds / 60)
    rest = F.format_string("%.2f s", seconds - minutes * 60)
    return F.when(minutes > 0, F.concat(minutes.cast("string"), F.lit(" min "), rest)).otherwise(rest)


def numbered(rows: DataFrame, group: Column, order: str, name: str, step: int = 1 << 16) -> DataFrame:
    """rows with their number (1, 2, …) in each group, by an integer column.

    Stretches of the order are counted first, so a task sorts one stretch of a group and never a whole one.
    """
    cut = rows.withColumns({"_group": group, "_stretch": F.floor(F.col(order) / step)})
    counts = cut.groupBy("_group", "_stretch").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_group").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("_group").alias("_g"), F.col("_stretch").alias("_s"), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_group", "_stretch").orderBy(order))
    joined = cut.withColumn("_inside", inside).join(starts, F.col("_group").eqNullSafe(F.col("_g")) & F.col("_stretch").eqNullSafe(F.col("_s")))
    return joined.withColumn(name, (F.col("_before") + F.col("_inside")).cast("int")).drop("_group", "_stretch", "_g", "_s", "_before", "_inside")


#: So many rows of each log are shown.
HEAD = 8


def run_report(stages: DataFrame, holdings: DataFrame, brands: DataFrame, products: DataFrame, codes: DataFrame, exported: DataFrame, new: DataFrame, changed: DataFrame) -> DataFrame:
    """section, name, value: stages(name, status, seconds), totals, the holdings' status, and the heads of both logs(id, name)."""
    part = lambda df, section, label, value: df.select(F.lit(section).alias("section"), label.cast("string").alias("name"), value.cast("string").alias("value"))
    count = lambda df, what: part(df.agg(F.count(F.lit(1)).alias("n")), "total", F.lit(what), F.col("n"))
    share = lambda n: F.format_string("%d (%.2f%%)", n, percent(n, F.col("total")))
    out = exported.select("id", F.lit(1).alias("_out")).distinct()
    sums = products.select("id").join(out, "id", "left").agg(F.count(F.lit(1)).alias("total"), F.count("_out").alias("approved"))
    pending = F.col("total") - F.col("approved")
    report = part(stages, "stage", F.col("name"), F.concat_ws(" ", "status", duration(F.col("seconds"))))
    report = report.unionByName(part(sums, "total", F.lit("products"), F.col("total")))
    report = report.unionByName(part(sums, "total", F.lit("approved"), share(F.col("approved")))).unionByName(part(sums, "total", F.lit("pending"), share(pending)))
    for df, what in ((holdings, "holdings"), (brands, "brands"), (codes, "codes")):
        report = report.unionByName(count(df, what))
    status = holding_status(holdings, brands, products, exported)
    report = report.unionByName(part(status, "holding", F.col("nome"), F.format_string("%d | %d (%.2f%%) | %s", "total", "exported", "pct", "marcas")))
    for log, what in ((new, "new"), (changed, "changed")):
        report = report.unionByName(count(log, what)).unionByName(part(log.orderBy("id").limit(HEAD), what, F.col("id"), F.col("name")))
    return report
