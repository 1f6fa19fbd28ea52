"""The published catalogue: codes by shape, image decisions, export rows, unpivoted barcodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.dictionaries import EXPORT_IMAGES
from gondola.functions.barcode import has_digits, is_digits
from gondola.functions.text import text_or, weight_label
from gondola.functions.web import contains_any


def code_kind(code: Column, kind: Column) -> Column:
    """DUN for 14 digits whatever the type (other DUN-typed numbers are void), EAN for 13 that aren't an SKU, SKU for the short rest."""
    c, k = F.btrim(F.coalesce(code, F.lit(""))), F.upper(F.coalesce(kind, F.lit("")))
    return (
        F.when(c == "", F.lit(None).cast("string"))
        .when(has_digits(c, 14), F.lit("DUN"))
        .when(k.contains("DUN") & is_digits(c), F.lit(None).cast("string"))
        .when(has_digits(c, 13) & (k.contains("EAN") | ~k.contains("SKU")), F.lit("EAN"))
        .when(k.contains("SKU") | (F.length(c) < 13), F.lit("SKU"))
    )


def codes_by_product(codes: DataFrame, order: str = "ordinal") -> DataFrame:
    """produto_id with the last ean, dun and sku: one aggregation."""
    kinds = codes.withColumns({"_kind": code_kind(F.col("codigo"), F.col("tipo")), "_code": F.btrim("codigo")})
    last = lambda k: F.max_by(F.when(F.col("_kind") == k, F.col("_code")), F.when(F.col("_kind") == k, F.col(order)))
    return kinds.groupBy("produto_id").agg(last("EAN").alias("ean"), last("DUN").alias("dun"), last("SKU").alias("sku"))


def description_of(*columns: Column) -> Column:
    """The first text: of a JSON object its formatted, else its clean title."""
    head = columns[0]
    # a text without a brace is no object: parsing it ends in an exception a row and field
    field = lambda path: F.when(F.contains(head, F.lit("{")), F.get_json_object(head, path))
    parsed = text_or(field("$.formatted_description"), field("$.title_clean"))
    return F.coalesce(text_or(parsed, *columns), F.lit(""))


def image_decision(url: Column, status: Column, local: Column, local_url: Column) -> Column:
    """struct(imagem_url, status_imagem): placeholders and rejected images vanish, a local file wins, pending ones wait."""
    bad = F.coalesce(contains_any(F.lower(url), EXPORT_IMAGES), F.lit(False))
    status = F.when(bad, F.lit("sem_imagem")).otherwise(F.coalesce(status, F.lit("sem_imagem")))
    none = F.lit(None).cast("string")
    made = lambda u, s: F.struct(u.alias("imagem_url"), s.alias("status_imagem"))
    return (
        F.when(status.isin("sem_imagem", "SEM_IMAGEM"), made(none, status))
        .when(local, made(local_url, F.coalesce(F.nullif(status, F.lit("")), F.lit("VALIDATED"))))
        .when((F.coalesce(url, F.lit("")) == "") | (status == "pendente_aprovacao"), made(none, F.lit("sem_imagem")))
        .otherwise(made(url, status))
    )


def image_source(local: Column, direct: Column, sitemap: Column, document: Column) -> Column:
    """struct(imagem_url, status_imagem) from four sources by falling priority."""
    made = lambda u, s: F.struct(u.alias("imagem_url"), F.lit(s).alias("status_imagem"))
    web = direct.startswith("http")
    return (
        F.when(local.isNotNull(), made(local, "VALIDATED"))
        .when(web, made(direct, "VALIDATED"))
        .when(sitemap.isNotNull(), made(sitemap, "VALIDATED"))
        .when(document.isNotNull(), made(document, "PDF_EXTRACTED"))
        .otherwise(made(F.lit(None).cast("string"), "SEM_IMAGEM"))
    )


# Names under which stored rows may hold the weighing code and the time of creation, by falling priority.
WEIGHING_CODE = ["tipo_codigo", "codigo", "pesar_cod"]
CREATED = ["criado_em", "created_at", "criadoEm"]


def _first_held(products: DataFrame, names: list[str], default: Column) -> Column:
    """The first text among those of the named columns that the table has."""
    held = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in names if c in products.columns]
    return F.coalesce(*held, default)


def catalogue(products: DataFrame, brands: DataFrame, codes: DataFrame, files: DataFrame) -> DataFrame:
    """Export rows of the products that have a 13-digit EAN; files(path, length) lists local images.

    Rows without a time of creation get the present one.
    """
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    products = products.withColumns({"_weighing": _first_held(products, WEIGHING_CODE, F.lit("")), "_created": _first_held(products, CREATED, now)})
    named = brands.select(F.col("id").alias("marca_id"), F.col("nome").alias("marca_nome"))
    by_product = codes_by_product(codes).withColumnRenamed("produto_id", "id")
    local = files.where("length > 1000").select(F.regexp_extract("path", r"([0-9]{13})\.webp$", 1).alias("ean")).where("ean <> ''").distinct().withColumn("_local", F.lit(True))
    rows = products.join(by_product.where("ean is not null"), "id").join(named, "marca_id", "left").join(local, "ean", "left")
    image = image_decision(F.col("imagem_url"), F.col("status_imagem"), F.coalesce("_local", F.lit(False)), F.concat(F.lit("/imagens_produtos/"), F.col("ean"), F.lit(".webp")))
    text = description_of(F.col("descricao_padronizada"), F.col("descricao_original"))
    brand = F.coalesce("marca_nome", F.lit("N/D"))
    return rows.withColumn("_image", image).select(
        "id",
        F.coalesce("marca_id", F.lit("")).alias("marcaId"),
        brand.alias("marcaDescr"),
        F.coalesce("classe", F.lit("")).alias("produtoClasse"),
        F.col("ean").alias("produtoEan"),
        F.coalesce("dun", F.lit("")).alias("produtoDun"),
        F.coalesce("conservacao", F.lit("")).alias("produtoConservacao"),
        text.alias("produtoDescr"),
        "peso_gramas",
        F.coalesce("fracionado", F.lit(False)).alias("fracionado"),
        F.col("_weighing").alias("pesarCod"),
        F.col("_created").alias("criado_em"),
        F.col("_image.imagem_url").alias("imagemUrl"),
        F.col("_image.status_imagem").alias("statusImagem"),
    )


#: Names under which the published file repeats a column.
ALIASES = {"marcaNome": "marcaDescr", "marca_nome": "marcaDescr", "sku": "produtoEan", "title": "produtoDescr", "descricao": "produtoDescr", "imagem_url": "imagemUrl", "status_imagem": "statusImagem", "criadoEm": "criado_em"}


def with_aliases(rows: DataFrame) -> DataFrame:
    return rows.withColumns({alias: F.col(c) for alias, c in ALIASES.items()})


def unpivot_codes(products: DataFrame) -> DataFrame:
    """Up to three barcode rows (SKU, EAN, DUN) of products(id, sku, ean, dun), with packaging labels."""
    row = lambda kind, label, n: F.struct(F.lit(kind).alias("tipo"), F.col(kind.lower()).alias("codigo"), F.lit(label).alias("embalagem"), F.lit(n).alias("quantidade_embalagem"))
    rows = products.select("id", F.inline(F.array(row("SKU", "Unidade", 1), row("EAN", "Unidade", 1), row("DUN", "Caixa", 1))))
    return rows.where(F.coalesce("codigo", F.lit("")) != "")


def kind_of(kind: Column) -> Column:
    k = F.btrim(F.coalesce(kind, F.lit("")))
    return F.when(F.upper(k).contains("EAN"), F.lit("EAN")).when(F.upper(k).contains("DUN"), F.lit("DUN")).otherwise(k)


def code_list(codes: DataFrame, order: str = "ordinal") -> DataFrame:
    """produto_id, codigos: 'tipo: codigo' joined by ' | ' in order."""
    text = F.concat(F.col("tipo"), F.lit(": "), F.col("codigo"))
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t"))))
    return codes.groupBy("produto_id").agg(F.array_join(F.transform(listed, lambda x: x["t"]), " | ").alias("codigos"))


def sheet_rows(products: DataFrame, brands: DataFrame, codes: DataFrame) -> DataFrame:
    """The spreadsheet's rows: names and codes looked up, empty values labelled."""
    named = brands.select(F.col("id").alias("marca_id"), F.col("nome").alias("marca"))
    listed = code_list(codes).withColumnRenamed("produto_id", "id")
    rows = products.join(named, "marca_id", "left").join(listed, "id", "left")
    return rows.select(
        "id",
        F.coalesce("marca", F.lit("N/D")).alias("marca"),
        F.coalesce(text_or(F.col("descricao_padronizada"), F.col("descricao_original")), F.lit("N/D")).alias("descricao"),
        F.coalesce(weight_label(F.col("peso_gramas")), F.lit("Variável")).alias("peso"),
        F.when(F.col("fracionado"), F.lit("Sim")).otherwise(F.lit("Não")).alias("fracionado"),
        F.coalesce("codigos", F.lit("Sem código")).alias("codigos"),
    )


def code_rows(products: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows of the spreadsheet of codes: the product's name beside each code, missing values empty."""
    named = products.select(F.col("id").alias("produto_id"), F.col("descricao_padronizada").alias("produto"))
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in codes.columns else F.lit("").alias(c)
    return codes.join(named, "produto_id", "left").select("id", "produto_id", F.coalesce("produto", F.lit("")).alias("produto"), "tipo", "codigo", empty("embalagem"), empty("quantidade_embalagem"), empty("criado_em"))


def image_subset(rows: DataFrame, files: DataFrame, tokens: list[str], family: str) -> DataFrame:
    """Of export rows, those of a family of brands (by parts of their names) that have a local file or a web address.

    files(path) lists local images, named by their EAN; empty values are labelled.
    """
    brand = F.btrim(F.coalesce("marcaDescr", F.lit("")))
    member = F.exists(F.array(*map(F.lit, tokens)), lambda t: F.contains(F.lower(brand), t))
    local = files.select(F.regexp_extract("path", r"([0-9]+)\.webp$", 1).alias("produtoEan")).where("produtoEan <> ''").distinct().withColumn("_local", F.lit(True))
    joined = rows.where(member).join(local, "produtoEan", "left").withColumn("_local", F.coalesce("_local", F.lit(False)))
    url = F.btrim(F.coalesce("imagemUrl", F.lit("")))
    shown = lambda c, label: text_or(F.col(c), F.lit(label))
    return joined.where(F.col("_local") | url.startswith("http")).select(
        text_or(F.col("id"), F.col("produtoEan")).alias("id"),
        F.col("produtoEan").alias("ean"),
        shown("produtoDun", "N/D").alias("dun"),
        text_or(brand, F.lit(family)).alias("marca"),
        shown("produtoDescr", "N/D").alias("descricao"),
        shown("produtoClasse", "Industrializados").alias("classe"),
        shown("produtoConservacao", "Resfriado").alias("conservacao"),
        F.when(F.col("_local"), F.concat(F.lit("/imagens_produtos/"), F.col("produtoEan"), F.lit(".webp"))).otherwise(url).alias("imagem"),
        F.lit("VALIDATED").alias("status"),
        F.when(F.col("_local"), F.lit("WebP Local (0ms offline)")).otherwise(F.lit("URL Web Oficial")).alias("origem"),
    )
