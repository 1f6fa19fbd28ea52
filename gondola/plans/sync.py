"""The core dataflow: staging documents to tables, change logs and an audit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.functions import keys, text
from gondola.functions.barcode import is_digits
from gondola.operators import cdc, dedup, export, merge
from gondola.sources.shared import materialise


@dataclass
class Staging:
    """Rows of all staging documents; every table has file and ordinal (the place in its array)."""

    holdings: DataFrame
    brands: DataFrame
    products: DataFrame
    codes: DataFrame


@dataclass
class Synced:
    products: DataFrame
    brands: DataFrame
    codes: DataFrame
    conflicts: DataFrame
    new: DataFrame
    changed: DataFrame


def prepare(staging: Staging) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(brands, products, codes, conflicts) with UUID keys, of the products that have a numeric code."""
    codes, conflicts = dedup.codes_of_file(staging.codes)
    good = materialise(codes.where(is_digits(F.col("codigo"))), "sync-numeric")
    coded = good.select("file", F.col("produto_id").alias("id")).distinct()
    products = staging.products.join(coded, ["file", "id"], "left_semi")
    used = products.select("file", F.col("marca_id").alias("id")).distinct()
    brands = staging.brands.join(used, ["file", "id"], "left_semi")
    kept = products.select("file", F.col("id").alias("produto_id")).distinct()
    good = good.join(kept, ["file", "produto_id"], "left_semi")
    title = export.description_of(F.col("descricao_padronizada"), F.col("descricao_original"))
    staged = products.withColumns({"_staged": F.col("peso_gramas"), "_title": title, "_fractional": F.col("fracionado")})
    staged = staged.withColumns(text.described(F.col("_title"), F.col("_staged"), F.col("_fractional")))
    weight = F.coalesce("_parsed.grams", "_staged")
    staged = staged.withColumns(
        {
            "id": keys.uuid5(F.col("id")),
            "marca_id": keys.uuid5(F.col("marca_id")),
            "descricao_padronizada": text.description(F.col("_clean"), F.col("_parsed")),
            "peso_gramas": weight,
            "fracionado": F.when(weight > 0, F.coalesce("_fractional", F.lit(False)) | F.col("_parsed.fractional")).otherwise(F.lit(True)),
        }
    ).drop("_staged", "_title", "_fractional", "_clean", "_parsed")
    brands = brands.withColumns({"id": keys.uuid5(F.col("id")), "fabricante_id": keys.uuid5(F.col("fabricante_id"))})
    good = good.withColumns({"id": keys.uuid5(F.col("id")), "produto_id": keys.uuid5(F.col("produto_id")), "tipo": export.kind_of(F.col("tipo"))})
    conflicts = conflicts.withColumns({"id": keys.uuid5(F.col("id")), "produto_id": keys.uuid5(F.col("produto_id"))})
    return brands, staged, good, conflicts


def sync(staging: Staging, products: DataFrame, brands: DataFrame, codes: DataFrame) -> Synced:
    """Stored tables with the staging documents merged in, files in name order, the last one winning.

    Changes are taken against the incoming rows as they come; a stored decision about an image
    outlives them in the merged table only.
    """
    # written once: each is used in several of the results
    new_brands, new_products, new_codes, conflicts = prepare(staging)
    new_brands, new_products, new_codes = (materialise(d, f"sync-{name}") for d, name in ((new_brands, "brands"), (new_products, "products"), (new_codes, "codes")))
    place = ["file", "ordinal"]
    last_brands = dedup.keep_last(new_brands, ["id"], place).select(*brands.columns)
    last_products = dedup.keep_last(new_products, ["id"], place)
    incoming = last_products.select(*products.columns)
    return Synced(
        products=merge.upsert(products, merge.keep_reviewed_images(incoming, products), "id"),
        brands=merge.upsert(brands, last_brands, "id"),
        codes=merge.upsert_codes(codes, new_codes),
        conflicts=conflicts,
        new=cdc.logged(cdc.new_rows(incoming, products), last_brands, new_codes),
        changed=cdc.field_changes(incoming, products),
    )
