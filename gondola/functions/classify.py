"""Brands, classes and conservation by keyword."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.dictionaries import BRANDS, CLASSES, CONSERVATION, FRIBOI
from gondola.functions.text import slugify


def _brand(name: str, slug: str, holding: str) -> Column:
    return F.struct(F.lit(f"marca_{slug}").alias("id"), F.lit(name).alias("nome"), F.lit(slug).alias("slug"), F.lit(holding).alias("fabricante_id"))


def longest_first(brands: dict) -> list[str]:
    """Keys by falling length; among equals a key of digits first, then the table's order."""
    keys = sorted(brands, key=lambda k: not k.isdigit())
    return sorted(keys, key=lambda k: -len(k))


def brand(raw: Column, title: Column, holding: str = FRIBOI, brands: dict = BRANDS) -> Column:
    """struct(id, nome, slug, fabricante_id): by the raw brand, else by the longest key in the title, else made up from the raw brand."""
    low, text = F.btrim(F.lower(F.coalesce(raw, F.lit("")))), F.btrim(F.lower(F.coalesce(title, F.lit(""))))
    out = F.when(F.lit(False), _brand("", "", ""))
    for key, (name, slug, owner) in brands.items():
        out = out.when(low == key, _brand(name, slug, owner))
    for key in longest_first(brands):
        out = out.when(text.rlike(f"(?:^|[^a-z0-9à-ÿ]){key}(?:$|[^a-z0-9à-ÿ])"), _brand(*brands[key]))
    given = F.coalesce(raw, F.lit("")) != ""
    slug = F.when(given, slugify(raw)).otherwise(F.lit("brf"))
    made = F.struct(
        F.concat(F.lit("marca_"), slug).alias("id"), F.when(given, raw).otherwise(F.lit("BRF")).alias("nome"), slug.alias("slug"), F.lit(holding).alias("fabricante_id")
    )
    return out.otherwise(made)


def compatible(a: Column, b: Column) -> Column:
    """Whether two brands belong to one holding; empty ones don't."""
    given = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    return given & (brand(a, F.lit(""))["fabricante_id"] == brand(b, F.lit(""))["fabricante_id"])


def _first_match(text: Column, table: list[tuple[str, str]], otherwise: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for label, pattern in table:
        out = out.when(text.rlike(pattern), F.lit(label))
    return out.otherwise(otherwise)


def _all_text(title: Column, raw_class: Column, raw_conservation: Column) -> Column:
    return F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in (title, raw_class, raw_conservation)]))


def conservation(title: Column, raw_class: Column, raw_conservation: Column) -> Column:
    return _first_match(_all_text(title, raw_class, raw_conservation), CONSERVATION, F.lit("Resfriado"))


def product_class(title: Column, raw_class: Column, raw_conservation: Column) -> Column:
    given = F.when(F.btrim(raw_class) != "", F.concat(F.upper(F.substring(raw_class, 1, 1)), F.lower(F.substring(raw_class, 2, 1 << 20))))
    return _first_match(_all_text(title, raw_class, raw_conservation), CLASSES, F.coalesce(given, F.lit("Bovinos")))
