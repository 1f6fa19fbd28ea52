"""Integrity rules, the sanitising pass and tenant views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.dictionaries import SANITISE_IMAGES
from gondola.functions.barcode import is_digits
from gondola.functions.web import contains_any
from gondola.operators.merge import update_where, upsert


# Texts of the anomalies' details; a null is shown as null.
NO_CODE = 'Produto "%s" (%s) não possui NENHUM código de barras cadastrado.'
NO_EAN = 'Produto "%s" (%s) possui códigos [%s], mas NENHUM EAN numérico válido!'
NO_TEXT = "descricao_padronizada não é uma string válida: %s"
OBJECT_TEXT = 'descricao_padronizada contém a string corrompida "[object Object]": "%s"'
ODD_WEIGHT = "peso_gramas tem valor anormal: %s"
DUPLICATE = 'Código "%s" está duplicado entre produto %s e produto %s.'
NO_DIGITS = 'Código de barras tipo "%s" contém caracteres não-numéricos: "%s" (produto_id: %s)'
ODD_LENGTH = 'Código de barras tipo "%s" tem tamanho fora do padrão (%s dígitos): "%s" (produto_id: %s)'
SLUG = 'Código marcado como %s é uma string alfanumérica/slug: "%s"'

#: Rows without a code are one group: it is spread over so many keys.
_BLANK_KEYS = 64


def _found(rows: DataFrame, rules: list[tuple]) -> DataFrame:
    """One projection: an anomaly for each rule (category, severity, condition, details) that holds."""
    hits = [
        F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(c).alias("category"), F.lit(s).alias("severity"), F.format_string(*text).alias("details")))
        for c, s, cond, text in rules
    ]
    return rows.select(F.col("id").alias("item_id"), F.inline(F.filter(F.array(*hits), lambda x: x.isNotNull())))


def with_first_owner(codes: DataFrame, order: str = "ordinal") -> DataFrame:
    """codes with _first, struct(order, id, product) of the first row of its (trimmed) code, where several rows hold it.

    Each code's first row is found by aggregation; rows meet it by code, those without a code by one of _BLANK_KEYS.
    """
    place = F.struct(F.col(order), F.col("id"), F.col("produto_id"))
    coded = codes.withColumn("_code", F.btrim(F.coalesce("codigo", F.lit(""))))
    firsts = coded.groupBy("_code").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    keys = F.when(F.col("_code") == "", F.sequence(F.lit(0), F.lit(_BLANK_KEYS - 1))).otherwise(F.array(F.lit(0)))
    firsts = firsts.select("_code", "_first", F.explode(keys).alias("_key"))
    spread = F.when(F.col("_code") == "", F.pmod(F.xxhash64("id", order), F.lit(_BLANK_KEYS))).otherwise(F.lit(0)).cast("int")
    return coded.withColumn("_key", spread).join(firsts, ["_code", "_key"], "left")


def audit(products: DataFrame, codes: DataFrame, order: str = "ordinal") -> DataFrame:
    """category, severity, item_id, details of every anomaly.

    The rule for very short codes is left out: codes that short fail the length rule before it.
    """
    numeric = F.upper("tipo").contains("EAN") & is_digits(F.col("codigo"))
    held = codes.groupBy(F.col("produto_id").alias("id")).agg(F.lit(True).alias("_coded"), F.bool_or(F.coalesce(numeric, F.lit(False))).alias("_ean"))
    # only products without an EAN list their codes
    listed = codes.join(held.where("not _ean").select(F.col("id").alias("produto_id")), "produto_id", "left_semi")
    named = F.struct(F.col(order).alias("o"), F.format_string("%s:%s", F.col("tipo"), F.col("codigo")).alias("t"))
    listed = listed.groupBy(F.col("produto_id").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(named)), lambda x: x["t"]), ", ").alias("_codes"))
    rows = products.join(held, "id", "left").join(listed, "id", "left")
    text = F.col("descricao_padronizada")
    title = F.col("descricao_original") if "descricao_original" in products.columns else F.lit(None).cast("string")
    by_product = _found(
        rows,
        [
            ("PRODUTO_SEM_CODIGO", "CRITICAL", F.col("_coded").isNull(), (NO_CODE, title, F.col("id"))),
            ("PRODUTO_SEM_EAN_NUMERICO", "CRITICAL", ~F.col("_ean"), (NO_EAN, title, F.col("id"), F.col("_codes"))),
            ("DESCRICAO_INVALIDA", "WARNING", F.coalesce(text, F.lit("")) == "", (NO_TEXT, F.when(text == "", F.lit('""')))),
            ("OBJECT_OBJECT_LEAK", "CRITICAL", text.contains("[object Object]"), (OBJECT_TEXT, text)),
            ("PESO_GRAMAS_ANOMALO", "WARNING", F.col("peso_gramas") <= 0, (ODD_WEIGHT, F.col("peso_gramas").cast("string"))),
        ],
    )
    code, kind, owner = F.col("_code"), F.col("tipo"), F.col("produto_id")
    barcode = kind.isin("EAN", "EAN-13", "EAN-8", "DUN", "DUN-14")
    first = F.col("_first")
    later = first.isNotNull() & ~(first[order].eqNullSafe(F.col(order)) & first["id"].eqNullSafe(F.col("id")))
    by_code = _found(
        with_first_owner(codes, order),
        [
            ("CODIGO_DUPLICADO", "CRITICAL", later, (DUPLICATE, code, owner, first["produto_id"])),
            ("EAN_NAO_NUMERICO", "CRITICAL", barcode & ~is_digits(code), (NO_DIGITS, kind, code, owner)),
            ("EAN_TAMANHO_INVALIDO", "WARNING", barcode & is_digits(code) & ~F.length(code).between(8, 14), (ODD_LENGTH, kind, F.length(code).cast("string"), code, owner)),
            ("SLUG_LEAK_EM_CODIGO", "CRITICAL", code.rlike("^[a-zA-Z_]") & ~kind.eqNullSafe("SKU"), (SLUG, kind, code)),
        ],
    )
    return by_product.unionByName(by_code).select("category", "severity", "item_id", "details")


def sanitise(products: DataFrame, codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products, codes): codes that aren't digits go, then products without one; placeholder images are reset."""
    good = codes.where(is_digits(F.col("codigo")))
    kept = products.join(good.select(F.col("produto_id").alias("id")), "id", "left_semi")
    bad = F.coalesce(contains_any(F.col("imagem_url"), SANITISE_IMAGES), F.lit(False))
    return update_where(kept, bad, {"status_imagem": F.lit("sem_imagem"), "imagem_url": F.lit(None).cast("string")}), good


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys (without nulls) held by several rows, with their count."""
    whole = df.where(" and ".join(f"{k} is not null" for k in keys))
    return whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def tenant_view(df: DataFrame, tenant: str | None, superadmin: bool = False, column: str = "empresa_id") -> DataFrame:
    """Rows that a caller may see: its tenant's, or all for a superadmin. The filter reaches the scan."""
    return df if superadmin else df.where(F.col(column) == F.lit(tenant))


def catalogue_view(df: DataFrame, authenticated: bool) -> DataFrame:
    """The shared catalogue: all rows for any authenticated caller, none for others."""
    return df.where(F.lit(authenticated))


def catalogue_write(stored: DataFrame, incoming: DataFrame, superadmin: bool, key: str = "id") -> DataFrame:
    """The shared catalogue after a caller's write: a superadmin's rows replace or join the stored ones, others' are refused."""
    return upsert(stored, incoming.where(F.lit(superadmin)), key)


def may_update_profile(df: DataFrame, caller: str, tenant: str | None, role: str) -> DataFrame:
    """Profiles that a caller may change: its own, its tenant's for an admin, all for a superadmin."""
    allowed = F.lit(role == "superadmin") | (F.col("id") == caller) | (F.lit(role == "admin") & (F.col("empresa_id") == F.lit(tenant)))
    return df.where(allowed)


def profiles_of_users(users: DataFrame) -> DataFrame:
    """Profiles made for new users(id, email, meta JSON), defaults filled in."""
    meta = lambda key, default: F.coalesce(F.get_json_object("meta", f"$.{key}"), default)
    return users.select(
        "id",
        F.get_json_object("meta", "$.empresa_id").alias("empresa_id"),
        meta("nome", F.split("email", "@")[0]).alias("nome"),
        meta("role", F.lit("operador")).alias("role"),
    )
