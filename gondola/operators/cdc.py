"""Changes between two snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Compared fields with the label shown and the word for an empty value.
TEXT_FIELDS = [
    ("imagem_url", "Imagem (URL)", "Sem imagem"),
    ("status_imagem", "Status da Imagem", "N/D"),
    ("descricao_padronizada", "Descrição", "N/D"),
    ("classe", "Classe", "N/D"),
    ("conservacao", "Conservação", "N/D"),
]
BRAND_FIELD = ("marca_id", "Marca ID", "N/D")


def new_rows(incoming: DataFrame, existing: DataFrame, key: str = "id") -> DataFrame:
    return incoming.join(existing.select(key), key, "left_anti")


def _change(label: str, old: Column, new: Column, empty: str | None) -> Column:
    """A change as struct, null if there is none; null and empty are the same."""
    shown = lambda c: F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit(empty)) if empty else c.cast("string")
    same = old.eqNullSafe(new)
    return F.when(~same, F.struct(F.lit(label).alias("campo"), shown(old).alias("de"), shown(new).alias("para")))


def field_changes(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """id and alteracoes of every row in both snapshots that differs in one of eight fields."""
    old, new = existing.select("id", F.struct("*").alias("_old")), incoming.select("id", F.struct("*").alias("_new"))
    both = new.join(old, "id")
    text = lambda side, c: F.btrim(F.coalesce(F.col(f"{side}.{c}"), F.lit("")))
    changes = [_change(label, text("_old", c), text("_new", c), empty) for c, label, empty in TEXT_FIELDS]
    changes.append(_change("Peso (g)", F.col("_old.peso_gramas"), F.col("_new.peso_gramas"), "N/D"))
    flag = lambda side: F.coalesce(F.col(f"{side}.fracionado"), F.lit(False))
    changes.append(_change("Fracionado", flag("_old"), flag("_new"), None))
    c, label, empty = BRAND_FIELD
    changes.append(_change(label, text("_old", c), text("_new", c), empty))
    found = both.select("id", F.filter(F.array(*changes), lambda x: x.isNotNull()).alias("alteracoes"))
    return found.where(F.size("alteracoes") > 0)


def logged(rows: DataFrame, brands: DataFrame, codes: DataFrame, order: str = "ordinal") -> DataFrame:
    """rows with marca (N/D if unknown), ean and dun as the log shows them: the code of the product's last barcode, whatever its kind."""
    last = codes.groupBy(F.col("produto_id").alias("id")).agg(F.max_by(F.struct("tipo", "codigo"), order).alias("_code"))
    named = brands.select(F.col("id").alias("marca_id"), F.col("nome").alias("marca"))
    out = rows.join(named, "marca_id", "left").join(last, "id", "left")
    return out.withColumns(
        {
            "marca": F.coalesce("marca", F.lit("N/D")),
            "ean": F.coalesce("_code.codigo", F.lit("")),
            "dun": F.coalesce(F.when(F.col("_code.tipo") == "DUN", F.col("_code.codigo")), F.lit("")),
        }
    ).drop("_code")
