"""Snapshots: upserts, deletes and updates as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.operators.dedup import keep_last


def upsert(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows replace existing ones of the same key; one exchange a side."""
    return existing.join(incoming.select(key), key, "left_anti").unionByName(incoming)


def upsert_codes(existing: DataFrame, incoming: DataFrame, file: str = "file", order: str = "ordinal") -> DataFrame:
    """Codes are unique: of several files the last owns the code, and takes it from whoever had it."""
    owners = keep_last(incoming, ["codigo"], [file, order]).select(*existing.columns)
    return upsert(existing, owners, "codigo")


def delete_ids(table: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return table.join(ids.select(key), key, "left_anti")


def update_where(table: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    return table.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def update_from(table: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows found in updates take its values, also null ones."""
    new = updates.select(key, F.struct(*columns).alias("_new"))
    joined = table.join(new, key, "left")
    return joined.withColumns({c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)) for c in columns}).select(*table.columns)


def keep_reviewed_images(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """A stored decision (aprovado, reprovado) about an image outlives what comes in."""
    stored = existing.select("id", F.col("status_imagem").alias("_status"), F.col("imagem_url").alias("_image"))
    reviewed = F.coalesce(F.col("_status").isin("aprovado", "reprovado"), F.lit(False))
    joined = incoming.join(stored, "id", "left")
    return joined.withColumns(
        {
            "imagem_url": F.when(reviewed, F.coalesce(F.nullif("_image", F.lit("")), "imagem_url")).otherwise(F.col("imagem_url")),
            "status_imagem": F.when(reviewed, F.col("_status")).otherwise(F.col("status_imagem")),
        }
    ).select(*incoming.columns)


def repair_codes(codes: DataFrame, normalise) -> DataFrame:
    """Drop EANs that aren't 13 long if their normal form is there already; bring the rest into it."""
    odd = (F.col("tipo") == "EAN") & (F.length("codigo") != 13)
    full = codes.where((F.col("tipo") == "EAN") & (F.length("codigo") == 13)).select(F.col("codigo").alias("_norm")).distinct()
    shaped = codes.withColumn("_norm", F.when(odd, normalise(F.col("codigo"))))
    kept = shaped.join(full, "_norm", "left_anti")
    return update_where(kept, odd, {"codigo": F.col("_norm")}).select(*codes.columns)
