"""Keeping the first, last or preferred row of a key; the order is always an explicit column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_first(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_nth = 1").drop("_nth")


def keep_last(df: DataFrame, keys: list, order: list[str]) -> DataFrame:
    return keep_first(df, keys, [F.col(c).desc() for c in order])


def split_duplicates(df: DataFrame, keys: list, order: list) -> tuple[DataFrame, DataFrame]:
    """(kept, lost): first rows by key, and the rest."""
    ranked = df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_nth = 1").drop("_nth"), ranked.where("_nth > 1").drop("_nth")


def codes_of_file(codes: DataFrame, file: str = "file", order: str = "ordinal") -> tuple[DataFrame, DataFrame]:
    """(kept, conflicts): the first row by trimmed code in each file; blank codes vanish, later ones are logged."""
    trimmed = codes.withColumn("_code", F.trim("codigo")).where(F.coalesce("_code", F.lit("")) != "")
    kept, lost = split_duplicates(trimmed, [file, "_code"], [order])
    message = F.concat(F.lit("duplicate code in staging: "), F.col("_code"))
    conflicts = lost.select("id", "produto_id", F.coalesce("tipo", F.lit("DESCONHECIDO")).alias("tipo"), "codigo", message.alias("error_message"))
    return kept.drop("_code"), conflicts


def first_key(*columns: Column) -> Column:
    """The first of several key columns that isn't empty."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])


def last_value(value: Column, order: Column) -> Column:
    """Aggregate: the value of the row that comes last."""
    return F.max_by(value, order)


def first_value(value: Column, order: Column) -> Column:
    return F.min_by(value, order)


def preferred_code(code: Column, order: Column) -> Column:
    """Aggregate: the last 13-digit code, else the first code."""
    full = F.length(code) == 13
    return F.coalesce(F.max_by(F.when(full, code), F.when(full, order)), F.min_by(code, order))
