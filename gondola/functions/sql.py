"""Scalar functions for SQL: their bodies are SQL expressions, so Catalyst puts them into the plan."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name and arguments -> result, body; later ones use earlier ones.
FUNCTIONS = {
    "gs1_digits(code STRING)": ("STRING", "regexp_replace(code, '[^0-9]', '')"),
    "gs1_check_digit(code STRING)": (
        "STRING",
        "CAST((10 - aggregate(sequence(1, length(code)), 0, (s, i) -> s + CAST(substring(code, i, 1) AS INT) * IF((length(code) - i) % 2 = 0, 3, 1)) % 10) % 10 AS STRING)",
    ),
    "gs1_without_zero(code STRING)": ("STRING", "CASE WHEN length(code) = 13 AND code RLIKE '^07(89|90)' THEN substring(code, 2) ELSE code END"),
    "gs1_completed(code STRING)": ("STRING", "CASE WHEN length(code) >= 13 THEN code ELSE concat(lpad(code, 12, '0'), gs1_check_digit(lpad(code, 12, '0'))) END"),
    "gs1_ean13(code STRING)": ("STRING", "gs1_completed(gs1_without_zero(gs1_digits(code)))"),
}


def register(spark: SparkSession) -> None:
    """Temporary functions of the session: gs1_ean13(code) is the stored procedure's EAN-13, gs1_check_digit(code) the mod-10 digit behind 12 or 13 digits."""
    for head, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
