"""GS1 barcodes as Column expressions: check digits, EAN-13 and DUN-14."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.functions.binding import let


def digits(code: Column) -> Column:
    return F.regexp_replace(code.cast("string"), "[^0-9]", "")


def check_digit(code: Column, length: int) -> Column:
    """Mod-10 digit of a code of 12 (weights 1, 3, ...) or 13 digits (weights 3, 1, ...), as a string."""
    total = F.lit(0)
    for i in range(length):
        weight = (1, 3)[(i + (length == 13)) % 2]
        total = total + F.coalesce(F.substring(code, i + 1, 1).try_cast("int"), F.lit(0)) * weight
    return ((10 - total % 10) % 10).cast("string")


def _without_zero(d: Column) -> Column:
    """Digits without the zero in front of a 12-digit code of this country."""
    return F.when((F.length(d) == 13) & d.rlike("^07(89|90)"), F.substring(d, 2, 12)).otherwise(d)


def _unpadded(d: Column) -> Column:
    bare = F.regexp_replace(d, "^0+", "")
    return F.when((F.length(d) > 13) & d.startswith("0") & F.length(bare).isin(12, 13), bare).otherwise(d)


def _completed(d: Column) -> Column:
    return let(F.lpad(d, 12, "0"), lambda t: F.concat(t, check_digit(t, 12)))


def ean13(code: Column) -> Column:
    """EAN-13 of any code: short codes are padded and checked, long ones cut; 13 digits are taken as they are."""
    shaped = lambda c: F.when(F.length(c) <= 12, _completed(c)).otherwise(F.substring(c, 1, 13))
    return let(digits(code), lambda d: F.when(F.length(d) > 0, let(_without_zero(d), lambda c: let(_unpadded(c), shaped))))


def ean13_of_table(code: Column) -> Column:
    """The stored procedure's EAN-13, which leaves codes over 13 digits alone and pads an empty one."""
    return let(digits(code), lambda d: let(_without_zero(d), lambda c: F.when(F.length(c) >= 13, c).otherwise(_completed(c))))


def dun14(dun: Column, ean: Column) -> Column:
    """DUN-14: as given, completed from 13 digits, or derived from an EAN-13."""
    with_check = lambda base: let(base, lambda b: F.concat(b, check_digit(b, 13)))
    derived = let(ean, lambda e: F.when(F.length(e) == 13, with_check(F.concat(F.lit("1"), F.substring(e, 1, 12)))))
    return let(F.coalesce(digits(dun), F.lit("")), lambda d: F.when(F.length(d) == 14, d).when(F.length(d) == 13, with_check(d)).otherwise(derived))


def is_digits(code: Column) -> Column:
    return F.coalesce(F.trim(code).rlike("^[0-9]+$"), F.lit(False))


def has_digits(code: Column, n: int) -> Column:
    return F.coalesce(F.trim(code).rlike(f"^[0-9]{{{n}}}$"), F.lit(False))
