"""Deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.dictionaries import KEY_NAMESPACE

# Fixed value: the form of a UUID of versions 1 to 5.
_UUID = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


def uuid5(name: Column, namespace: str = KEY_NAMESPACE) -> Column:
    """UUIDv5 of a natural id; a value that is a UUID passes through; a missing one raises an error."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 2), 16, 10).cast("int").bitwiseAND(F.lit(63)).bitwiseOR(F.lit(128)).cast("long")))
    made = F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 19, 2)),
        F.substring(digest, 21, 12),
    )
    empty = F.raise_error(F.lit("a key needs a name that isn't empty")).cast("string")
    return F.when(F.coalesce(name, F.lit("")) == "", empty).when(name.rlike(_UUID), name).otherwise(made)
