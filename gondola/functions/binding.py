"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where value is written and evaluated once however often the body uses it."""
    return F.transform(F.array(value), body)[0]
