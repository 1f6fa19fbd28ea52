"""All registered catalogue queries."""

from __future__ import annotations

from gondola.plans import files, markup, relational, report_queries, scalars


def _all() -> dict:
    return {**scalars.QUERIES, **relational.QUERIES, **report_queries.QUERIES, **files.QUERIES, **markup.QUERIES}


def queries() -> dict:
    return {name: run for name, (run, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
