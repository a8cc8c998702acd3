"""Queries over the pipeline's tables, by name, and the SQL to check them with."""

from . import readside, singleturn, textside, vectorside  # noqa: F401
from .base import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
