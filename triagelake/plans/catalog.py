"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from triagelake.plans import registry
from triagelake.plans import tables as _tables  # noqa: F401  registers its queries
from triagelake.plans import triage as _triage  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return registry.all_queries()


def oracle_sql() -> dict[str, str]:
    return registry.all_sql()
