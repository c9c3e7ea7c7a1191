"""Every registered query and, where SQL can say the same, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewatch.session import prepare


def _modules():
    from tradewatch.queries import accounts, catalog, detection, ingest, notify, reports

    return detection, ingest, catalog, notify, accounts, reports


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def prepared(query):
        return lambda spark, sf_dir: query(prepare(spark), sf_dir)

    return {name: prepared(query) for module in _modules() for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _modules() for name, sql in module.ORACLES.items()}
