"""All queries of the library outside subpackage llm, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from guildbook.plans import q_accounts, q_entities, q_facts, q_jobs, q_match, q_more, q_pages, q_reports, q_rows, q_watch

MODULES = [q_rows, q_reports, q_match, q_accounts, q_pages, q_more, q_jobs, q_watch, q_entities, q_facts]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all companies."""
    return q_rows.scored(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, (f, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
