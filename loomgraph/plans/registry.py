"""Every query of the engine, by name, with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomgraph.plans import q_catalog, q_extract, q_files, q_graph, q_maintain, q_retrieval, q_router, q_structure, q_text


def modules() -> list:
    return [q_retrieval, q_text, q_structure, q_catalog, q_graph, q_extract, q_files, q_router, q_maintain]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict = {}
    for m in modules():
        out |= m.queries()
    return out


def oracle_sql() -> dict[str, str]:
    out: dict = {}
    for m in modules():
        out |= m.oracle_sql()
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next(iter(queries().values()))(spark, sf_dir)
