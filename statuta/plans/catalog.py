"""All named queries outside the training-data subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from statuta.plans import building, completing, restructuring, statutes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**statutes.QUERIES, **building.QUERIES, **completing.QUERIES, **restructuring.QUERIES}
SQL: dict[str, str] = {**statutes.SQL, **building.SQL, **completing.SQL, **restructuring.SQL}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hybrid search over the largest law."""
    return statutes.hybrid_search(spark, sf_dir)
