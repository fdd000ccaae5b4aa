"""Every registered query of the terrain and table operators, with the DuckDB SQL that checks it.

Names start with the inventory ids a query covers. Floats are rounded alike on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orogen.plans import detail_queries, io_queries, learning, raster_queries, table_queries
from orogen.plans.features import scale_features
from orogen.plans.inputs import dem


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: features of two scales on the events grid."""
    return scale_features(dem(spark, sf_dir), widths=(3, 7), px=1.0, rows=None)


def _all() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    return raster_queries.QUERIES | table_queries.QUERIES | io_queries.QUERIES | learning.QUERIES | detail_queries.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
