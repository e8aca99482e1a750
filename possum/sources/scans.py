"""Snapshot scans.  Each is a ``where`` over partition columns, so on a
partitioned table Catalyst turns it into ``PartitionFilters`` and reads only
the matching day folders; on anything else it is a pushed-down filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import snapshot_int


def scan_upto(df: DataFrame, execute_date: int, day: Column | None = None) -> DataFrame:
    """History up to and including the run day (``ano/mes/dia`` partitions)."""
    day = snapshot_int() if day is None else day
    return df.where(day <= F.lit(execute_date))


def scan_snapshot(df: DataFrame, execute_date: int, column: str = "anomesdia") -> DataFrame:
    """The single snapshot of the run day (int ``anomesdia`` partition)."""
    return df.where(F.col(column) == F.lit(execute_date))


def scan_since(df: DataFrame, floor: int, column: str = "anomesdia") -> DataFrame:
    """All snapshots on or after ``floor``."""
    return df.where(F.col(column) >= F.lit(floor))


def extract(source: DataFrame | str, predicate: str | Column | None = None,
            columns: Sequence[str] | None = None, alias: str | None = None,
            spark: SparkSession | None = None) -> DataFrame:
    """Catalog-table extractor: optional partition predicate, optional SQL column list.

    ``source`` is a table name (``db.table``, read with ``spark.table``) or a
    DataFrame.  ``alias`` names the source so that qualified expressions such
    as ``PDV.cod_cnae`` resolve.  The predicate is applied before the
    projection so it can reach partition columns the projection drops.
    """
    if isinstance(source, str):
        if spark is None:
            spark = SparkSession.getActiveSession()
        df = spark.table(source)
    else:
        df = source
    if alias:
        df = df.alias(alias)
    if predicate is not None:
        df = df.where(predicate)
    if columns:
        df = df.selectExpr(*columns)
    return df
