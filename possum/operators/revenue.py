"""Revenue per point of sale and month, and the ten-month matrix."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from .. import schemas
from ..functions.columns import year_month_text
from ..sources.scans import extract
from ..sources.sinks import finish_loads, load

MONEY = "decimal(28,2)"  # sums of decimal(18,2)


def _zero():
    return F.lit(Decimal("0.00"))


def month_keys(as_of: dt.date, months: int = K.REVENUE_MONTHS) -> list[str]:
    """``yyyyMM`` of ``as_of``'s month and the ``months - 1`` before it."""
    base = as_of.year * 12 + as_of.month - 1
    return [f"{(base - i) // 12:04d}{(base - i) % 12 + 1:02d}" for i in range(months)]


def in_months(day: Column, months: list[int]) -> Column:
    """Whether ``day`` (``yyyymmdd``) lies in one of ``months`` (``yyyyMM``, sorted).

    One look-up of the row's month, however many are wanted: a range for each
    would be evaluated one by one, in code too long for the JVM to compile.
    """
    return (day.between(months[0] * 100, months[-1] * 100 + 99)
            & F.floor(day / 100).isin(months))


def monthly_revenue(tx: DataFrame) -> DataFrame:
    """Sum of transaction values per point of sale and ``yyyyMM`` month."""
    return (tx.groupBy("numero_ponto_venda", year_month_text("anomesdia").alias("anomes"))
              .agg(F.sum("valor_transacao").alias("faturamento")))


def revenue_matrix(tx: DataFrame, as_of: dt.date, months: int = K.REVENUE_MONTHS) -> DataFrame:
    """One row per point of sale, columns ``mes_0`` (as_of's month) … ``mes_{n-1}``.

    Meaning, as in the reference: per month group the revenue is summed, then
    ``mes_i = MAX(CASE WHEN month = m_i THEN revenue ELSE 0 END)`` over the
    point of sale's month groups.  So a month is 0 when absent, a negative
    month is lifted to 0 if the point of sale has any other month, and kept
    if it has none.

    Computed in ONE aggregation by point of sale (not two): per target
    month the sum and "is there a row of another month", both combined
    map-side, then the rule above.  One exchange of at most one partial row
    per point of sale and task.  Every point of sale appears, also those
    with no row in the window.
    """
    # The month as an int, once per row.  The text of an int has no leading
    # zero or blank, so comparing ints is comparing the yyyyMM texts.
    return _matrix(tx.select("numero_ponto_venda",
                             year_month_text("anomesdia").cast("int").alias("_ym"),
                             F.col("valor_transacao").alias("_v")), as_of, months)


def _matrix(rows: DataFrame, as_of: dt.date, months: int) -> DataFrame:
    """The matrix from (point of sale, ``_ym``, ``_v``) rows, single or summed."""
    aggs = []
    for i, m in enumerate(month_keys(as_of, months)):
        in_month = F.col("_ym") == F.lit(int(m))
        aggs.append(F.sum(F.when(in_month, F.col("_v"))).cast(MONEY).alias(f"_s{i}"))
        # NULL month compares as "not this month", like the CASE's ELSE.
        aggs.append(F.max(F.when(in_month, F.lit(False)).otherwise(F.lit(True))).alias(f"_o{i}"))
    per_pdv = rows.groupBy("numero_ponto_venda").agg(*aggs)
    cols = []
    for i in range(months):
        total = F.col(f"_s{i}")
        cols.append(F.when(F.col(f"_o{i}"), F.greatest(total, _zero())).otherwise(total)
                     .alias(f"mes_{i}"))
    return per_pdv.select("numero_ponto_venda", *cols)


def revenue_matrix_of(table: str, as_of: dt.date, months: int = K.REVENUE_MONTHS,
                      spark: SparkSession | None = None) -> DataFrame:
    """The matrix of a transaction table (``database.table``); its schema is checked."""
    return revenue_matrix(schemas.require(extract(table, spark=spark), schemas.TX, table), as_of, months)


class RevenueMonths:
    """Month sums per point of sale, stored in ``path`` and replaced month by month.

    A day's matrix then reads one row per point of sale and month instead of
    every transaction, and of months outside the window only who was there.
    Months are replaced by the staged commit of ``sources.sinks``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def replace(self, tx: DataFrame, months: Iterable[str | int]) -> None:
        """Sum the transactions of ``months`` (``yyyyMM``) anew; only these are read
        (by ``anomesdia`` alone, so a partitioned table is pruned).
        A month without transactions any more is emptied."""
        wanted = sorted({int(m) for m in months})
        if not wanted:
            return
        sums = monthly_revenue(tx.where(in_months(F.col("anomesdia"), wanted))).select(
            "numero_ponto_venda", F.col("faturamento").cast(MONEY).alias("faturamento"),
            F.col("anomes").cast("int").alias("mes"))
        # A row without a point of sale marks the month as present.
        marks = (self.spark.createDataFrame([(m, True) for m in wanted], "mes int, marca boolean")
                 .select(F.lit(None).cast("long").alias("numero_ponto_venda"),
                         F.lit(None).cast(MONEY).alias("faturamento"), "mes", "marca"))
        load(sums.withColumn("marca", F.lit(False)).unionByName(marks).hint("rebalance", "mes"),
             path=self.path, partition_by="mes")

    def sums(self) -> DataFrame:
        """numero_ponto_venda, anomes, faturamento: as ``monthly_revenue``."""
        return self._rows().select("numero_ponto_venda", F.col("mes").cast("string").alias("anomes"),
                                   "faturamento")

    def _rows(self) -> DataFrame:
        finish_loads(self.spark, self.path)
        schema = f"numero_ponto_venda bigint, faturamento {MONEY}, marca boolean, mes int"
        return self.spark.read.schema(schema).parquet(self.path).where(~F.col("marca"))

    def matrix(self, as_of: dt.date, months: int = K.REVENUE_MONTHS) -> DataFrame:
        """As ``revenue_matrix`` over all months stored."""
        return _matrix(self._rows().select("numero_ponto_venda", F.col("mes").alias("_ym"),
                                           F.col("faturamento").alias("_v")), as_of, months)


def revenue_matrix_two_step(tx: DataFrame, as_of: dt.date,
                            months: int = K.REVENUE_MONTHS) -> DataFrame:
    """The same matrix as the reference states it: decimal month sums, then a
    conditional maximum per point of sale.  Two exchanges; kept to check and
    time the one-aggregation form against."""
    monthly = (tx.groupBy("numero_ponto_venda", year_month_text("anomesdia").alias("anomes"))
                 .agg(F.sum("valor_transacao").alias("faturamento")))
    cols = [F.max(F.when(F.col("anomes") == F.lit(m), F.col("faturamento")).otherwise(_zero()))
             .alias(f"mes_{i}") for i, m in enumerate(month_keys(as_of, months))]
    return monthly.groupBy("numero_ponto_venda").agg(*cols)
