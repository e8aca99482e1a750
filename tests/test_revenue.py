"""Revenue matrix: conditional-max meaning (N6, N7) and one- vs two-step agreement."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from possum.operators import revenue as R
from tests.helpers import tx_df

AS_OF = dt.date(2024, 1, 15)


def test_month_keys_cross_year():
    assert R.month_keys(AS_OF, 3) == ["202401", "202312", "202311"]
    assert R.month_keys(dt.date(2024, 12, 31), 1) == ["202412"]
    assert R.month_keys(AS_OF)[-1] == "202304"


@pytest.fixture
def tx(spark):
    return tx_df(spark, [
        (1, 20240103, 10.5), (1, 20240120, 4.5), (1, 20231202, -3.0),    # Dec negative, has others
        (2, 20231105, -7.25),                                              # only a negative month
        (3, 20220101, 100.0),                                              # outside the window
        (4, 20240101, None),                                               # only NULL values
        (4, 20240102, None),
        (5, 20240105, None), (5, 20231205, 2.0),                            # NULL month sum + other
        (None, 20240101, 1.0),                                             # NULL point of sale
    ])


def _by_pdv(df):
    return {r.numero_ponto_venda: [None if v is None else float(v) for v in r[1:]] for r in df.collect()}


def test_matrix_meaning(tx):
    got = _by_pdv(R.revenue_matrix(tx, AS_OF, 3))
    assert got[1] == [15.0, 0.0, 0.0]     # negative December lifted to 0
    assert got[2] == [0.0, 0.0, -7.25]    # sole month keeps its negative value
    assert got[3] == [0.0, 0.0, 0.0]      # present, all zero
    assert got[4] == [None, 0.0, 0.0]     # its month sums to NULL; other months are ELSE 0
    assert got[5] == [0.0, 2.0, 0.0]
    assert got[None] == [1.0, 0.0, 0.0]


def test_one_step_equals_two_step(tx):
    assert _by_pdv(R.revenue_matrix(tx, AS_OF)) == _by_pdv(R.revenue_matrix_two_step(tx, AS_OF))


def test_monthly_revenue(tx):
    got = {(r.numero_ponto_venda, r.anomes): r.faturamento for r in R.monthly_revenue(tx).collect()}
    assert float(got[(1, "202401")]) == 15.0 and got[(4, "202401")] is None


def test_matrix_has_one_exchange(spark, tx):
    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges(R.revenue_matrix(tx, AS_OF)) == 1
    assert exchanges(R.revenue_matrix_two_step(tx, AS_OF)) == 2


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_one_step_equals_two_step_in_both_ansi_modes(spark, tx, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert _by_pdv(R.revenue_matrix(tx, AS_OF)) == _by_pdv(R.revenue_matrix_two_step(tx, AS_OF))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.mark.parametrize("dtype", ["decimal(18,4)", "decimal(10,0)", "decimal(30,2)"])
def test_exact_sums_for_other_decimal_types(spark, tx, dtype):
    other = tx.withColumn("valor_transacao", tx["valor_transacao"].cast(dtype))
    assert _by_pdv(R.revenue_matrix(other, AS_OF)) == _by_pdv(R.revenue_matrix_two_step(other, AS_OF))
    got = {(r.numero_ponto_venda, r.anomes): r.faturamento for r in R.monthly_revenue(other).collect()}
    want = {(r.numero_ponto_venda, r.anomes): r.faturamento for r in other.groupBy(
        "numero_ponto_venda", F.substring(F.col("anomesdia").cast("string"), 1, 6).alias("anomes"))
        .agg(F.sum("valor_transacao").alias("faturamento")).collect()}
    assert got == want


def test_month_filter_is_one_look_up_however_many_months(spark):
    days = [20231231, 20240100, 20240101, 20240131, 20240199, 20240200, 20240301, 20240315, 20240400,
            2024010, 202401011, 0, -1, None]
    df = spark.createDataFrame([(d,) for d in days], "anomesdia int")
    months = [202401, 202403]
    got = [r[0] for r in df.where(R.in_months(df.anomesdia, months)).collect()]
    assert got == [d for d in days if d is not None and any(m * 100 <= d <= m * 100 + 99 for m in months)]

    def comparisons(months):
        plan = df.where(R.in_months(df.anomesdia, months))._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("anomesdia#")
    assert comparisons([202000 + m for m in range(1, 100)]) == comparisons([202001, 202003])


def test_stored_months_match_the_matrix(spark, tx, scratch_dir):
    stored = R.RevenueMonths(spark, f"{scratch_dir}/months")
    stored.replace(tx, [202401, 202311])
    stored.replace(tx, ["202312", 202201])
    assert _by_pdv(stored.matrix(AS_OF, 3)) == _by_pdv(R.revenue_matrix(tx, AS_OF, 3))
