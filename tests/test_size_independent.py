"""Results that must not depend on sizes: exclusion lists and money sums."""

import datetime as dt
from decimal import Decimal

import pytest

from possum.functions.columns import count_malformed_dates
from possum.operators import clients as C
from possum.operators.revenue import monthly_revenue, revenue_matrix
from tests.helpers import tx_df


@pytest.mark.parametrize("listed, kept", [(["a"], {"b"}), (["a", None], set()), ([], {"a", "b"})])
def test_exclusion_list_of_any_length(spark, monkeypatch, listed, kept):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "agencia_conta string")
    for inline in (10_000, 0):
        monkeypatch.setattr(C, "_INLINE_LIST_MAX", inline)
        got = {r.agencia_conta for r in C.exclude_accounts(df, listed).collect()}
        assert got == kept


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_month_sum_beyond_64_bits(spark, ansi):
    value = Decimal("9999999999999999.99")
    tx = tx_df(spark, [(1, 20240101, value)] * 12 + [(1, 20230101, Decimal("1.00"))])
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        months = {r.anomes: r.faturamento for r in monthly_revenue(tx).collect()}
        row = revenue_matrix(tx, dt.date(2024, 1, 31)).first()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert months["202401"] == row["mes_0"] == value * 12


def test_count_malformed_dates(spark):
    df = spark.createDataFrame([("2024-01-02", "x"), (" ", None), ("2024-1x-02", "")], "a string, b string")
    assert tuple(count_malformed_dates(df, "a", "b").first()) == (1, 1)
