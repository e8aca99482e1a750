"""Projection rules on hand-made rows."""

from pyspark.sql import functions as F

from possum.functions.columns import (account_key, account_of, branch_of, date_text_to_int,
                                      snapshot_int, tax_id14, tax_id_base, year_month_text)


def test_snapshot_int_pads_text_and_ints(spark):
    df = spark.createDataFrame([("2024", "1", "5"), ("2023", "12", "31"), ("2024", "01", "09")],
                               "ano string, mes string, dia string")
    assert [r[0] for r in df.select(snapshot_int()).collect()] == [20240105, 20231231, 20240109]
    ints = spark.createDataFrame([(2024, 1, 5)], "ano int, mes int, dia int")
    assert ints.select(snapshot_int()).first()[0] == 20240105


def test_tax_id_trims_before_padding(spark):
    df = spark.createDataFrame([("  12",), ("12345678901234",), (None,)], "t string")
    rows = df.select(tax_id14("t").alias("a"), tax_id_base("t").alias("b")).collect()
    assert (rows[0].a, rows[0].b) == (12, 0)
    assert (rows[1].a, rows[1].b) == (12345678901234, 12345678)
    assert (rows[2].a, rows[2].b) == (None, None)
    longs = spark.createDataFrame([(1230000000191,)], "t bigint")
    r = longs.select(tax_id14("t"), tax_id_base("t")).first()
    assert (r[0], r[1]) == (1230000000191, 1230000)


def test_date_text_to_int_null_blank_malformed_are_zero(spark):
    vals = [("2024-01-15",), ("2024-01-15 10:11:12",), ("",), ("   ",), (None,), ("garbage",),
            ("2024-1",)]
    df = spark.createDataFrame(vals, "d string")
    got = [r[0] for r in df.select(date_text_to_int("d")).collect()]
    assert got == [20240115, 20240115, 0, 0, 0, 0, 20241]


def test_account_key_is_null_when_a_part_is_null(spark):
    df = spark.createDataFrame([("0001", "0000025"), (None, "1"), ("2", None)],
                               "numero_agencia string, numero_conta string")
    keys = [r[0] for r in df.select(account_key()).collect()]
    assert keys == ["0001_0000025", None, None]
    split = df.select(account_key().alias("k")).select(branch_of("k"), account_of("k")).first()
    assert tuple(split) == ("0001", "0000025")


def test_year_month_text(spark):
    df = spark.createDataFrame([(20240115,)], "d int")
    assert df.select(year_month_text("d")).first()[0] == "202401"


def test_no_python_udf_in_column_plans(spark):
    df = spark.createDataFrame([("2024-01-15", 12)], "d string, t bigint")
    plan = df.select(date_text_to_int("d"), tax_id14(F.col("t")))._jdf.queryExecution().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
