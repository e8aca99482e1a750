"""A hot tax id (a third of all points of sale) is split by AQE in both flagship joins."""

import pytest
from pyspark.sql import functions as F

from possum.operators import flagship as FL

HOT = 1230000000191
SETTINGS = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def tiny_skew_thresholds(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _sides(spark, n=20_000):
    tax = F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("id") * 1000000 + 191)
    latest = spark.range(n).select(
        F.col("id").alias("num_pdv"), tax.alias("cnpj14"), F.lit(1230000).alias("cnpjbas"),
        F.lit(1).alias("cod_mot_can"), F.lit(2).alias("cod_ram_atvd"), F.lit("7").alias("cod_cnae"),
        F.lit(0).alias("cod_gru_ram"), F.lit(0).alias("dat_can_pdv"), F.lit(0).alias("dat_rtvc_pdv"),
        F.lit("2020-01-01").alias("dat_cdst_pdv"), F.lit(20240110).alias("dat_updt"),
        F.lit(20240115).alias("anomesdia"))
    acc_tax = F.when(F.col("id") < 3, F.lit(HOT)).otherwise(F.col("id") * 1000000 + 191)
    accounts = spark.range(200).select(
        F.lpad(acc_tax.cast("string"), 14, "0").alias("numero_cnpj_completo"),
        F.col("id").alias("numero_unico_cliente"), F.lit("0001_0000001").alias("agencia_conta"),
        F.lit("x").alias("jornada"), F.lit(None).cast("date").alias("data_abertura_conta_emps"),
        F.lit(None).cast("date").alias("data_encerramento_conta_emps"),
        F.lit(True).alias("flag_conta_ativa"))
    estab = spark.range(200).select((F.col("id") * 1000000 + 191).alias("cnpj14"),
                                    F.lit("BR").alias("uf"), F.lit("C").alias("cidade"),
                                    F.lit(1).alias("cod_cep"))
    return latest, accounts, estab


def test_hot_tax_id_is_split(spark, tiny_skew_thresholds):
    n = 20_000
    latest, accounts, estab = _sides(spark, n)
    out = FL.pdv_clients(latest, accounts, estab)
    rows = out.collect()
    hot_pdvs = len(range(0, n, 3))
    others = sum(1 for i in range(n) if i % 3 and 3 <= i < 200)
    assert len(rows) == hot_pdvs * 3 + others
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    joins = [line for line in final.splitlines() if "SortMergeJoin" in line]
    assert len(joins) == 2 and all("skew=true" in line for line in joins)


DEFAULTS = ["spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin",
            "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_tax_id_is_cut_into_shares_whatever_the_settings(spark, adaptive):
    """No session setting asks for it: defaults, and adaptive execution switched off."""
    latest, accounts, estab = _sides(spark)
    want = FL.pdv_clients(latest, accounts, estab).collect()
    keys = [*DEFAULTS, "spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in DEFAULTS:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = FL.pdv_clients(latest, accounts, estab, max_group_rows=500)
        got = out.withColumn("p", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    strip = [tuple(r)[:-1] for r in got]
    assert sorted(strip, key=repr) == sorted(map(tuple, want), key=repr)
    hot = [r["p"] for r in got if r["cnpj14"] == HOT]
    largest = max(hot.count(p) for p in set(hot))
    assert len(hot) == 3 * 6667 and len(set(hot)) >= 6 and largest < len(hot) / 2


def test_both_sides_hot(spark):
    """A tax id hot on both sides is a grid of shares; every pair comes out once."""
    latest, accounts, estab = _sides(spark, 300)
    accounts = accounts.withColumn("numero_cnpj_completo", F.lit(f"{HOT:014d}"))
    want = FL.pdv_clients(latest, accounts, estab)
    got = FL.pdv_clients(latest, accounts, estab, max_group_rows=7)
    assert want.count() == 100 * 200
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_null_tax_ids_join_nothing(spark):
    latest, accounts, estab = _sides(spark, 300)
    latest = latest.withColumn("cnpj14", F.when(F.col("num_pdv") % 2 == 0, F.col("cnpj14")))
    for limit in (7, 10**6):
        out = FL.pdv_clients(latest, accounts, estab, max_group_rows=limit)
        assert out.where("cnpj14 IS NULL").count() == 0 and out.count() > 0


def test_colocated_sides_join_without_an_exchange(spark, scratch_dir):
    from possum.sources.colocate import Colocated

    latest, accounts, estab = _sides(spark, 500)
    want = FL.pdv_clients(latest, accounts, estab)
    kept = Colocated(spark, f"colocated_{scratch_dir[-8:].replace('-', '_')}", "cnpj14", scratch_dir, buckets=4)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        sides = (kept.store("latest", latest), kept.store("active", FL.active_accounts(accounts)),
                 kept.store("estab", estab))
        out = FL.pdv_clients_stored(*sides)
        rows = out.collect()
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")
    assert sorted(map(str, rows)) == sorted(map(str, want.collect()))
    assert final.count("SortMergeJoin") == 2 and "Exchange" not in final
    assert all(t in {x.name for x in spark.catalog.listTables()} for t in kept.names)
    kept.drop()


def test_establishment_comes_before_the_accounts_multiply(spark):
    latest, accounts, estab = _sides(spark, 500)
    plan = FL.pdv_clients(latest, accounts, estab)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line.strip(" :+-") for line in plan.splitlines() if "Join" in line]
    assert joins[0].startswith("Join Inner") and joins[1].startswith("Join LeftOuter")
