"""Inputs are checked against their declared schemas before any job runs."""

import pytest

from possum import schemas
from tests.helpers import cli_df, cli_row


def test_require_accepts_extra_columns_and_int_partitions(spark):
    df = spark.createDataFrame([(1, 2, 3)], "ano int, mes int, dia int")
    with pytest.raises(ValueError, match="missing column num_pdv"):
        schemas.require(df, schemas.S_PDV, "s_pdv")
    ok = cli_df(spark, [cli_row("1", 1, "0001", "0000001", "outro", None, None, None, 20240115)])
    assert schemas.require(ok.withColumn("extra", ok["anomesdia"]), schemas.CLI, "cli") is not None


def test_require_rejects_wrong_types(spark):
    bad = spark.createDataFrame(
        [("1", 1, "0001", "0000001", "outro", "2024-01-01", "2024-01-01", None, 20240115)],
        "cnpj string, id_cnpj_eq3 bigint, numero_agencia string, numero_conta string, canal string, "
        "data_aceite_ressegmentacao string, data_abertura_conta string, "
        "data_encerramento_conta date, anomesdia int")
    with pytest.raises(ValueError, match="data_aceite_ressegmentacao: expected date, got string"):
        schemas.require(bad, schemas.CLI, "cli")
