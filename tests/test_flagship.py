"""Flagship: eligibility (FIL6), join grain (N8), establishment miss, published columns."""

import datetime as dt

from possum.operators import flagship as FL
from possum.operators.estab import latest_estab
from possum.operators.pdv import latest_pdv, pdv_history
from tests.helpers import estb_df, estb_row, pdv_df, pdv_row

D = 20240115
TAX = 1230000000191


def _accounts(spark, rows):
    return spark.createDataFrame(
        rows, "numero_cnpj_completo string, numero_unico_cliente bigint, agencia_conta string, "
              "jornada string, data_abertura_conta_emps date, data_encerramento_conta_emps date, "
              "flag_conta_ativa boolean")


def test_eligibility_rule(spark):
    df = spark.createDataFrame(
        [(1, 0, 0), (2, 20231001, 0), (3, 20230901, 0), (4, 20230901, 20230902),
         (5, 20230901, 20230901), (6, None, None)],
        "id int, dat_can_pdv int, dat_rtvc_pdv int")
    kept = sorted(r.id for r in FL.eligible(df, 20231001).collect())
    assert kept == [1, 2, 4, 5, 6]


def test_flagship_grain_and_left_join(spark):
    s_pdv = pdv_df(spark, [pdv_row(1, "20240110", 1), pdv_row(2, "20240110", 2, estb=999000191),
                           pdv_row(3, "20240110", 3, can="2023-01-01")])
    latest = latest_pdv(pdv_history(s_pdv, D, keep=("seq",)), ("seq",))
    estab = latest_estab(estb_df(spark, [estb_row(TAX, "20240101", 1, cidade=" OLD "),
                                         estb_row(TAX, "20240105", 2, cidade=" NEW ")]), ("seq",))
    accounts = _accounts(spark, [
        ("01230000000191", 10, "0001_0000001", "onboarding", dt.date(2024, 1, 1), None, True),
        ("01230000000191", 11, "0001_0000002", "one_itau", dt.date(2024, 1, 1), None, True),
        ("01230000000191", 12, "0001_0000003", "one_itau", dt.date(2024, 1, 1), dt.date(2024, 1, 2), False),
        ("00000999000191", 13, "0002_0000004", "one_itau", dt.date(2024, 1, 1), None, True),
    ])
    out = FL.pdv_emps(latest, accounts, estab, 20231001)
    assert out.columns == [dst for _, dst in FL.PUBLISHED]
    rows = sorted((r.numero_ponto_venda, r.numero_unico_cliente, r.numero_agencia, r.numero_conta,
                   r.nome_cidade_estabelecimento, r.anomesdia, r.data_atualizacao_ponto_venda)
                  for r in out.collect())
    # PDV 1 repeats per active account of its tax id; PDV 2 has no establishment;
    # PDV 3 was cancelled before the floor and is not eligible.
    assert rows == [(1, 10, "0001", "0000001", "NEW", D, 20240110),
                    (1, 11, "0001", "0000002", "NEW", D, 20240110),
                    (2, 13, "0002", "0000004", None, D, 20240110)]


def test_short_branch_and_account_numbers_split_by_position(spark):
    s_pdv = pdv_df(spark, [pdv_row(1, "20240110", 1)])
    latest = latest_pdv(pdv_history(s_pdv, D, keep=("seq",)), ("seq",))
    estab = latest_estab(estb_df(spark, [estb_row(TAX, "20240101", 1)]), ("seq",))
    accounts = _accounts(spark, [
        ("01230000000191", 10, "12_345", "x", None, None, True),          # short parts
        ("01230000000191", 11, "0001_00000012345", "x", None, None, True),  # long account
    ])
    got = sorted((r.numero_unico_cliente, r.numero_agencia, r.numero_conta)
                 for r in FL.pdv_clients(latest, accounts, estab).collect())
    # Fixed positions 1-4 and 6-12 of the key, as published.
    assert got == [(10, "12_3", "5"), (11, "0001", "0000001")]
