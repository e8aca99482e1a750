"""Random small inputs: Spark operators vs the oracle's SQL chain in DuckDB.

The inputs use tiny value domains, so keys collide, dates tie, snapshots
repeat and NULLs appear everywhere the schema allows.  ``max_group_rows`` is
set tiny so the skew-split path runs too.
"""

import datetime as dt
import random

import duckdb
import pyarrow as pa
import pytest

from checks import oracle_sql as O
from checks.compare import rows_of
from possum import schemas
from possum.operators import clients as C
from possum.operators import pdv as P
from possum.operators import revenue as R
from possum.plans.queries import for_compare
from possum.sources.fixtures import FIXTURE_PARAMS as FP
from tests.helpers import PDV_SCHEMA

SEEDS = [1, 2, 3]


def _pick(rnd, values, p_null=0.0):
    return None if rnd.random() < p_null else rnd.choice(values)


def _cli_rows(seed, n=400):
    rnd = random.Random(seed)
    days = [20240101, 20240110, 20240114, 20240115, 20240115]
    dates = [dt.date(2023, 12, 1) + dt.timedelta(days=i) for i in range(0, 60, 7)]
    rows = []
    for _ in range(n):
        rows.append((
            _pick(rnd, ["00000000000191", "00000010000191", "00000020000191"], 0.05),
            _pick(rnd, [1, 2, 3], 0.05),
            _pick(rnd, ["0000", "0001", "0002", "0003", "0004"], 0.03),
            _pick(rnd, ["0000000", "0000005", "0000025", "0000041", "0000042", "0000061", "0000081"], 0.03),
            _pick(rnd, ["resseg in", "resseg out", "onboarding", "outros", "outro"], 0.1),
            _pick(rnd, dates, 0.2),
            _pick(rnd, dates, 0.1),
            _pick(rnd, dates + [dt.date(9999, 12, 31)] * 3, 0.3),
            rnd.choice(days),
        ))
    # Whole-row duplicates on other snapshot days.
    rows += [r[:-1] + (20240102,) for r in rows[:40]]
    return rows


def _pdv_rows(seed, n=300):
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        d = rnd.choice(["20231230", "20240101", "20240110", "20240115", "20240116"])
        rows.append((
            _pick(rnd, [1, 2, 3, 4, 5, 6], 0.03),
            _pick(rnd, [1230000000191, 1240000000191, 5], 0.05),
            _pick(rnd, [" 1 ", "2", "  "], 0.1),
            _pick(rnd, [1, 2], 0.1), _pick(rnd, [3, 4], 0.1), _pick(rnd, [0, 1], 0.1),
            _pick(rnd, ["2020-01-01", "2021-05-05"], 0.1),
            _pick(rnd, ["2023-09-30", "2023-10-01", "2024-01-05", "", "bad"], 0.3),
            _pick(rnd, ["2023-09-29", "2023-10-02", "2024-01-06", ""], 0.5),
            d[:4], str(int(d[4:6])), str(int(d[6:])), seq * 7 % 1000,
        ))
    return rows


def _arrow(rows, schema):
    types = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "date": pa.date32()}
    fields = [(f.name, types[f.dataType.simpleString()]) for f in schema.fields]
    cols = list(zip(*rows))
    return pa.table({name: pa.array(list(col), type=t) for (name, t), col in zip(fields, cols)})


def _compare(df, con, sql):
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


@pytest.mark.parametrize("seed", SEEDS)
def test_client_accounts_random(spark, seed):
    rows = _cli_rows(seed)
    cli = spark.createDataFrame(rows, schemas.CLI)
    con = duckdb.connect()
    con.register("cli", _arrow(rows, schemas.CLI))
    chain = O.with_(*O.CLIENT_CTES)
    out = C.client_accounts_from(cli, FP.execute_date, FP.excluded_accounts, FP.journey_to_outros,
                                 FP.journey_to_onboarding, max_group_rows=3)
    _compare(for_compare(out), con, chain + O.ACCOUNTS_SELECT)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("method", ["auto", "window", "sorted"])
def test_pdv_normalised_random(spark, seed, method):
    rows = _pdv_rows(seed)
    s_pdv = spark.createDataFrame(rows, PDV_SCHEMA)
    con = duckdb.connect()
    con.register("s_pdv", _arrow(rows, PDV_SCHEMA))
    hist = P.pdv_history(s_pdv, FP.execute_date, keep=("seq",))
    out = P.pdv_normalised(hist, ("seq",), method, max_group_rows=5)
    _compare(out, con, O.with_(*O.PDV_CTES) + "SELECT * FROM norm")
    latest = P.latest_pdv(hist, ("seq",))
    _compare(latest, con, O.with_(*O.PDV_CTES) + f"SELECT {O.NORM_COLS} FROM norm WHERE index_num = 1")


@pytest.mark.parametrize("seed", SEEDS)
def test_revenue_matrix_random(spark, seed):
    from decimal import Decimal
    rnd = random.Random(seed)
    rows = [(_pick(rnd, [1, 2, 3, 4], 0.05),
             rnd.choice([20230301, 20230415, 20231201, 20231231, 20240101, 20240115, 20240201]),
             None if rnd.random() < 0.1 else Decimal(rnd.randrange(-5000, 20000)) / 100)
            for _ in range(120)]
    tx = spark.createDataFrame(rows, schemas.TX)
    con = duckdb.connect()
    con.register("tx", pa.table({
        "numero_ponto_venda": pa.array([r[0] for r in rows], pa.int64()),
        "anomesdia": pa.array([r[1] for r in rows], pa.int32()),
        "valor_transacao": pa.array([r[2] for r in rows], pa.decimal128(18, 2))}))
    for build in (R.revenue_matrix, R.revenue_matrix_two_step):
        _compare(for_compare(build(tx, FP.as_of)), con, O.with_(O.MONTHLY) + O.MATRIX)


def _estb_rows(seed, n=200):
    rnd = random.Random(seed + 100)
    rows = []
    for seq in range(n):
        d = rnd.choice(["20231230", "20240101", "20240110", "20240115", "20240120"])
        rows.append((_pick(rnd, [1230000000191, 1240000000191, 1250000000191], 0.05),
                     _pick(rnd, ["SP", "RJ"], 0.1), _pick(rnd, [" A ", "B", " "], 0.1),
                     _pick(rnd, ["00001001", "123", "0"], 0.1),
                     d[:4], str(int(d[4:6])), str(int(d[6:])), seq))
    return rows


@pytest.mark.parametrize("seed", SEEDS)
def test_flagship_random(spark, seed):
    from possum.operators import flagship as FL
    from possum.operators.estab import latest_estab
    from tests.helpers import ESTB_SCHEMA

    pdv_rows = _pdv_rows(seed)
    estb_rows = _estb_rows(seed)
    rnd = random.Random(seed + 7)
    # Client tax ids drawn from the same small set the points of sale use.
    taxes = ["01230000000191", "01240000000191", "00000000000005", None]
    cli_rows = [(rnd.choice(taxes),) + r[1:] for r in _cli_rows(seed)]
    con = duckdb.connect()
    con.register("s_pdv", _arrow(pdv_rows, PDV_SCHEMA))
    con.register("s_estb", _arrow(estb_rows, ESTB_SCHEMA))
    con.register("cli", _arrow(cli_rows, schemas.CLI))
    s_pdv = spark.createDataFrame(pdv_rows, PDV_SCHEMA)
    s_estb = spark.createDataFrame(estb_rows, ESTB_SCHEMA)
    cli = spark.createDataFrame(cli_rows, schemas.CLI)
    latest = P.latest_pdv(P.pdv_history(s_pdv, FP.execute_date, keep=("seq",)), ("seq",))
    accounts = C.client_accounts_from(cli, FP.execute_date, FP.excluded_accounts,
                                      FP.journey_to_outros, FP.journey_to_onboarding)
    estab = latest_estab(s_estb, ("seq",))
    out = for_compare(FL.pdv_emps(latest, accounts, estab, FP.cancel_floor), ("codigo_cep",))
    sql = O.with_(*O.PDV_CTES, O.ESTAB, *O.CLIENT_CTES, O.PDV_ACCOUNTS) + O.PUBLISHED
    assert out.count() > 0
    _compare(out, con, sql)
