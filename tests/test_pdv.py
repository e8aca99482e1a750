"""Point-of-sale history, status, normalisation and latest row."""

import pytest

from possum.operators import pdv as P
from tests.helpers import pdv_df, pdv_row

D = 20240115


@pytest.fixture
def s_pdv(spark):
    rows = [
        pdv_row(1, "20240101", 10, can="2023-05-01"),
        pdv_row(1, "20240110", 11, can="", rtvc="2023-06-01"),
        pdv_row(1, "20240110", 12, can=None),          # same day, later seq: latest
        pdv_row(1, "20240120", 13, can="2024-01-20"),  # after the run day: not read
        pdv_row(2, "20240105", 20, can="garbage"),
        pdv_row(None, "20240105", 30, can="2023-01-01"),
    ]
    return pdv_df(spark, rows)


def test_history_scope_and_columns(s_pdv):
    h = P.pdv_history(s_pdv, D, keep=("seq",))
    rows = {r.seq: r for r in h.collect()}
    assert set(rows) == {10, 11, 12, 20, 30}
    r = rows[11]
    assert (r.dat_can_pdv, r.dat_rtvc_pdv, r.dat_updt, r.anomesdia) == (0, 20230601, 20240110, D)
    assert (r.cnpj14, r.cnpjbas, r.cod_cnae, r.num_cad_grl_ctri_estb) == (
        1230000000191, 1230000, "7", "1230000000191")
    assert rows[20].dat_can_pdv == 0  # malformed → 0


def test_status_keeps_null_key_group(s_pdv):
    got = {r.num_pdv: (r.dat_can_pdv, r.dat_rtvc_pdv) for r in P.pdv_status(s_pdv, D).collect()}
    assert got == {1: (20230501, 20230601), 2: (0, 0), None: (20230101, 0)}


@pytest.mark.parametrize("method", ["auto", "window", "sorted", "join"])
def test_normalised_all_methods(s_pdv, method):
    h = P.pdv_history(s_pdv, D, keep=("seq",))
    got = sorted((r.num_pdv, r.dat_updt, r.index_num, r.dat_can_pdv, r.dat_rtvc_pdv)
                 for r in P.pdv_normalised(h, ("seq",), method).collect())
    # NULL point of sale is dropped (the reference's inner join drops it).
    assert got == [
        (1, 20240101, 3, 20230501, 20230601),
        (1, 20240110, 1, 20230501, 20230601),
        (1, 20240110, 2, 20230501, 20230601),
        (2, 20240105, 1, 0, 0),
    ]


def test_normalised_hot_path_forced(s_pdv):
    h = P.pdv_history(s_pdv, D, keep=("seq",))
    a = sorted(tuple(r) for r in P.pdv_normalised(h, ("seq",), "auto", max_group_rows=1).collect())
    b = sorted(tuple(r) for r in P.pdv_normalised(h, ("seq",), "window").collect())
    assert a == b


def test_latest_pdv_is_index_one(s_pdv):
    h = P.pdv_history(s_pdv, D, keep=("seq",))
    latest = {r.num_pdv: r for r in P.latest_pdv(h, ("seq",)).collect()}
    assert set(latest) == {1, 2}
    assert latest[1].dat_updt == 20240110 and latest[1].dat_can_pdv == 20230501
    norm = [r for r in P.pdv_normalised(h, ("seq",), "window").collect() if r.index_num == 1]
    assert sorted(tuple(r[c] for c in P.LATEST_COLUMNS) for r in norm) == sorted(
        tuple(r[c] for c in P.LATEST_COLUMNS) for r in latest.values())
