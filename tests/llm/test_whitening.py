"""Spectrum slicing against numpy's eigenvalues, whitening against plain Python integers."""

import numpy as np
import pytest

import __spark_entry__ as E
from possum.llm import whitening as W
from tests.conftest import SF_SMALL


def symmetric(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("seed", range(6))
def test_inertia_counts_signs(seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((17, 17))
    a = a + a.T
    if seed % 2:
        np.fill_diagonal(a, 0)  # needs pivots of size 2
    e = np.linalg.eigvalsh(a)
    assert W.inertia(a) == ((e > 0).sum(), (e < 0).sum(), 0)
    assert W.inertia(np.zeros((3, 3))) == (0, 0, 3)


@pytest.mark.parametrize("values", [
    list(range(1, 31)), [5.0] * 4 + [3.0] * 5 + [1.0] * 6, [1e6, 1.0, 1e-3, 1e-4, 1e-4 + 1e-9] + [1e-6] * 9,
    [2.0, 2.0 - 1e-13, 2.0 - 2e-13, 1.0, 0.5], [7.0, 3.0], [4.0], [9.0] + [0.0] * 11, [1.0] * 20,
    [1.0 + 1e-7 * i for i in range(20)],
])
def test_leading_pairs(values):
    a = symmetric(values)
    e, v = W.leading_pairs(a)
    want = np.sort(values)[::-1]
    want = want[want > 1e-9][:8]
    assert len(e) == len(want) and np.allclose(e, want, rtol=0, atol=1e-12 * want[0])
    assert np.allclose(v.T @ v, np.eye(len(e)), atol=1e-10)
    assert np.abs(a @ v - v * e).max() < 1e-11 * want[0]


def brute(rows, many=8):
    x = [[int(np.floor(np.float64(c) * 1024)) + 100000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    y = np.array([[(n * a - b) / n for a, b in zip(r, s)] for r in x])
    cov = y.T @ y / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:many], v[:, ::-1][:, :many]
    return n, deviation, (y @ v) / np.sqrt(e), e / np.trace(cov)


def check(got, rows):
    n, deviation, white, explained = brute(rows)
    by = {(r["vec_id"], r["component"]): r for r in got}
    m = white.shape[1]
    assert len(got) == len(by) == len(rows) * m
    for k in range(m):
        mine = np.array([by[i, k + 1]["whitened"] for i, _ in rows])
        sign = np.sign(mine @ white[:, k])
        assert np.allclose(mine, sign * white[:, k], atol=1e-8)
        assert all(abs(by[i, k + 1]["explained"] / explained[k] - 1) < 1e-9 for i, _ in rows)
    assert all(by[i, k]["deviation"] == q and by[i, k]["n"] == n
               for (i, _), q in zip(rows, deviation) for k in range(1, m + 1))
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-10


def test_query_matches_brute_force(spark):
    rows = [tuple(r)[:2] for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    check(E.queries()["op11_embedding_whitening"](spark, SF_SMALL).collect(), rows)


SCHEMA = "vec_id bigint, embedding array<float>, n string, i string, row int, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "n", None, 1, "c") for i, v in rows], SCHEMA)


def test_odd_tables(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(np.float32(c)) for c in rng.standard_normal(3) * (1, 2, 5)]) for i in range(20)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]),
           (104, [1.0, float("inf"), 2.0]), (105, [float("-inf"), 1.0, 2.0]), (106, [1.0, 2.0]),
           (107, [1.0, 2.0, 3.0, 4.0]), (108, [3e38, 0.0, 0.0])]
    got = W.whiten(frame(spark, good + odd))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]
    check(got.collect(), good)
    # Null ids and repeated rows: one row each and component.
    twice = W.whiten(frame(spark, [(None, v) for _, v in good] + good)).collect()
    assert len(twice) == 2 * 3 * len(good) and {r["n"] for r in twice} == {40}
    for rows in ([], odd[:6], good[:1], [good[0]] * 5):
        assert W.whiten(frame(spark, rows)).collect() == []
    flat = W.whiten(frame(spark, [(i, [v[0], 2.0, v[0]]) for i, v in good])).collect()
    assert {r["component"] for r in flat} == {1} and len(flat) == 20


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**40 * (i + 1)), float(i * i)]) for i in range(4)]
    got = W.whiten(frame(spark, rows)).collect()
    assert {r["deviation"] for r in got} == {None}
    rows = [(i, [float(2**16 * (i + 1)), float(i * i)]) for i in range(4)]
    check(W.whiten(frame(spark, rows)).collect(), rows)
