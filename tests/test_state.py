"""The stored history state equals the full recompute for any split of days."""

import os
import random

import pytest

from possum.functions.columns import snapshot_int
from possum.operators.pdv import latest_pdv, pdv_history, pdv_status
from possum.operators.state import BASE, HistoryState, days_of
from tests.helpers import pdv_df, pdv_row

DAYS = [20231130, 20231201, 20231231, 20240101, 20240115, 20240116, 20240131, 20240201, 20240229]


def _rows(rng, days=DAYS, n=120):
    out = []
    for i in range(n):
        key = 1 if i % 3 == 0 else rng.choice([2, 3, 4, 5, None])   # a third of the rows in one key
        can, rtvc = (rng.choice([None, "", "bad", "2023-12-05", "2024-01-20 x", "2023-10-01"]) for _ in range(2))
        out.append(pdv_row(key, str(rng.choice(days)), i, can=can, rtvc=rtvc, mot=rng.randrange(4),
                           estb=rng.choice([1230000000191, None, 7])))
    return out


def _same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def _check(state, s_pdv, run_day, read):
    seen = s_pdv.where(snapshot_int().isin(read))
    want = latest_pdv(pdv_history(seen, run_day, keep=("seq",)), ("seq",))
    assert _same(want, state.latest(s_pdv, run_day))
    assert _same(pdv_status(seen, run_day), state.status(s_pdv, run_day))


@pytest.mark.parametrize("seed", range(3))
def test_any_split_of_days(spark, scratch_dir, seed):
    rng = random.Random(seed)
    s_pdv = pdv_df(spark, _rows(rng))
    state = HistoryState(spark, os.path.join(scratch_dir, "state"), ("seq",))
    days = days_of(s_pdv)
    assert days == sorted(set(days)) and set(days) <= set(DAYS)
    rng.shuffle(days)                                     # late days come after later ones
    read = []
    while days:
        n = rng.randint(1, 4)
        part, days = days[:n], days[n:]
        state.advance(s_pdv, [*part, *rng.sample(read, min(len(read), 1))])   # and some are read again
        read += part
        if rng.random() < 0.4:
            state.fold(rng.choice([202311, 202312, 202401]))
    assert state.days() == sorted(read)
    for run_day in (20231201, 20240115, 20240229, 20240301):
        _check(state, s_pdv, run_day, [d for d in read if d <= run_day])


def test_rerun_day_that_lost_and_changed_rows(spark, scratch_dir):
    rng = random.Random(9)
    rows = _rows(rng)
    state = HistoryState(spark, os.path.join(scratch_dir, "state"), ("seq",))
    state.advance(pdv_df(spark, rows), DAYS)
    state.fold(202312)
    _check(state, pdv_df(spark, rows), 20240229, DAYS)
    # The day comes again: some rows gone, others new; an old month of the base among them.
    for day in ("20231231", "20240116"):
        y, m, d = day[:4], str(int(day[4:6])), str(int(day[6:]))
        rows = [r for i, r in enumerate(rows) if r[9:12] != (y, m, d) or i % 2]
        rows.append(pdv_row(77, day, 1000, can="2024-05-05"))
        now = pdv_df(spark, rows)
        state.advance(now, [int(day)])
        _check(state, now, 20240229, DAYS)
    state.fold(202401)
    _check(state, now, 20240229, DAYS)
    _check(state, now, 20240110, DAYS[:4])
    # A day without rows any more.
    now = pdv_df(spark, [r for r in rows if r[9:12] != ("2024", "2", "29")])
    state.advance(now, [20240229])
    _check(state, now, 20240229, DAYS)


def test_only_new_day_folders_are_read(spark, scratch_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    rng = random.Random(3)
    path = os.path.join(scratch_dir, "s_pdv")
    pdv_df(spark, _rows(rng)).write.partitionBy("ano", "mes", "dia").parquet(path)
    state = HistoryState(spark, os.path.join(scratch_dir, "state"), ("seq",))
    state.advance(spark.read.parquet(path), DAYS[:-1])
    seen = []
    real = state._rows

    def watched(s_pdv, days):
        out = real(s_pdv, days)
        seen.append((sorted(days), out._jdf.queryExecution().executedPlan().toString()))
        return out

    state._rows = watched
    state.advance(spark.read.parquet(path), [20240229])
    state.latest(spark.read.parquet(path), 20240229).collect()
    assert [d for d, _ in seen] == [[20240229]]
    filters = seen[0][1].split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "20240229" in filters


def test_base_counts_until_a_month_changes(spark, scratch_dir):
    rng = random.Random(4)
    s_pdv = pdv_df(spark, _rows(rng))
    state = HistoryState(spark, os.path.join(scratch_dir, "state"), ("seq",))
    state.advance(s_pdv, DAYS)
    state.fold(202401)

    def periods():
        seen = []
        real = state._data
        state._data = lambda stored, p: (seen.append(sorted(p)), real(stored, p))[1]
        try:
            state.latest(s_pdv, 20240229)
        finally:
            state._data = real
        return seen

    assert periods() == [[BASE], [202402]]
    state.advance(s_pdv, [20231201])
    assert periods() == [[202311, 202312, 202401, 202402]]


def test_crash_keeps_the_state(spark, scratch_dir, monkeypatch):
    from possum.sources import sinks

    rng = random.Random(5)
    s_pdv = pdv_df(spark, _rows(rng))
    state = HistoryState(spark, os.path.join(scratch_dir, "state"), ("seq",))
    state.advance(s_pdv, DAYS[:5])
    for step, after in (("_write_text", DAYS[:5]), ("_swap", DAYS)):
        with monkeypatch.context() as m, pytest.raises(RuntimeError):
            m.setattr(sinks, step, lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
            state.advance(s_pdv, DAYS[5:])
        assert state.days() == after
        _check(state, s_pdv, 20240229, after)


def test_empty_state_and_no_days(spark, scratch_dir):
    s_pdv = pdv_df(spark, [])
    state = HistoryState(spark, os.path.join(scratch_dir, "state"))
    state.advance(s_pdv, [])
    assert state.days() == [] and state.latest(s_pdv, 20240101).collect() == []
    state.advance(s_pdv, [20240101])
    assert state.days() == [20240101]
    assert state.latest(s_pdv, 20240101).collect() == state.status(s_pdv, 20240101).collect() == []
