"""Client-account life cycle on hand-made rows."""

import datetime as dt

import pytest

from possum.operators import clients as C
from tests.helpers import cli_df, cli_row

D = 20240115
EXCLUDED = ("0009_0000009",)
TO_OUTROS = ("0006_0000006",)
TO_ONBOARDING = ("0008_0000008",)


def _d(s):
    return None if s is None else dt.date.fromisoformat(s)


@pytest.fixture
def cli(spark):
    rows = [
        # A: entry, duplicate snapshot, exit, later entry, NULL-channel entry; also on the run day
        cli_row("00000000000001", 1, "0001", "0000001", "resseg in", "2024-01-01", "2023-09-01", None, 20240101),
        cli_row("00000000000001", 1, "0001", "0000001", "resseg in", "2024-01-01", "2023-09-01", None, 20240102),
        cli_row("00000000000001", 1, "0001", "0000001", "resseg out", "2024-01-05", "2023-09-01", None, 20240105),
        cli_row("00000000000001", 1, "0001", "0000001", "onboarding", None, "2024-01-08", None, 20240110),
        cli_row("00000000000001", 1, "0001", "0000001", None, None, "2024-01-09", None, 20240111),
        cli_row("00000000000001", 1, "0001", "0000001", "onboarding", None, "2024-01-08", None, D),
        # B: never left, open sentinel
        cli_row("00000000000002", 2, "0002", "0000002", "outros", None, "2023-02-02", "9999-12-31", D),
        # C: never left resegmentation entry, closed later
        cli_row("00000000000003", 3, "0003", "0000003", "resseg in", "2024-01-03", "2023-01-01", "2024-02-01", D),
        # D: excluded, even though it left
        cli_row("00000000000009", 9, "0009", "0000009", "resseg out", "2024-01-04", "2023-01-01", None, 20240104),
        cli_row("00000000000009", 9, "0009", "0000009", "outro", None, "2023-01-01", None, D),
        # E: no branch number → no key → dropped
        cli_row("00000000000005", 5, None, "0000005", "outro", None, "2023-01-01", None, D),
        # F: resegmentation entry overridden to 'outros'
        cli_row("00000000000006", 6, "0006", "0000006", "resseg in", "2024-01-02", "2022-06-06", None, D),
        # G: NULL channel, never left
        cli_row("00000000000007", 7, "0007", "0000007", None, None, "2023-07-07", None, D),
        # H: one entry, two exits (the second exit has no entry to pair with)
        cli_row("00000000000008", 8, "0008", "0000008", "resseg in", "2023-11-01", "2023-01-01", None, 20231101),
        cli_row("00000000000008", 8, "0008", "0000008", "resseg out", "2023-12-01", "2023-01-01", None, 20231201),
        cli_row("00000000000008", 8, "0008", "0000008", "resseg out", "2024-01-02", "2023-01-01", None, 20240102),
    ]
    return cli_df(spark, rows)


def test_snapshot_excludes_listed_and_keyless(cli):
    keys = sorted(r.agencia_conta for r in C.client_snapshot(cli, D, EXCLUDED).collect())
    assert keys == ["0001_0000001", "0002_0000002", "0003_0000003", "0006_0000006", "0007_0000007"]


def test_exit_accounts_and_history(cli):
    exits = C.exit_accounts(cli, EXCLUDED)
    assert sorted(r[0] for r in exits.collect()) == ["0001_0000001", "0008_0000008"]
    hist = C.exit_history(cli, exits)
    a_rows = [r for r in hist.collect() if r.agencia_conta == "0001_0000001"]
    # The duplicate snapshot collapses; 5 distinct events remain for A.
    assert len(a_rows) == 4
    ev = {(r.canal, r.data_aceite_ressegmentacao) for r in a_rows}
    assert ev == {("resseg in", _d("2024-01-01")), ("resseg out", _d("2024-01-05")),
                  ("onboarding", _d("2024-01-08")), (None, _d("2024-01-09"))}


@pytest.mark.parametrize("method", ["auto", "window", "sorted"])
def test_ranks_count_null_channel_as_entry(cli, method):
    ranks = C.exit_ranks(C.exit_history(cli, C.exit_accounts(cli, EXCLUDED)), method=method)
    got = sorted(((r.agencia_conta, r.canal, r.rank_cli) for r in ranks.collect()), key=repr)
    assert got == sorted([
        ("0001_0000001", "resseg in", 1), ("0001_0000001", "onboarding", 2),
        ("0001_0000001", None, 3), ("0001_0000001", "resseg out", 1),
        ("0008_0000008", "resseg in", 1), ("0008_0000008", "resseg out", 1),
        ("0008_0000008", "resseg out", 2),
    ], key=repr)


def test_client_accounts_end_to_end(cli):
    out = C.client_accounts_from(cli, D, EXCLUDED, TO_OUTROS, TO_ONBOARDING)
    got = sorted(((r.agencia_conta, r.jornada, r.data_abertura_conta_emps,
                   r.data_encerramento_conta_emps, r.flag_conta_ativa) for r in out.collect()),
                 key=repr)
    assert got == sorted([
        # A: first entry paired with the first exit; the later entry stays open.
        ("0001_0000001", "ressegmentacao", _d("2024-01-01"), _d("2024-01-05"), False),
        ("0001_0000001", "onboarding", _d("2024-01-08"), None, True),
        ("0002_0000002", "one_itau", _d("2023-02-02"), _d("9999-12-31"), True),
        # C: resegmentation entry opens on its acceptance date.
        ("0003_0000003", "ressegmentacao", _d("2024-01-03"), _d("2024-02-01"), False),
        # F: overridden before labelling → relationship-start date.
        ("0006_0000006", "one_itau", _d("2022-06-06"), None, True),
        # G: NULL channel on the never-left branch keeps a NULL journey.
        ("0007_0000007", None, _d("2023-07-07"), None, True),
        # H: overridden to onboarding; paired with the first exit only.
        ("0008_0000008", "onboarding", _d("2023-01-01"), _d("2023-12-01"), False),
    ], key=repr)
    # No exit journey is ever published.
    assert all(r.jornada != "resseg out" for r in out.collect())


def test_large_exclusion_list_uses_join(cli):
    many = tuple(f"x{i:03d}_{i:07d}" for i in range(20_000)) + EXCLUDED
    a = sorted(r.agencia_conta for r in C.client_snapshot(cli, D, many).collect())
    assert a == ["0001_0000001", "0002_0000002", "0003_0000003", "0006_0000006", "0007_0000007"]


def test_measured_exit_set_both_ways(cli):
    from possum.operators.joins import measured_side

    exits, small = measured_side(C.exit_accounts(cli, EXCLUDED))
    assert small
    _, tiny = measured_side(C.exit_accounts(cli, EXCLUDED), max_rows=1)
    assert not tiny
    as_broadcast = C.exit_history(cli, exits, small=True)
    as_shuffle = C.exit_history(cli, exits, small=False)
    assert sorted(map(repr, as_broadcast.collect())) == sorted(map(repr, as_shuffle.collect()))
    plan = as_broadcast._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_client_floor_limits_the_reads(cli):
    full = C.client_accounts_from(cli, D, EXCLUDED, TO_OUTROS, TO_ONBOARDING)
    floored = C.client_accounts_from(cli, D, EXCLUDED, TO_OUTROS, TO_ONBOARDING, client_floor=20240105)
    f = {(r.agencia_conta, r.jornada) for r in floored.collect()}
    # H's history lies before the floor: no exit, no run-day row, so it is gone.
    # A's first entry lies before the floor too; its later entry now takes ordinal 1.
    assert not any(a == "0008_0000008" for a, _ in f)
    assert {(r.agencia_conta, r.jornada) for r in full.collect()} - f == {
        ("0008_0000008", "onboarding"), ("0001_0000001", "ressegmentacao")}
    a = [r for r in floored.collect() if r.agencia_conta == "0001_0000001"]
    assert [(r.jornada, str(r.data_encerramento_conta_emps)) for r in a] == [("onboarding", "2024-01-05")]


def test_raw_sizes_bound_the_distinct_groups(cli):
    from pyspark.sql import functions as F

    exits = C.exit_accounts(cli, EXCLUDED)
    raw = {(r[0], r[1]): r[2] for r in C.exit_event_sizes(cli, exits)
           .groupBy("agencia_conta", "_side").count().collect()}
    hist = C.exit_history(cli, exits).withColumn(
        "_side", F.when(F.col("canal") == "resseg out", "resseg out").otherwise("entrada"))
    for r in hist.groupBy("agencia_conta", "_side").count().collect():
        assert raw[(r[0], r[1])] >= r[2]
    # A bound that marks groups hot only routes them to the sorted path.
    exact = C.exit_ranks(C.exit_history(cli, exits), method="window")
    bounded = C.exit_ranks(C.exit_history(cli, exits), max_group_rows=1,
                           sizes_from=C.exit_event_sizes(cli, exits))
    assert sorted(map(repr, exact.collect())) == sorted(map(repr, bounded.collect()))


def test_profile_gives_exits_and_hot_groups(cli):
    profile = C.account_profile(cli, EXCLUDED)
    assert sorted(r[0] for r in C.exits_of(profile).collect()) == sorted(
        r[0] for r in C.exit_accounts(cli, EXCLUDED).collect())
    assert C.hot_exit_groups(profile, 1000).count() == 0
    assert C.profile_counts(profile, 1000) == (2, 0)
    assert C.profile_counts(profile, 1) == (2, 2)
    assert C.profile_decisions(profile, 1000)[2] is None
    hot = C.hot_exit_groups(profile, 1)
    assert {(r._g0, r._g1) for r in hot.collect()} == {
        ("0001_0000001", "entrada"), ("0008_0000008", "resseg out")}
    exits = C.exit_accounts(cli, EXCLUDED)
    exact = C.exit_ranks(C.exit_history(cli, exits), method="window")
    split = C.exit_ranks(C.exit_history(cli, exits), hot=hot)
    assert sorted(map(repr, exact.collect())) == sorted(map(repr, split.collect()))


@pytest.mark.parametrize("method", ["window", "sorted"])
def test_whole_chain_methods_agree_on_test_tables(spark, method):
    from possum.sources import fixtures
    from tests.conftest import SF_SMALL

    inp = fixtures.load_inputs(spark, SF_SMALL)
    p = fixtures.FIXTURE_PARAMS
    args = (inp.cli, p.execute_date, p.excluded_accounts, p.journey_to_outros, p.journey_to_onboarding)
    auto = C.client_accounts_from(*args)
    other = C.client_accounts_from(*args, method=method)
    assert auto.count() == 412
    assert sorted(map(repr, auto.collect())) == sorted(map(repr, other.collect()))


def test_keyless_rows_dropped_even_without_a_list(cli):
    keys = [r.agencia_conta for r in C.client_snapshot(cli, D, ()).collect()]
    assert None not in keys and "0009_0000009" in keys
