"""Client accounts from the event store equal the full scan; only new snapshots are read."""

import os
import random

import pytest

from possum.operators import clients as C
from possum.operators.exit_store import EventStore
from possum.operators.watch import Watch, several_dates
from possum.schemas import CLI as C_SCHEMA
from tests.helpers import cli_df, cli_row

DAYS = [20240101, 20240102, 20240103, 20240104]
EXCLUDED = ("0001_0000003",)


def _cli(spark, seed=1, n=250):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        conta = "0000001" if i % 3 == 0 else f"000000{rng.randrange(2, 9)}"  # a third in one account
        date = lambda: rng.choice([None, "2020-01-01", "2021-05-05", "2022-02-02"])
        rows.append(cli_row(f"{rng.randrange(3):014d}", rng.choice([1, 2, None]),
                            None if i % 41 == 0 else "0001", conta,
                            rng.choice(["resseg in", "resseg out", "onboarding", "outros", None]),
                            date(), date(), date(), rng.choice(DAYS)))
    return cli_df(spark, rows)


@pytest.fixture
def store(spark, scratch_dir):
    name = f"exit_events_{os.path.basename(scratch_dir).replace('-', '_')}"
    made = EventStore(spark, name, os.path.join(scratch_dir, "events"), buckets=4)
    yield made
    made.drop()


def _sorted(df, columns=None):
    return sorted(map(str, (df if columns is None else df.select(*columns)).collect()))


@pytest.mark.parametrize("parts", [[DAYS], [DAYS[2:], DAYS[:2]], [[d] for d in DAYS],
                                   [DAYS[:3], DAYS[1:], DAYS]])
def test_equals_the_full_scan(spark, store, parts):
    cli = _cli(spark)
    for part in parts:
        store.advance(cli, part)
    assert store.days() == DAYS
    full = C.exit_history(cli, C.exit_accounts(cli, EXCLUDED))
    assert _sorted(store.exit_history(EXCLUDED), full.columns) == _sorted(full)
    lists = (("0001_0000004",), ("0001_0000005",))
    for limit in (1_000_000, 3):
        got = store.client_accounts(cli, 20240104, EXCLUDED, *lists, max_group_rows=limit)
        want = C.client_accounts_from(cli, 20240104, EXCLUDED, *lists)
        assert _sorted(got) == _sorted(want, got.columns)


def test_nothing_is_added_twice(spark, store):
    cli = _cli(spark)
    store.advance(cli, DAYS)
    n, events = store.events().count(), C.exit_history(cli, C.exit_accounts(cli, ()))
    store.advance(cli, DAYS)
    store.advance(cli.limit(0), [20240105])
    assert store.events().count() == n == store.events().distinct().count() >= events.count()
    assert store.days() == [*DAYS, 20240105]


def test_crash_between_events_and_days(spark, store, monkeypatch):
    cli = _cli(spark)
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(store, "days", lambda: (_ for _ in ()).throw(RuntimeError("crash")))
        store.advance(cli, DAYS[:2])
    assert store.days() == [] and store.events().count() > 0
    store.advance(cli, DAYS)
    full = C.exit_history(cli, C.exit_accounts(cli, ()))
    assert _sorted(store.exit_history(), full.columns) == _sorted(full)


def test_store_keeps_its_buckets(spark, store):
    cli = _cli(spark)
    store.advance(cli, DAYS[:2])

    def exchanges(df):
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return final.count("Exchange hashpartitioning")

    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        from possum.operators.exit_store import events_of
        from possum.plans.session import settings

        new = events_of(cli).checkpoint()
        with settings(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
            assert exchanges(store.missing(new)) == 1                  # the new events only
        assert exchanges(store.exit_history()) == 0
        assert exchanges(C.exit_ranks(store.exit_history(), hot=None, clustered=True)) == 0
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")


def test_only_new_snapshots_are_read(spark, store, scratch_dir):
    path = os.path.join(scratch_dir, "cli")
    _cli(spark).write.partitionBy("anomesdia").parquet(path)
    cli = spark.read.schema(C_SCHEMA).parquet(path)
    store.advance(cli, DAYS[:3])
    # Only the new day's folder remains: an older one would be missed.
    for d in DAYS[:3]:
        os.rename(os.path.join(path, f"anomesdia={d}"), os.path.join(scratch_dir, f"gone{d}"))
    cli = spark.read.schema(C_SCHEMA).parquet(path)
    store.advance(cli, DAYS[3:])
    got = store.client_accounts(cli, 20240104)
    want = C.client_accounts_from(_cli(spark), 20240104)
    assert _sorted(got) == _sorted(want, got.columns)


def test_watch_counts_on_the_store(spark, store):
    cli = _cli(spark)
    store.advance(cli, DAYS)
    watch = Watch()
    store.client_accounts(cli, 20240104, watch=watch).collect()
    assert watch.report().accounts_with_several_dates == several_dates(store.exit_history()).count() > 0
