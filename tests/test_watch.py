"""The daily run reports malformed dates and several dates for one event, in its own pass."""

import dataclasses
import os

from pyspark.sql import functions as F

from possum.operators import clients as C
from possum.operators.watch import DailyReport, Watch, several_dates
from possum.plans.job import run
from possum.sources import fixtures
from tests.conftest import SF_SMALL
from tests.helpers import cli_df, cli_row, estb_df, estb_row, pdv_df, pdv_row

CNPJ = "01230000000191"


def _cli(spark):
    def row(conta, canal, accepted, opened, day, client=1):
        return cli_row(CNPJ, client, "0001", conta, canal, accepted, opened, None, day)
    return cli_df(spark, [
        # account 1: its entry's date was corrected between snapshots
        row("0000001", "resseg in", "2020-01-01", "2019-01-01", 20240101),
        row("0000001", "resseg in", "2020-01-02", "2019-01-01", 20240102),
        row("0000001", "resseg out", "2021-01-01", "2019-01-01", 20240102),
        # account 2: one date for each event; a NULL date is none
        row("0000002", "resseg in", "2020-01-01", "2019-01-01", 20240101),
        row("0000002", "resseg in", None, "2019-01-01", 20240102),
        row("0000002", "resseg out", "2020-05-01", "2019-01-01", 20240102),
        # account 3: two versions of two events count once
        row("0000003", "onboarding", None, "2019-01-01", 20240101),
        row("0000003", "onboarding", None, "2019-01-02", 20240102),
        row("0000003", "resseg out", "2020-05-01", "2019-01-01", 20240102),
        row("0000003", "resseg out", "2020-05-02", "2019-01-01", 20240103),
        # account 4 never left, so it is not in the exit history
        row("0000004", "resseg in", "2020-01-01", "2019-01-01", 20240101),
        row("0000004", "resseg in", "2020-01-02", "2019-01-01", 20240102),
        # account 5: another relationship start is another event
        row("0000005", "resseg in", "2020-01-01", "2019-01-01", 20240101),
        row("0000005", "resseg in", "2020-01-02", "2019-01-05", 20240102),
        row("0000005", "resseg out", "2020-05-01", "2019-01-01", 20240102),
    ])


PARAMS = dataclasses.replace(fixtures.FIXTURE_PARAMS, excluded_accounts=(), journey_to_outros=(),
                             journey_to_onboarding=())


def _points(spark):
    return pdv_df(spark, [pdv_row(1, "20240101", 1, can="2023-99-99x", rtvc="not a day"),
                          pdv_row(1, "20240102", 2, can="2023-11-01", rtvc="??"),
                          pdv_row(2, "20240102", 3, can="", rtvc=None),
                          pdv_row(3, "20250102", 4, can="after the run day")])


def test_run_reports_both_counts(spark, scratch_dir):
    estab = estb_df(spark, [estb_row(1230000000191, "20240101", 1)])
    got = run(_points(spark), estab, _cli(spark), PARAMS, path=os.path.join(scratch_dir, "o"))
    # '2023-99-99x' reads as 20239999: text of digits, as the reference takes it
    assert got.report == DailyReport(0, 2, 2)
    assert got.day.count() > 0


def test_hot_accounts_are_reported_too(spark, scratch_dir):
    estab = estb_df(spark, [estb_row(1230000000191, "20240101", 1)])
    params = dataclasses.replace(PARAMS, max_group_rows=1)
    got = run(_points(spark), estab, _cli(spark), params, path=os.path.join(scratch_dir, "o"))
    assert got.report == DailyReport(0, 2, 2)


def test_watched_ranks_equal_plain_ranks_and_match_the_aggregate(spark):
    cli = fixtures.load_inputs(spark, SF_SMALL).cli
    exits = C.exit_accounts(cli, ())
    history = C.exit_history(cli, exits)
    for limit in (1_000_000, 3):
        watch = Watch()
        ranked = C.exit_ranks(history, max_group_rows=limit, watch=watch)
        plain = C.exit_ranks(history, method="window")
        assert sorted(map(str, ranked.collect())) == sorted(map(str, plain.select(ranked.columns).collect()))
        assert watch.report().accounts_with_several_dates == several_dates(history).count() > 0


def test_the_report_costs_no_job_and_no_second_read(spark, scratch_dir):
    from tests.test_sink_and_job import _jobs

    inp = fixtures.load_inputs(spark, SF_SMALL)

    from possum.plans import job

    def loaded(watch, name):
        plan = job.transform(inp.s_pdv, inp.s_estb, inp.cli, PARAMS, watch=watch).pdv_emps
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            return _jobs(spark, lambda: job.load(plan, path=os.path.join(scratch_dir, name),
                                                 day=PARAMS.execute_date))[0]
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")

    watch = Watch()
    assert loaded(watch, "watched") == loaded(None, "plain")
    jobs, report = _jobs(spark, watch.report)
    assert jobs == 0 and report.accounts_with_several_dates > 0


def test_empty_inputs_report_zero(spark, scratch_dir):
    got = run(_points(spark).limit(0), estb_df(spark, []), cli_df(spark, []), PARAMS,
              path=os.path.join(scratch_dir, "o"))
    assert got.report == DailyReport(0, 0, 0)


def test_columns_are_still_pruned(spark, scratch_dir):
    path = os.path.join(scratch_dir, "pdv")
    _points(spark).withColumn("unused", F.lit("x")).write.partitionBy("ano", "mes", "dia").parquet(path)
    plan = Watch().point_of_sale_rows(spark.read.parquet(path)).select("num_pdv", "dat_can_pdv")
    read = plan._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in read and "cod_cnae" not in read
