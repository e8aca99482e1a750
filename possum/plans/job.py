"""The daily run: extract → transform → load.

Building the plans runs small jobs (account profile, measured key sets); the
results themselves stay lazy until they are loaded.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import snapshot_int
from ..operators.clients import client_accounts_from
from ..operators.estab import latest_estab
from ..operators.exit_store import EventStore
from ..operators.flagship import pdv_emps
from ..operators.pdv import latest_pdv, pdv_history
from ..operators.state import HistoryState, days_of
from ..operators.watch import DailyReport, Watch
from ..params import RunParams
from ..sources.scans import extract, scan_upto
from ..sources.sinks import load
from .session import skew_split

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Results:
    pdv_emps: DataFrame
    client_accounts: DataFrame
    latest_estab: DataFrame


@dataclass(frozen=True)
class Run:
    """A loaded day: its flagship rows, and what its report counted."""

    day: DataFrame
    report: DailyReport


def transform(s_pdv: DataFrame, s_estb: DataFrame, cli: DataFrame, params: RunParams,
              method: str = "auto", watch: Watch | None = None) -> Results:
    """Build the result plans; ``watch`` counts doubtful rows as the flagship reads them.

    With ``params.use_client_floor`` the client table is read from
    ``params.client_floor`` on; by default every snapshot is read.
    """
    client_floor = params.client_floor if params.use_client_floor else None
    if watch is not None:
        s_pdv = watch.point_of_sale_rows(scan_upto(s_pdv, params.execute_date))
    hist = pdv_history(s_pdv, params.execute_date, keep=params.pdv_tie_break)
    latest = latest_pdv(hist, params.pdv_tie_break)
    estab = latest_estab(s_estb, params.estab_tie_break)
    accounts = client_accounts_from(
        cli, params.execute_date, params.excluded_accounts, params.journey_to_outros,
        params.journey_to_onboarding, params.open_end, method=method, client_floor=client_floor,
        max_group_rows=params.max_group_rows, watch=watch)
    return Results(pdv_emps(latest, accounts, estab, params.cancel_floor, params.max_group_rows),
                   accounts, estab)


def run(s_pdv: DataFrame, s_estb: DataFrame, cli: DataFrame, params: RunParams,
        table: str | None = None, path: str | None = None) -> Run:
    """Run one day and load the flagship result (partitioned by run day).

    Failures raise; a rerun of the same day replaces only that day.  The report
    is counted by the load itself.
    """
    log.info("building plans for %s", params.execute_date)
    watch = Watch()
    return _load(transform(s_pdv, s_estb, cli, params, watch=watch).pdv_emps, params, watch, table, path)


def _load(result: DataFrame, params: RunParams, watch: Watch, table: str | None, path: str | None) -> Run:
    spark = result.sparkSession
    with skew_split(spark):
        load(result, table=table, path=path, day=params.execute_date)
    report = watch.report()
    log.info("loaded day %s: %s", params.execute_date, report)
    loaded = spark.table(table) if table is not None else spark.read.schema(result.schema).parquet(path)
    return Run(loaded.where(F.col("anomesdia") == params.execute_date), report)


def snapshot_days(cli: DataFrame) -> list[int]:
    """The snapshots present (one number per day)."""
    return sorted(r["anomesdia"] for r in cli.select("anomesdia").distinct().collect())


def run_incremental(s_pdv: DataFrame, s_estb: DataFrame, cli: DataFrame, params: RunParams,
                    state: HistoryState, events: EventStore, table: str | None = None,
                    path: str | None = None) -> Run:
    """``run`` from the stored history state and event store.

    Both are brought up to date first, reading only the days that they have
    not read; the day's client snapshot is read for the accounts that never
    left.  The report counts malformed dates of the new days only.
    ``params.use_client_floor`` limits the snapshots that are added.
    """
    watch = Watch()
    read = set(state.days())
    new = [d for d in days_of(s_pdv, params.execute_date) if d not in read]
    if new:
        state.advance(watch.point_of_sale_rows(s_pdv.where(snapshot_int().isin(new))), new)
    known = set(events.days())
    floor = params.client_floor if params.use_client_floor else 0
    events.advance(cli, [d for d in snapshot_days(cli) if d >= floor and d not in known])
    accounts = events.client_accounts(
        cli, params.execute_date, params.excluded_accounts, params.journey_to_outros,
        params.journey_to_onboarding, params.open_end, max_group_rows=params.max_group_rows, watch=watch)
    result = pdv_emps(state.latest(s_pdv, params.execute_date), accounts,
                      latest_estab(s_estb, params.estab_tie_break), params.cancel_floor,
                      params.max_group_rows)
    return _load(result, params, watch, table, path)


def run_from_catalog(spark: SparkSession, params: RunParams, pdv_table: str, estab_table: str,
                     client_table: str, output_table: str,
                     output_path: str | None = None) -> Run:
    """The whole daily job over catalog tables; returns the loaded day and its report.

    The point-of-sale history is read up to the run day through a partition
    predicate (only those day folders are read); the
    establishment and client tables are read whole, as the job needs every
    snapshot.  Inputs are schema-checked, the flagship is loaded into
    ``output_table`` partitioned by run day.
    """
    s_pdv = schemas.require(
        extract(pdv_table, predicate=snapshot_int() <= F.lit(params.execute_date), spark=spark),
        schemas.S_PDV, pdv_table)
    s_estb = schemas.require(extract(estab_table, spark=spark), schemas.S_ESTB, estab_table)
    cli = schemas.require(extract(client_table, spark=spark), schemas.CLI, client_table)
    return run(s_pdv, s_estb, cli, params, table=output_table, path=output_path)
