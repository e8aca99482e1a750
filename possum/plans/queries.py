"""Registered queries: one per relation of the job, over the shared test tables.

Each entry is ``(spark, sf_dir) -> DataFrame``.  Results are rendered for
comparison (dates as ISO text, money as double) at the very end, so the
plans themselves keep their types.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clients as C
from ..operators import flagship as FL
from ..operators import pdv as P
from ..operators import revenue as R
from ..operators.estab import latest_estab
from ..operators.exit_store import EventStore
from ..operators.joins import materialise
from ..operators.ordering import DEFAULT_MAX_GROUP_ROWS
from ..operators.state import HistoryState, days_of
from ..params import RunParams
from ..sources import fixtures
from ..sources.colocate import Colocated
from ..sources.scans import extract, scan_since, scan_snapshot, scan_upto
from . import job
from .session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]

# An extractor call as a caller writes it: SQL column expressions over an
# aliased source, and a SQL predicate on the partition columns.
EXTRACT_COLUMNS = [
    "p.num_pdv AS num_pdv",
    "p.num_cad_grl_ctri_estb AS num_cad_grl_ctri_estb",
    "trim(p.cod_cnae) AS cod_cnae",
    "coalesce(try_cast(replace(left(p.dat_can_pdv, 10), '-', '') AS INT), 0) AS dat_can_pdv",
    "make_date(int(p.ano), int(p.mes), int(p.dia)) AS snapshot_date",
]


def for_compare(df: DataFrame, as_double: tuple[str, ...] = ()) -> DataFrame:
    """Dates → ``yyyy-MM-dd`` text, decimals → double, ``as_double`` columns →
    double (integers that can be NULL, e.g. after a left join: pandas turns
    them into floats on one engine and nullable ints on another); other
    columns unchanged."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType) or f.name in as_double:
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _scratch(spark: SparkSession, label: str) -> str:
    """A new folder name in the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{label}_{uuid.uuid4().hex}"


class _Job:
    """The relations of one run over one scale-factor folder, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str, p: RunParams = fixtures.FIXTURE_PARAMS,
                 method: str = "auto"):
        self.p = p
        self.method = method
        self.inp = fixtures.load_inputs(spark, sf_dir)
        self.spark = spark
        self._profile = self._state = None
        self._decisions = {}

    # point of sale
    def history(self, keep=None):
        keep = self.p.pdv_tie_break if keep is None else keep
        return P.pdv_history(self.inp.s_pdv, self.p.execute_date, keep=keep)

    def latest_pdv(self):
        return P.latest_pdv(self.history(), self.p.pdv_tie_break)

    def estab(self):
        return latest_estab(self.inp.s_estb, self.p.estab_tie_break)

    # clients
    def exits(self):
        return C.exit_accounts(self.inp.cli, self.p.excluded_accounts)

    def profile(self):
        if self._profile is None:
            self._profile = materialise(C.leavers(
                C.account_profile(self.inp.cli, self.p.excluded_accounts)))
        return self._profile

    def decisions(self, max_group_rows: int = DEFAULT_MAX_GROUP_ROWS):
        key = (max_group_rows, self.method)
        if key not in self._decisions:
            self._decisions[key] = C.profile_decisions(self.profile(), max_group_rows, self.method)
        return self._decisions[key]

    def measured_exits(self):
        exits, small, _ = self.decisions()
        return exits, small

    def snapshot(self):
        return C.client_snapshot(self.inp.cli, self.p.execute_date, self.p.excluded_accounts)

    def history_exits(self):
        return C.exit_history(self.inp.cli, *self.measured_exits())

    def ranks(self, max_group_rows: int = DEFAULT_MAX_GROUP_ROWS):
        hot = self.decisions(max_group_rows)[2]
        return C.exit_ranks(self.history_exits(), method=self.method, hot=hot)

    def never_left(self):
        return C.never_left_accounts(self.snapshot(), *self.measured_exits())

    def lifecycle(self):
        return C.account_lifecycle(self.ranks(), self.never_left())

    def adjusted(self):
        return C.journey_adjusted(self.lifecycle(), self.p.journey_to_outros,
                                  self.p.journey_to_onboarding)

    def accounts(self):
        return C.client_accounts(self.adjusted(), self.p.open_end)

    # stored state: read in parts, out of order, and some days twice
    def state(self):
        if self._state is None:
            days = days_of(self.inp.s_pdv, self.p.execute_date)
            self._state = HistoryState(self.spark, _scratch(self.spark, "pdv_state"), self.p.pdv_tie_break)
            late = days[::7]
            self._state.advance(self.inp.s_pdv, sorted(set(days) - set(late)))
            self._state.fold(days[len(days) // 2] // 100)
            self._state.advance(self.inp.s_pdv, [*late, *days[-3:]])
        return self._state

    def event_store(self):
        path = _scratch(self.spark, "exit_events")
        store = EventStore(self.spark, path.rsplit("/", 1)[1], path, buckets=8)
        days = sorted(r["anomesdia"] for r in self.inp.cli.select("anomesdia").distinct().collect())
        for part in (days[1::3], days[::3], [*days[2::3], *days[:2]]):
            store.advance(self.inp.cli, part)
        return store

    def from_store(self, build):
        store = self.event_store()
        stored = materialise(build(store))
        store.drop()
        return stored

    def pdv_emps_incremental(self):
        """The daily run over the stored state and events, brought up to the day in two steps."""
        path = _scratch(self.spark, "daily")
        state = HistoryState(self.spark, f"{path}/state", self.p.pdv_tie_break)
        events = EventStore(self.spark, path.rsplit("/", 1)[1], f"{path}/events", buckets=8)
        cli = self.inp.cli
        days = days_of(self.inp.s_pdv, self.p.execute_date)
        state.advance(self.inp.s_pdv, days[:-20])
        events.advance(cli, job.snapshot_days(cli)[::3])
        run = job.run_incremental(self.inp.s_pdv, self.inp.s_estb, cli, self.p, state, events,
                                  path=f"{path}/out")
        out = materialise(run.day)
        events.drop()
        return out

    def revenue_months(self):
        stored = R.RevenueMonths(self.spark, _scratch(self.spark, "revenue_months"))
        month = F.floor(F.col("anomesdia") / 100).cast("int").alias("m")
        months = sorted(r["m"] for r in self.inp.tx.select(month).distinct().collect())
        for part in (months[::2], months[1::2], months[-2:]):
            stored.replace(self.inp.tx, part)
        return stored

    def revenue_of_table(self):
        name = f"possum_tx_{uuid.uuid4().hex}"
        self.inp.tx.createOrReplaceTempView(name)
        return R.revenue_matrix_of(name, self.p.as_of, self.p.months, self.spark)

    def pdv_emps_reduced(self):
        """The history reduced to points of sale that ever carried an active tax id."""
        accounts = materialise(self.accounts())
        ids = materialise(FL.active_accounts(accounts).select("cnpj14").distinct())
        latest = P.latest_pdv(P.reduced_history(self.history(), ids), self.p.pdv_tie_break)
        return FL.pdv_emps(latest, accounts, self.estab(), self.p.cancel_floor)

    def pdv_emps_colocated(self):
        """Latest rows, accounts and establishments stored alike; both joins in place."""
        path = _scratch(self.spark, "flagship")
        kept = Colocated(self.spark, path.rsplit("/", 1)[1], "cnpj14", path, buckets=8)
        out = materialise(FL.pdv_emps_stored(
            kept.store("latest", self.latest_pdv()),
            kept.store("active", FL.active_accounts(self.accounts())),
            kept.store("estab", self.estab()), self.p.cancel_floor))
        kept.drop()
        return out

    def pdv_clients(self):
        return FL.pdv_clients(self.latest_pdv(), self.accounts(), self.estab())

    def pdv_emps(self):
        return FL.pdv_emps(self.latest_pdv(), self.accounts(), self.estab(), self.p.cancel_floor)


def _q(build: Callable[[_Job], DataFrame], method: str = "auto",
       as_double: tuple[str, ...] = ()) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return for_compare(build(_Job(spark, sf_dir, method=method)), as_double)
    return run


def _extract_pdv(j: _Job) -> DataFrame:
    d = j.p.execute_date
    day = f"{d // 10000:04d}-{d // 100 % 100:02d}-{d % 100:02d}"
    predicate = f"make_date(int(p.ano), int(p.mes), int(p.dia)) <= DATE'{day}'"
    return extract(j.inp.s_pdv, predicate=predicate, columns=EXTRACT_COLUMNS, alias="p")


QUERIES: dict[str, Query] = {
    # sources
    "scan_upto": _q(lambda j: scan_upto(j.inp.s_pdv, j.p.execute_date)),
    "scan_snapshot": _q(lambda j: scan_snapshot(j.inp.cli, j.p.execute_date)),
    "scan_since": _q(lambda j: scan_since(j.inp.cli, j.p.client_floor)),
    "extract_predicate": _q(_extract_pdv),
    # point of sale
    "pdv_history": _q(lambda j: j.history(keep=())),
    "pdv_status": _q(lambda j: P.pdv_status(j.inp.s_pdv, j.p.execute_date)),
    "pdv_normalised": _q(lambda j: P.pdv_normalised(j.history(), j.p.pdv_tie_break, "auto")),
    "pdv_normalised_sorted": _q(lambda j: P.pdv_normalised(j.history(), j.p.pdv_tie_break, "sorted")),
    "pdv_normalised_window": _q(lambda j: P.pdv_normalised(j.history(), j.p.pdv_tie_break, "window")),
    "pdv_normalised_join": _q(lambda j: P.pdv_normalised(j.history(), j.p.pdv_tie_break, "join")),
    "pdv_normalised_split": _q(lambda j: P.pdv_normalised(j.history(), j.p.pdv_tie_break, "auto",
                                                          max_group_rows=9)),
    "pdv_normalised_cut": _q(lambda j: P.pdv_normalised(j.history(), j.p.pdv_tie_break, "cut")),
    "latest_pdv": _q(lambda j: j.latest_pdv()),
    "latest_pdv_window": _q(lambda j: P.latest_pdv(j.history(), j.p.pdv_tie_break, "window")),
    "pdv_status_state": _q(lambda j: j.state().status(j.inp.s_pdv, j.p.execute_date)),
    "latest_pdv_state": _q(lambda j: j.state().latest(j.inp.s_pdv, j.p.execute_date)),
    # establishment
    "latest_estab": _q(lambda j: j.estab()),
    "latest_estab_window": _q(lambda j: latest_estab(j.inp.s_estb, j.p.estab_tie_break, "window")),
    # revenue
    "monthly_revenue": _q(lambda j: R.monthly_revenue(j.inp.tx)),
    "revenue_matrix": _q(lambda j: R.revenue_matrix(j.inp.tx, j.p.as_of, j.p.months)),
    "revenue_matrix_two_step": _q(lambda j: R.revenue_matrix_two_step(j.inp.tx, j.p.as_of, j.p.months)),
    "revenue_matrix_months": _q(lambda j: j.revenue_months().matrix(j.p.as_of, j.p.months)),
    "revenue_matrix_table": _q(lambda j: j.revenue_of_table()),
    # client accounts
    "client_snapshot": _q(lambda j: j.snapshot()),
    "exit_accounts": _q(lambda j: j.exits()),
    "exit_history": _q(lambda j: j.history_exits()),
    "exit_ranks": _q(lambda j: j.ranks()),
    "exit_ranks_window": _q(lambda j: j.ranks(), method="window"),
    "exit_ranks_sorted": _q(lambda j: j.ranks(), method="sorted"),
    "exit_ranks_cut": _q(lambda j: j.ranks(), method="cut"),
    # The skew path on the real tables: a tiny threshold makes many groups
    # "hot", so the data-cut ordinal numbers the rows.
    "exit_ranks_split": _q(lambda j: j.ranks(max_group_rows=3)),
    "never_left_accounts": _q(lambda j: j.never_left()),
    "account_lifecycle": _q(lambda j: j.lifecycle()),
    "journey_adjusted": _q(lambda j: j.adjusted()),
    "client_accounts": _q(lambda j: j.accounts()),
    "exit_history_store": _q(lambda j: j.from_store(lambda s: s.exit_history(j.p.excluded_accounts))),
    "client_accounts_store": _q(lambda j: j.from_store(lambda s: s.client_accounts(
        j.inp.cli, j.p.execute_date, j.p.excluded_accounts, j.p.journey_to_outros,
        j.p.journey_to_onboarding, j.p.open_end))),
    # flagship
    "pdv_clients": _q(lambda j: j.pdv_clients(), as_double=("cod_cep",)),
    "pdv_emps_reduced": _q(lambda j: j.pdv_emps_reduced(), as_double=("codigo_cep",)),
    "pdv_emps_colocated": _q(lambda j: j.pdv_emps_colocated(), as_double=("codigo_cep",)),
    "pdv_emps_incremental": _q(lambda j: j.pdv_emps_incremental(), as_double=("codigo_cep",)),
    # Hot tax ids cut into shares: a tiny threshold makes most of them hot.
    "pdv_clients_shares": _q(lambda j: FL.pdv_clients(j.latest_pdv(), j.accounts(), j.estab(),
                                                      max_group_rows=3), as_double=("cod_cep",)),
    "pdv_emps": _q(lambda j: j.pdv_emps(), as_double=("codigo_cep",)),
}
