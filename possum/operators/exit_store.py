"""Distinct client events kept in a bucketed table: a run reads only new snapshots.

The exit history of an account may reach back to any snapshot, and which
accounts ever leave is known only later, so the store keeps the distinct
events of every account.  New snapshots are reduced to their distinct events
and merge anti-joined with the store; only events not there yet are appended.
The table is bucketed by account: the anti-join, the exit accounts, the
semi-join and the ranking window read it without an exchange.

A snapshot that is read again only adds events: an event that a corrected
snapshot no longer has stays, as the store does not know which others had it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.rules import event_date
from ..plans.session import settings
from .clients import (account_lifecycle, client_accounts, client_snapshot, exclude_accounts, exit_ranks,
                      journey_adjusted, never_left_accounts, with_account_key)
from .joins import DEFAULT_BROADCAST_ROWS, materialise
from .ordering import DEFAULT_MAX_GROUP_ROWS
from .watch import Watch

EVENT = ("agencia_conta string, numero_cnpj_completo string, numero_unico_cliente bigint, canal string,"
         " data_aceite_ressegmentacao date, data_inicio_relacionamento_bancario date")
HISTORY_COLUMNS = ["numero_cnpj_completo", "numero_unico_cliente", "agencia_conta", "canal",
                   "data_aceite_ressegmentacao", "data_inicio_relacionamento_bancario"]


def events_of(cli: DataFrame) -> DataFrame:
    """Distinct events of client rows; rows without an account key have none."""
    rows = with_account_key(cli).where(F.col("agencia_conta").isNotNull())
    return rows.select(
        F.col("cnpj").alias("numero_cnpj_completo"), F.col("id_cnpj_eq3").alias("numero_unico_cliente"),
        "agencia_conta", "canal", event_date().alias("data_aceite_ressegmentacao"),
        F.col("data_abertura_conta").alias("data_inicio_relacionamento_bancario")).distinct()


class EventStore:
    """The table ``name`` (at ``path`` when given), and ``name``_days with the snapshots read."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int = 64):
        self.spark, self.name, self.days_name, self.buckets = spark, name, f"{name}_days", buckets
        if not spark.catalog.tableExists(name):
            self._save(spark.createDataFrame([], EVENT), "errorifexists", path)
        if not spark.catalog.tableExists(self.days_name):
            writer = spark.createDataFrame([], "day int").write.format("parquet")
            (writer.option("path", f"{path}_days") if path else writer).saveAsTable(self.days_name)

    def _save(self, rows: DataFrame, mode: str, path: str | None = None) -> None:
        writer = (rows.write.mode(mode).format("parquet")
                  .bucketBy(self.buckets, "agencia_conta").sortBy("agencia_conta"))
        (writer.option("path", path) if path else writer).saveAsTable(self.name)

    def events(self) -> DataFrame:
        return self.spark.table(self.name)

    def days(self) -> list[int]:
        """The snapshots read so far, in order."""
        return sorted(r["day"] for r in self.spark.table(self.days_name).distinct().collect())

    def drop(self) -> None:
        for name in (self.name, self.days_name):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def missing(self, found: DataFrame) -> DataFrame:
        """The events of ``found`` that are not in the store."""
        old, new = self.events().alias("o"), found.alias("n")
        same = [F.col("n.agencia_conta") == F.col("o.agencia_conta")]
        same += [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in HISTORY_COLUMNS if c != "agencia_conta"]
        return new.join(old.hint("merge"), same, "left_anti")

    def advance(self, cli: DataFrame, days: Iterable[int]) -> None:
        """Add the events of the snapshots ``days``; only these are read.

        Running it again after a crash, or with days read before, adds what is
        missing and nothing twice.
        """
        days = sorted(set(days))
        if not days:
            return
        found = events_of(cli.where(F.col("anomesdia").isin(days)))
        # All columns are join keys; hashing by account alone lets the store
        # keep its buckets.
        with settings(self.spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
            new = self.missing(found).repartition(self.buckets, "agencia_conta")
            self._save(new.sortWithinPartitions("agencia_conta").select(
                *[f.split()[0] for f in EVENT.split(", ")]), "append")
        self.spark.catalog.refreshTable(self.name)
        known = set(self.days())
        added = [(d,) for d in days if d not in known]
        if added:
            (self.spark.createDataFrame(added, "day int").coalesce(1)
             .write.mode("append").saveAsTable(self.days_name))
            self.spark.catalog.refreshTable(self.days_name)

    def exits(self, excluded: Sequence[str] = ()) -> DataFrame:
        """As ``exit_accounts`` over the snapshots read."""
        out = self.events().where(F.col("canal") == K.CHANNEL_RESSEG_OUT)
        return exclude_accounts(out.select("agencia_conta"), excluded).distinct()

    def exit_history(self, excluded: Sequence[str] = ()) -> DataFrame:
        """As ``exit_history`` over the snapshots read: already distinct."""
        return (self.events().join(self.exits(excluded).hint("merge"), "agencia_conta", "left_semi")
                .select(*HISTORY_COLUMNS))

    def client_accounts(self, cli: DataFrame, execute_date: int, excluded: Sequence[str] = (),
                        to_outros: Sequence[str] = (), to_onboarding: Sequence[str] = (),
                        open_end: dt.date = K.OPEN_END, max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
                        watch: Watch | None = None) -> DataFrame:
        """As ``client_accounts_from``; of ``cli`` only the run day is read."""
        exits = materialise(self.exits(excluded))
        small = exits.count() <= DEFAULT_BROADCAST_ROWS
        ranks = exit_ranks(self.exit_history(excluded), max_group_rows=max_group_rows, watch=watch,
                           clustered=True)
        lifecycle = account_lifecycle(ranks, never_left_accounts(
            client_snapshot(cli, execute_date, excluded), exits, small))
        return client_accounts(journey_adjusted(lifecycle, to_outros, to_onboarding), open_end)
