"""Counts of doubtful input rows, taken while the day's load reads them.

``Watch`` hangs observed metrics on the plans of one run, so no job reads the
inputs again: the counts are there once the load is done.  They are report
figures: a stage that is computed again after a lost executor counts its rows
again, so they may then be too large, never too small.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.columns import malformed_date

EVENT_DATE = "data_aceite_ressegmentacao"
STARTED = "data_inicio_relacionamento_bancario"


@dataclass(frozen=True)
class DailyReport:
    """Malformed date texts among the point-of-sale rows up to the run day, and
    accounts of the exit history with more than one date for one event."""

    malformed_cancellations: int
    malformed_reactivations: int
    accounts_with_several_dates: int


def _event_key() -> list:
    """What tells two events of an account apart, apart from their date.

    A resegmentation also has a relationship start; for any other channel
    that is the date itself.
    """
    started = F.when(F.col("canal").isin(K.CHANNEL_RESSEG_IN, K.CHANNEL_RESSEG_OUT), F.col(STARTED))
    return [F.col("canal"), F.col("numero_cnpj_completo"), F.col("numero_unico_cliente"), started]


def several_dates(history: DataFrame) -> DataFrame:
    """Accounts of an exit history with more than one date for one event.

    Two aggregates that combine map-side; for any group size.
    """
    events = history.groupBy("agencia_conta", *[c.alias(f"_e{i}") for i, c in enumerate(_event_key())]).agg(
        F.min(EVENT_DATE).alias("_low"), F.max(EVENT_DATE).alias("_high"))
    return events.where(F.col("_low") < F.col("_high")).select("agencia_conta").distinct()


class Watch:
    """The observations of one run; ``report`` after its load."""

    def __init__(self) -> None:
        self._dates = Observation()
        self._events = Observation()
        self._watches_dates = self._watches_events = False
        self._hot: DataFrame | None = None

    def point_of_sale_rows(self, rows: DataFrame) -> DataFrame:
        """``rows``, with their malformed date texts counted as they are read."""
        self._watches_dates = True
        return rows.observe(self._dates,
                            F.count_if(malformed_date("dat_can_pdv")).alias("can"),
                            F.count_if(malformed_date("dat_rtvc_pdv")).alias("rtvc"))

    def account_events(self, rows: DataFrame) -> DataFrame:
        """``rows`` of an exit history, partitioned by account, counted as they are ranked.

        The three windows share one sort and need no exchange.
        """
        self._watches_events = True
        event = Window.partitionBy("agencia_conta", *_event_key())
        account = Window.partitionBy("agencia_conta")
        several = F.coalesce(F.min(EVENT_DATE).over(event) < F.max(EVENT_DATE).over(event), F.lit(False))
        marked = (rows.withColumn("_several", several)
                  .withColumn("_first", F.row_number().over(account.orderBy(*_event_key())) == 1)
                  .withColumn("_any", F.max("_several").over(account)))
        return (marked.observe(self._events, F.count_if(F.col("_first") & F.col("_any")).alias("accounts"))
                .drop("_several", "_first", "_any"))

    def hot_account_events(self, rows: DataFrame) -> None:
        """Events of accounts too large for a window; the report aggregates them."""
        self._hot = rows

    @staticmethod
    def _get(observation: Observation) -> dict[str, int]:
        # Metrics arrive on a listener shortly after the action.  A branch that
        # the adaptive plan found empty read no row: it sends a row without
        # columns, or none.
        future = observation._jo.future()
        for _ in range(50):
            if future.isCompleted():
                sent = future.value().get().get()
                return observation.get if sent.schema() is not None else {}
            time.sleep(0.1)
        return {}

    def report(self) -> DailyReport:
        """The counts.  Without a hot account this starts no job."""
        dates = self._get(self._dates) if self._watches_dates else {}
        events = self._get(self._events) if self._watches_events else {}
        hot = several_dates(self._hot).count() if self._hot is not None else 0
        return DailyReport(dates.get("can", 0), dates.get("rtvc", 0), events.get("accounts", 0) + hot)
