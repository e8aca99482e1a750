"""Point-of-sale history as a stored, mergeable state: a run reads only new days.

A month's partition holds one row per point of sale: the two maxima and the
latest row (as a struct whose ``max`` is the latest-row rule), over the days
of the month that the state has read.  Both merge in any order, so late days
simply join their month.  A day that is read again may have lost rows, which
maxima cannot forget: its month is rebuilt from its day folders, at most 31.
One further row per month lists its days and carries a stamp of its content.

``fold`` merges all months up to one into a base partition, which remembers
the stamps it was made from; once one of those months has changed, the base
no longer counts until the next ``fold``.  A day's result then merges the base
and the months after it instead of every day ever written.

Months are replaced by the staged commit of ``sources.sinks``: a crash leaves
each month as it was or as it shall be, together with its list of days.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import snapshot_int
from ..sources.sinks import _exists, finish_loads, load
from .pdv import LATEST_COLUMNS, pdv_history

BASE = 0  # the partition of the merged older months
_KEY = "num_pdv"
_MAXIMA = ["dat_can_pdv", "dat_rtvc_pdv"]
_VALUES = [c for c in LATEST_COLUMNS if c not in {_KEY, *_MAXIMA, "dat_updt", "anomesdia"}]


def period_of(day: int) -> int:
    return day // 100


class HistoryState:
    """The state stored in ``path``; ``tie_break`` as for ``latest_pdv``."""

    def __init__(self, spark: SparkSession, path: str, tie_break: Sequence[str] = ()):
        self.spark, self.path, self.tie_break = spark, path, tuple(tie_break)

    # --- what is stored ---

    def _stored(self) -> DataFrame | None:
        finish_loads(self.spark, self.path)
        return self.spark.read.parquet(self.path) if _exists(self.spark, self.path) else None

    def _notes(self, stored: DataFrame | None) -> dict[int, dict]:
        """Per partition: its days, stamp, and what a base covers (a row a month)."""
        if stored is None:
            return {}
        rows = stored.where(F.col("stamp").isNotNull()).select("period", "days", "stamp", "covers").collect()
        return {r["period"]: r.asDict() for r in rows}

    def days(self) -> list[int]:
        """The days read so far, in order."""
        notes = self._notes(self._stored())
        return sorted(d for p, n in notes.items() if p != BASE for d in n["days"])

    # --- merging ---

    def _rows(self, s_pdv: DataFrame, days: Iterable[int]) -> DataFrame:
        """The days' rows in the shape of the state, a state of one row each."""
        days = sorted(days)
        rows = s_pdv.where(snapshot_int().isin(days)) if days else s_pdv.where(F.lit(False))
        # Its only use of a run day is to stamp the rows, which the state does not keep.
        hist = pdv_history(rows, days[-1] if days else 0, keep=self.tie_break)
        latest = F.struct(F.col("dat_updt").alias("o0"),
                          *[F.col(c).alias(f"o{i}") for i, c in enumerate(self.tie_break, 1)], *_VALUES)
        return hist.select(_KEY, *_MAXIMA, latest.alias("latest"),
                           F.floor(F.col("dat_updt") / 100).cast("int").alias("period"))

    @staticmethod
    def _merge(rows: DataFrame, *keys: str) -> DataFrame:
        """One aggregate, combined map-side: a hot point of sale sends one row a task."""
        return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in _MAXIMA],
                                       F.max("latest").alias("latest"))

    @staticmethod
    def _data(stored: DataFrame, periods: Iterable[int]) -> DataFrame:
        return (stored.where(F.col("stamp").isNull() & F.col("period").isin(sorted(periods)))
                .select(_KEY, *_MAXIMA, "latest", "period"))

    def _commit(self, rows: DataFrame, notes: list[tuple]) -> None:
        """Replace the partitions named in ``notes`` by ``rows`` and the notes."""
        empty = [F.lit(None).cast(t).alias(c) for c, t in (
            ("days", "array<int>"), ("stamp", "string"), ("covers", "map<int,string>"))]
        noted = self.spark.createDataFrame(
            notes, "period int, days array<int>, stamp string, covers map<int,string>")
        # Rebalanced: few files a month, and large months in several tasks.
        load(rows.select("*", *empty).unionByName(noted, allowMissingColumns=True).hint("rebalance", "period"),
             path=self.path, partition_by="period")

    # --- the state's life ---

    def advance(self, s_pdv: DataFrame, days: Iterable[int]) -> None:
        """Read ``days`` of ``s_pdv``: new ones, late ones, or ones to be read again.

        Only these day folders are read, and the other days of a month whose
        day is read again.
        """
        wanted: dict[int, set[int]] = {}
        for d in days:
            wanted.setdefault(period_of(d), set()).add(d)
        if not wanted:
            return
        stored = self._stored()
        notes = self._notes(stored)
        known = {p: set(n["days"]) for p, n in notes.items() if p != BASE}
        rebuilt = {p for p, ds in wanted.items() if ds & known.get(p, set())}
        read = {d for p, ds in wanted.items() for d in (ds | known[p] if p in rebuilt else ds)}
        rows = self._rows(s_pdv, read)
        kept = (set(wanted) & set(known)) - rebuilt
        if kept:
            rows = rows.unionByName(self._data(stored, kept))
        self._commit(self._merge(rows, _KEY, "period"), [
            (p, sorted(ds | known.get(p, set())), uuid.uuid4().hex, None) for p, ds in wanted.items()])

    def fold(self, upto: int) -> None:
        """Merge the months up to ``upto`` (``yyyymm``) into the base."""
        stored = self._stored()
        notes = {p: n for p, n in self._notes(stored).items() if p != BASE and p <= upto}
        if notes:
            rows = self._merge(self._data(stored, notes), _KEY).withColumn("period", F.lit(BASE))
            self._commit(rows, [(BASE, [], uuid.uuid4().hex, {p: n["stamp"] for p, n in notes.items()})])

    def _upto(self, s_pdv: DataFrame, execute_date: int) -> DataFrame:
        """Merged rows over the days read, up to and including the run day."""
        stored = self._stored()
        notes = self._notes(stored)
        base = notes.pop(BASE, None)
        now = period_of(execute_date)
        whole = {p for p, n in notes.items() if p < now or (p == now and max(n["days"]) <= execute_date)}
        ahead = now in notes and now not in whole
        parts = []
        covered = dict(base["covers"]) if base else {}
        if covered and set(covered) <= whole and all(notes[p]["stamp"] == s for p, s in covered.items()):
            parts.append(self._data(stored, [BASE]))
            whole -= set(covered)
        if whole:
            parts.append(self._data(stored, whole))
        # The run day's month when the state is ahead of the run day.
        cut = [d for d in notes[now]["days"] if d <= execute_date] if ahead else []
        if cut or not parts:
            parts.append(self._rows(s_pdv, cut))
        return self._merge(reduce(DataFrame.unionByName, parts), _KEY)

    def status(self, s_pdv: DataFrame, execute_date: int) -> DataFrame:
        """As ``pdv_status`` over the days read."""
        return self._upto(s_pdv, execute_date).select(
            _KEY, *_MAXIMA, F.lit(execute_date).alias("anomesdia"))

    def latest(self, s_pdv: DataFrame, execute_date: int) -> DataFrame:
        """As ``latest_pdv`` over the days read."""
        def column(name: str) -> Column:
            if name in (_KEY, *_MAXIMA):
                return F.col(name)
            if name == "anomesdia":
                return F.lit(execute_date).alias(name)
            return F.col("latest.o0" if name == "dat_updt" else f"latest.{name}").alias(name)

        rows = self._upto(s_pdv, execute_date).where(F.col(_KEY).isNotNull())
        return rows.select(*[column(c) for c in LATEST_COLUMNS])


def days_of(s_pdv: DataFrame, upto: int | None = None) -> list[int]:
    """The snapshot days present (one number per day folder), up to ``upto``."""
    day = snapshot_int().alias("day")
    rows = s_pdv.select(day).distinct()
    return sorted(r["day"] for r in (rows if upto is None else rows.where(F.col("day") <= upto)).collect())
