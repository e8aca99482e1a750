"""Point-of-sale history, status and normalised latest state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import date_text_to_int, snapshot_int, tax_id14, tax_id_base
from ..sources.scans import scan_upto
from .joins import DEFAULT_BROADCAST_ROWS, at_most, materialise
from .ordering import DEFAULT_MAX_GROUP_ROWS, hot_keys, latest_per_key, ordinal, ordinal_cut

HISTORY_COLUMNS = [
    "num_pdv", "cnpj14", "cnpjbas", "cod_cnae", "num_cad_grl_ctri_estb", "cod_mot_can",
    "cod_ram_atvd", "cod_gru_ram", "dat_cdst_pdv", "dat_can_pdv", "dat_rtvc_pdv",
    "dat_updt", "anomesdia",
]
NORMALISED_COLUMNS = [
    "num_pdv", "cnpj14", "cnpjbas", "cod_mot_can", "cod_ram_atvd", "cod_cnae", "cod_gru_ram",
    "dat_can_pdv", "dat_rtvc_pdv", "dat_cdst_pdv", "dat_updt", "index_num", "anomesdia",
]
LATEST_COLUMNS = [c for c in NORMALISED_COLUMNS if c != "index_num"]


def pdv_history(s_pdv: DataFrame, execute_date: int, keep: Sequence[str] = ()) -> DataFrame:
    """Cleaned point-of-sale rows of every snapshot up to the run day.

    ``dat_updt`` is the snapshot day, ``anomesdia`` the run day.  ``keep``
    passes extra columns (tie-break keys) through.
    """
    est = F.col("num_cad_grl_ctri_estb")
    return scan_upto(s_pdv, execute_date).select(
        "num_pdv",
        tax_id14(est).alias("cnpj14"),
        tax_id_base(est).alias("cnpjbas"),
        F.trim("cod_cnae").alias("cod_cnae"),
        est.cast("string").alias("num_cad_grl_ctri_estb"),
        "cod_mot_can", "cod_ram_atvd", "cod_gru_ram",
        F.col("dat_cdst_pdv").cast("string").alias("dat_cdst_pdv"),
        date_text_to_int("dat_can_pdv").alias("dat_can_pdv"),
        date_text_to_int("dat_rtvc_pdv").alias("dat_rtvc_pdv"),
        snapshot_int().alias("dat_updt"),
        F.lit(execute_date).alias("anomesdia"),
        *keep,
    )


def pdv_status(s_pdv: DataFrame, execute_date: int) -> DataFrame:
    """Per point of sale: latest cancellation and reactivation day (0 = none)."""
    return (scan_upto(s_pdv, execute_date)
            .groupBy("num_pdv")
            .agg(F.max(date_text_to_int("dat_can_pdv")).alias("dat_can_pdv"),
                 F.max(date_text_to_int("dat_rtvc_pdv")).alias("dat_rtvc_pdv"))
            .withColumn("anomesdia", F.lit(execute_date)))


def _latest_order(tie_break: Sequence[str]) -> list[Column]:
    return [F.col("dat_updt").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]]


def pdv_normalised(hist: DataFrame, tie_break: Sequence[str], method: str = "auto",
                   max_group_rows: int = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Every history row with its point of sale's latest cancellation and
    reactivation days, and ``index_num`` = 1 for the most recent snapshot.

    The reference joins the history to its own per-key aggregate; the per-key
    maximum over a window is the same thing with one exchange instead of two.

    ``method="window"``: windows on ``num_pdv``, one exchange.
    ``method="join"``: the literal self-join with the per-key aggregate, for
    comparison.
    ``method="sorted"``: maxima from a partial aggregate joined back, index
    from the skew-safe ordinal.
    ``method="auto"``: a counting job first finds the points of sale with
    more than ``max_group_rows`` rows (at most rows / max_group_rows of them,
    so broadcast); those rows take the skew-safe ordinal, all others the
    window.  Without such a point of sale the plan is just the window.
    """
    h = hist.where(F.col("num_pdv").isNotNull())
    order = _latest_order(tie_break)
    if method == "window":
        return _normalised_window(h, order)
    if method == "join":
        # The literal shape: history joined to its own per-key aggregate, then
        # the index window.  Two exchanges of the history instead of one.
        status = h.groupBy(F.col("num_pdv").alias("_g")).agg(
            F.max("dat_can_pdv").alias("_can"), F.max("dat_rtvc_pdv").alias("_rtvc"))
        joined = _take_maxima(h.join(status, F.col("num_pdv") == F.col("_g")))
        ranked = joined.withColumn("index_num", F.row_number().over(
            Window.partitionBy("num_pdv").orderBy(*order)))
        return ranked.select(*NORMALISED_COLUMNS)
    if method == "sorted":
        status = h.groupBy(F.col("num_pdv").alias("_g")).agg(
            F.max("dat_can_pdv").alias("_can"), F.max("dat_rtvc_pdv").alias("_rtvc"))
        joined = _take_maxima(h.join(status, F.col("num_pdv") == F.col("_g")))
        return ordinal(joined, ["num_pdv"], order, "index_num", "sorted").select(*NORMALISED_COLUMNS)
    if method not in ("auto", "cut"):
        raise ValueError(f"unknown method {method!r}")
    if method == "auto" and hot_keys(h, ["num_pdv"], max_group_rows) is None:
        return _normalised_window(h, order)
    cut = ordinal_cut(h, ["num_pdv"], ["dat_updt", *tie_break], order, "index_num", max_group_rows,
                      maxima={"_can": "dat_can_pdv", "_rtvc": "dat_rtvc_pdv"})
    return _take_maxima(cut).select(*NORMALISED_COLUMNS)


def _take_maxima(joined: DataFrame) -> DataFrame:
    return (joined.withColumn("dat_can_pdv", F.col("_can"))
                  .withColumn("dat_rtvc_pdv", F.col("_rtvc"))
                  .drop("_g", "_can", "_rtvc"))


def _normalised_window(h: DataFrame, order: list[Column]) -> DataFrame:
    by_pdv = Window.partitionBy("num_pdv")
    out = (h.withColumn("dat_can_pdv", F.max("dat_can_pdv").over(by_pdv))
            .withColumn("dat_rtvc_pdv", F.max("dat_rtvc_pdv").over(by_pdv))
            .withColumn("index_num", F.row_number().over(by_pdv.orderBy(*order))))
    return out.select(*NORMALISED_COLUMNS)


def latest_pdv(hist: DataFrame, tie_break: Sequence[str] = (), method: str = "aggregate") -> DataFrame:
    """The ``index_num = 1`` rows of ``pdv_normalised``, computed directly.

    ``method="aggregate"``: one aggregate per point of sale, the maxima and
    the most recent row's attributes in the same map-side-combined pass, one
    exchange, safe for a hot point of sale.  ``method="window"``: the
    normalised windows then ``index_num = 1`` (a hot point of sale is sorted
    by one task), kept for comparison.
    """
    if method == "window":
        return (pdv_normalised(hist, tie_break, "window")
                .where(F.col("index_num") == 1).select(*LATEST_COLUMNS))
    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")
    h = hist.where(F.col("num_pdv").isNotNull())
    values = [c for c in LATEST_COLUMNS if c not in ("num_pdv", "dat_can_pdv", "dat_rtvc_pdv")]
    order = ["dat_updt", *tie_break]
    return latest_per_key(
        h, ["num_pdv"], order, values,
        extra_aggs=[F.max("dat_can_pdv").alias("dat_can_pdv"),
                    F.max("dat_rtvc_pdv").alias("dat_rtvc_pdv")],
    ).select(*LATEST_COLUMNS)


def reduced_history(hist: DataFrame, tax_ids: DataFrame,
                    max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The full history of the points of sale that ever carried one of ``tax_ids``.

    A point of sale's latest row can only join an active account if one of
    its rows carries the account's tax id, but its latest row and its maxima
    need all its rows.  So a first pass over two columns finds the points of
    sale, and the rows of all others are dropped before the history is
    shuffled.  ``tax_ids`` (one column ``cnpj14``) must be a stored result;
    both key sets are counted, and beyond ``max_rows`` the history stays
    whole: a shuffle of the keys would cost what the reduction saves.
    """
    if not at_most(tax_ids, max_rows):
        return hist
    ever = materialise(hist.select("num_pdv", "cnpj14")
                       .join(F.broadcast(tax_ids.select("cnpj14").distinct()), "cnpj14", "left_semi")
                       .select("num_pdv").distinct())
    if not at_most(ever, max_rows):
        return hist
    return hist.join(F.broadcast(ever), "num_pdv", "left_semi").select(*hist.columns)
