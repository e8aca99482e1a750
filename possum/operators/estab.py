"""Latest establishment row per company tax id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import snapshot_int
from .ordering import latest_per_key

ESTAB_COLUMNS = ["cnpj14", "uf", "cidade", "cod_cep"]


def latest_estab(s_estb: DataFrame, tie_break: Sequence[str] = (), method: str = "aggregate") -> DataFrame:
    """One row per tax id: the establishment of the most recent snapshot day.

    Reads every snapshot (the table is not filtered by day).  The pick is an
    aggregate, not a window, so a tax id with very many snapshot rows is
    combined map-side instead of sorted in a single task.  ``tie_break``
    columns (descending) decide between rows of the same day.
    ``method="window"`` is the literal ``row_number() = 1`` form, kept for
    comparison.
    """
    rows = s_estb.select(
        F.col("num_cad_grl_ctri_estb").alias("cnpj14"),
        F.col("cod_sgl_uf").alias("uf"),
        F.trim("nom_cid_estb").alias("cidade"),
        F.col("cod_cep_estb").alias("cod_cep_text"),
        snapshot_int().alias("_day"),
        *[F.col(c).alias(f"_tb_{c}") for c in tie_break],
    )
    order = ["_day", *[f"_tb_{c}" for c in tie_break]]
    if method == "window":
        w = Window.partitionBy("cnpj14").orderBy(*[F.col(c).desc_nulls_last() for c in order])
        latest = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    elif method == "aggregate":
        latest = latest_per_key(rows, ["cnpj14"], order, ["uf", "cidade", "cod_cep_text"])
    else:
        raise ValueError(f"unknown method {method!r}")
    # Cast after the pick: only the published row's postcode must parse.
    return latest.select("cnpj14", "uf", "cidade",
                         F.col("cod_cep_text").cast("int").alias("cod_cep"))
