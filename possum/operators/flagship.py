"""Eligible points of sale owned by active segment clients (the flagship result)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.columns import account_of, branch_of
from .joins import DEFAULT_BROADCAST_ROWS, at_most, materialise, maybe_broadcast
from .ordering import DEFAULT_MAX_GROUP_ROWS

PDV_CLIENT_COLUMNS = [
    "num_pdv", "numero_unico_cliente", "cnpj14", "cnpjbas", "numero_agencia", "numero_conta",
    "cod_mot_can", "cod_gru_ram", "cod_ram_atvd", "cod_cnae", "cod_cep", "uf", "cidade",
    "dat_can_pdv", "dat_cdst_pdv", "dat_rtvc_pdv", "dat_updt", "anomesdia",
]

# Published name of each column, in output order.
PUBLISHED = [
    ("num_pdv", "numero_ponto_venda"),
    ("numero_unico_cliente", "numero_unico_cliente"),
    ("cnpj14", "numero_cnpj14"),
    ("cnpjbas", "numero_cnpj_base"),
    ("numero_agencia", "numero_agencia"),
    ("numero_conta", "numero_conta"),
    ("cod_mot_can", "codigo_motivo_cancelamento"),
    ("cod_gru_ram", "codigo_grupo_ramo"),
    ("cod_ram_atvd", "codigo_ramo_atividade"),
    ("cod_cnae", "codigo_cnae"),
    ("cod_cep", "codigo_cep"),
    ("uf", "sigla_unidade_federativa"),
    ("cidade", "nome_cidade_estabelecimento"),
    ("dat_can_pdv", "data_cancelamento_ponto_venda"),
    ("dat_cdst_pdv", "data_cadastro_ponto_venda"),
    ("dat_rtvc_pdv", "data_reativacao_ponto_venda"),
    ("dat_updt", "data_atualizacao_ponto_venda"),
    ("anomesdia", "anomesdia"),
]


def active_accounts(accounts: DataFrame) -> DataFrame:
    """Active accounts in the shape of the flagship join, keyed by ``cnpj14``."""
    return accounts.where(F.col("flag_conta_ativa")).select(
        F.col("numero_cnpj_completo").cast("long").alias("cnpj14"),
        "numero_unico_cliente",
        branch_of("agencia_conta").alias("numero_agencia"),
        account_of("agencia_conta").alias("numero_conta"),
    )


def hot_tax_ids(latest: DataFrame, active: DataFrame, max_rows: int) -> DataFrame | None:
    """Tax ids with more than ``max_rows`` rows on a side, and the shares each
    side is cut into (``_l``, ``_r``); None if there are none.

    Counted map-side; at most rows / max_rows of them.
    """
    def sizes(side: DataFrame, name: str) -> DataFrame:
        return (side.groupBy("cnpj14").agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > max_rows)
                .select("cnpj14", F.ceil(F.col("_n") / max_rows).cast("int").alias(name)))

    found = sizes(latest, "_l").join(sizes(active, "_r"), "cnpj14", "full").where("cnpj14 IS NOT NULL")
    hot = materialise(found.select("cnpj14", F.coalesce("_l", F.lit(1)).alias("_l"),
                                   F.coalesce("_r", F.lit(1)).alias("_r")))
    return None if hot.isEmpty() else hot


def pdv_clients(latest: DataFrame, accounts: DataFrame, estab: DataFrame,
                max_group_rows: int = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Latest point-of-sale rows × active accounts of the same tax id, with the
    latest establishment attached when there is one.

    Not distinct: a point of sale repeats once per active account row of its
    tax id.  The establishment comes first, before the accounts multiply the
    rows.  Both sides are stored and the rows of each tax id counted; a hot
    one (``hot_tax_ids``) is cut into shares on its own side and repeated on
    the other, so no task holds it whole, whatever the session's settings.
    """
    return pdv_clients_stored(materialise(latest), materialise(active_accounts(accounts)), estab,
                              max_group_rows)


def pdv_clients_stored(latest: DataFrame, active: DataFrame, estab: DataFrame,
                       max_group_rows: int = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """``pdv_clients`` over stored results (``active`` from ``active_accounts``).

    Stored by ``sources.colocate`` under the same key, both joins need no
    exchange as long as no tax id is hot.
    """
    latest, estab = latest.where(F.col("cnpj14").isNotNull()), estab.select("cnpj14", "uf", "cidade", "cod_cep")
    active = active.where(F.col("cnpj14").isNotNull())
    hot = hot_tax_ids(latest, active, max_group_rows)
    if hot is None:
        return _select(latest.join(estab, "cnpj14", "left").join(active, "cnpj14"))
    small = at_most(hot, DEFAULT_BROADCAST_ROWS)

    def shares(side: DataFrame) -> DataFrame:
        return (side.join(maybe_broadcast(hot, small), "cnpj14", "left")
                .withColumn("_l", F.coalesce("_l", F.lit(1))).withColumn("_r", F.coalesce("_r", F.lit(1))))

    def share(count: str, *by: str):
        return F.pmod(F.xxhash64(*by), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    rows = shares(latest).withColumn("_i", share("_l", "num_pdv"))
    places = shares(estab).withColumn("_i", every("_l")).drop("_l", "_r")
    rows = rows.join(places, ["cnpj14", "_i"], "left").withColumn("_j", every("_r"))
    others = (shares(active).withColumn("_j", share("_r", "numero_unico_cliente", "numero_agencia", "numero_conta"))
              .withColumn("_i", every("_l")).drop("_l", "_r"))
    return _select(rows.join(others, ["cnpj14", "_i", "_j"]))


def _select(joined: DataFrame) -> DataFrame:
    return joined.select(*PDV_CLIENT_COLUMNS)


def eligible(df: DataFrame, cancel_floor: int = K.CANCEL_FLOOR,
             cancelled: str = "dat_can_pdv", reactivated: str = "dat_rtvc_pdv") -> DataFrame:
    """Never cancelled, cancelled on/after ``cancel_floor``, or reactivated since."""
    can = F.col(cancelled)
    return df.where((F.coalesce(can, F.lit(K.NO_DATE)) == K.NO_DATE)
                    | (can >= F.lit(cancel_floor))
                    | (F.col(reactivated) >= can))


def publish(df: DataFrame) -> DataFrame:
    """The 18 published columns, renamed, in order."""
    return df.select(*[F.col(src).alias(dst) for src, dst in PUBLISHED])


def pdv_emps(latest: DataFrame, accounts: DataFrame, estab: DataFrame,
             cancel_floor: int = K.CANCEL_FLOOR,
             max_group_rows: int = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Flagship: eligible points of sale of active clients, published.

    The eligibility test reads only point-of-sale columns, so it is applied
    to the point-of-sale side before the joins, where it cuts the rows that
    the joins would multiply.
    """
    return publish(pdv_clients(eligible(latest, cancel_floor), accounts, estab, max_group_rows))


def pdv_emps_stored(latest: DataFrame, active: DataFrame, estab: DataFrame,
                    cancel_floor: int = K.CANCEL_FLOOR,
                    max_group_rows: int = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """``pdv_emps`` over stored results; see ``pdv_clients_stored``."""
    return publish(pdv_clients_stored(eligible(latest, cancel_floor), active, estab, max_group_rows))
