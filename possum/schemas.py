"""Declared input schemas; inputs are checked up front so bad types fail fast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S_PDV = T.StructType([
    T.StructField("num_pdv", T.LongType()),
    T.StructField("num_cad_grl_ctri_estb", T.LongType()),
    T.StructField("cod_cnae", T.StringType()),
    T.StructField("cod_mot_can", T.IntegerType()),
    T.StructField("cod_ram_atvd", T.IntegerType()),
    T.StructField("cod_gru_ram", T.IntegerType()),
    T.StructField("dat_cdst_pdv", T.StringType()),
    T.StructField("dat_can_pdv", T.StringType()),
    T.StructField("dat_rtvc_pdv", T.StringType()),
    T.StructField("ano", T.StringType(), False),
    T.StructField("mes", T.StringType(), False),
    T.StructField("dia", T.StringType(), False),
])

S_ESTB = T.StructType([
    T.StructField("num_cad_grl_ctri_estb", T.LongType()),
    T.StructField("cod_sgl_uf", T.StringType()),
    T.StructField("nom_cid_estb", T.StringType()),
    T.StructField("cod_cep_estb", T.StringType()),
    T.StructField("ano", T.StringType(), False),
    T.StructField("mes", T.StringType(), False),
    T.StructField("dia", T.StringType(), False),
])

CLI = T.StructType([
    T.StructField("cnpj", T.StringType()),
    T.StructField("id_cnpj_eq3", T.LongType()),
    T.StructField("numero_agencia", T.StringType()),
    T.StructField("numero_conta", T.StringType()),
    T.StructField("canal", T.StringType()),
    T.StructField("data_aceite_ressegmentacao", T.DateType()),
    T.StructField("data_abertura_conta", T.DateType()),
    T.StructField("data_encerramento_conta", T.DateType()),
    T.StructField("anomesdia", T.IntegerType(), False),
])

TX = T.StructType([
    T.StructField("numero_ponto_venda", T.LongType()),
    T.StructField("anomesdia", T.IntegerType(), False),
    T.StructField("valor_transacao", T.DecimalType(18, 2)),
])

# Partition columns may come back from a partitioned table as integers
# ("mes=01" reads as 1); the snapshot-day expression casts them to text.
_TEXT_OR_INT = (T.StringType, T.IntegerType, T.LongType)
_LENIENT = {"ano", "mes", "dia"}


def require(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Check that ``df`` has every column of ``schema`` with its type; return ``df``.

    Extra columns (tie-break keys, lineage) pass through.  Only the schema is
    read, so this costs no job.
    """
    have = {f.name.lower(): f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        got = have.get(f.name.lower())
        if got is None:
            problems.append(f"missing column {f.name}")
        elif f.name in _LENIENT and isinstance(got, _TEXT_OR_INT):
            continue
        elif got != f.dataType:
            problems.append(f"{f.name}: expected {f.dataType.simpleString()}, got {got.simpleString()}")
    if problems:
        raise ValueError(f"input {name} does not match its schema: " + "; ".join(problems))
    return df
