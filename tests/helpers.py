"""Builders of hand-made input rows in the declared schemas."""

import datetime as dt

from pyspark.sql import types as T

from possum import schemas

PDV_SCHEMA = T.StructType(schemas.S_PDV.fields + [T.StructField("seq", T.LongType())])
ESTB_SCHEMA = T.StructType(schemas.S_ESTB.fields + [T.StructField("seq", T.LongType())])


def pdv_row(num_pdv, day, seq, can=None, rtvc=None, estb=1230000000191, cnae=" 7 ",
            mot=1, ram=2, gru=0, cdst="2020-01-01"):
    y, m, d = day[:4], str(int(day[4:6])), str(int(day[6:8]))
    return (num_pdv, estb, cnae, mot, ram, gru, cdst, can, rtvc, y, m, d, seq)


def estb_row(cnpj, day, seq, uf="BR", cidade=" X ", cep="00001001"):
    y, m, d = day[:4], str(int(day[4:6])), str(int(day[6:8]))
    return (cnpj, uf, cidade, cep, y, m, d, seq)


def cli_row(cnpj, client, ag, conta, canal, accepted, opened, closed, day):
    def dd(s):
        return None if s is None else dt.date.fromisoformat(s)
    return (cnpj, client, ag, conta, canal, dd(accepted), dd(opened), dd(closed), day)


def pdv_df(spark, rows):
    return spark.createDataFrame(rows, PDV_SCHEMA)


def estb_df(spark, rows):
    return spark.createDataFrame(rows, ESTB_SCHEMA)


def cli_df(spark, rows):
    return spark.createDataFrame(rows, schemas.CLI)


def tx_df(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame(
        [(p, d, None if v is None else Decimal(str(v))) for p, d, v in rows], schemas.TX)
