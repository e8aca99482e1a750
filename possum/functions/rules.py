"""Business rules of the client-account life cycle, as ``Column`` expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def event_date(canal: str = "canal", accepted: str = "data_aceite_ressegmentacao",
               opened: str = "data_abertura_conta") -> Column:
    """Resegmentation events date by acceptance, any other channel by opening."""
    return (F.when(F.col(canal).isin(K.CHANNEL_RESSEG_IN, K.CHANNEL_RESSEG_OUT), F.col(accepted))
            .otherwise(F.col(opened)))


def entry_or_exit(canal: str = "canal") -> Column:
    """Ranking side: exits apart, everything else (NULL channel too) is an entry."""
    return (F.when(F.col(canal) == K.CHANNEL_RESSEG_OUT, F.lit(K.CHANNEL_RESSEG_OUT))
            .otherwise(F.lit(K.SIDE_ENTRY)))


def journey_override(key: str, canal: str, to_outros: Sequence[str],
                     to_onboarding: Sequence[str]) -> Column:
    """Listed accounts get a fixed journey (first list wins), others keep the channel."""
    expr = None
    for accounts, value in ((to_outros, K.CHANNEL_OUTROS), (to_onboarding, K.CHANNEL_ONBOARDING)):
        if not accounts:
            continue
        cond = F.col(key).isin(list(accounts))
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return F.col(canal) if expr is None else expr.otherwise(F.col(canal))


def journey_label(jornada: str = "jornada") -> Column:
    """Published journey label; unknown values (NULL included) pass unchanged."""
    j = F.col(jornada)
    return (F.when(j == K.CHANNEL_RESSEG_IN, F.lit(K.LABEL_RESSEG))
            .when(j.isin(K.CHANNEL_OUTROS, K.CHANNEL_OUTRO), F.lit(K.LABEL_ONE))
            .otherwise(j))


def opening_date(jornada: str = "jornada", accepted: str = "data_aceite_ressegmentacao",
                 started: str = "data_inicio_relacionamento_bancario") -> Column:
    """Opening date of the segment account: acceptance for a resegmentation entry."""
    return F.when(F.col(jornada) == K.CHANNEL_RESSEG_IN, F.col(accepted)).otherwise(F.col(started))


def is_active(closing: str, open_end: dt.date = K.OPEN_END) -> Column:
    """Open account: closing date NULL or the open-end sentinel.  Never NULL."""
    c = F.col(closing)
    return c.isNull() | (c == F.lit(open_end))
