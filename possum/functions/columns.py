"""Projections shared by the jobs.  No Python UDFs: every helper returns a
built-in ``Column`` expression, so it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def snapshot_int(ano: str | Column = "ano", mes: str | Column = "mes",
                 dia: str | Column = "dia") -> Column:
    """Snapshot day ``yyyymmdd`` as int from the three partition parts.

    Month and day may be unpadded text, or ints when read back from a
    partitioned table, so each part is cast to text and left-padded.  Used in
    a ``where`` over partition columns, it prunes partitions.
    """
    return F.concat(
        _c(ano).cast("string"),
        F.lpad(_c(mes).cast("string"), 2, "0"),
        F.lpad(_c(dia).cast("string"), 2, "0"),
    ).cast("int")


def _padded_tax_id(c: str | Column) -> Column:
    # Trim first, then pad: padding before trimming would keep inner blanks.
    return F.lpad(F.trim(_c(c).cast("string")), K.TAX_ID_WIDTH, "0")


def tax_id14(c: str | Column) -> Column:
    """Company tax id as 14-digit bigint (text is trimmed, zero-padded, cast)."""
    return _padded_tax_id(c).cast("long")


def tax_id_base(c: str | Column) -> Column:
    """First 8 of the 14 padded digits, as int."""
    return F.substring(_padded_tax_id(c), 1, K.TAX_ID_BASE_WIDTH).cast("int")


def date_text_to_int(c: str | Column) -> Column:
    """``'yyyy-MM-dd...'`` text → int ``yyyymmdd``; NULL, blank or malformed → 0.

    One rule for both places the job reads these dates.  Malformed text also
    becomes 0 instead of failing the run; ``count_malformed_dates`` reports it.
    """
    text = _c(c).cast("string")
    digits = F.replace(F.substring(text, 1, 10), F.lit("-"), F.lit(""))
    # The blank test is only a shortcut: try_cast fails slowly on blank text.
    return (F.when(F.trim(text) == "", F.lit(K.NO_DATE))
            .otherwise(F.coalesce(digits.try_cast("int"), F.lit(K.NO_DATE))))


def malformed_date(c: str | Column) -> Column:
    """Whether date text is present but not a date that ``date_text_to_int`` can read."""
    text = _c(c).cast("string")
    digits = F.replace(F.substring(text, 1, 10), F.lit("-"), F.lit(""))
    return F.coalesce((F.trim(text) != "") & digits.try_cast("int").isNull(), F.lit(False))


def count_malformed_dates(df: DataFrame, *columns: str) -> DataFrame:
    """One row: malformed texts per column, in one aggregate."""
    return df.agg(*[F.count_if(malformed_date(c)).alias(c) for c in columns])


def account_key(branch: str | Column = "numero_agencia",
                account: str | Column = "numero_conta") -> Column:
    """``branch_account`` key; NULL when either part is NULL."""
    return F.concat(_c(branch), F.lit(K.ACCOUNT_KEY_SEP), _c(account))


def branch_of(key: str | Column) -> Column:
    """Characters 1-4 of the account key."""
    return F.substring(_c(key), 1, 4)


def account_of(key: str | Column) -> Column:
    """Characters 6-12 of the account key."""
    return F.substring(_c(key), 6, 7)


def year_month_text(anomesdia: str | Column) -> Column:
    """``yyyymmdd`` int → ``yyyyMM`` text."""
    return F.substring(_c(anomesdia).cast("string"), 1, 6)
