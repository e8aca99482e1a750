"""Journey rules on single rows (CND1-CND5)."""

import datetime as dt

from pyspark.sql import functions as F

from possum.functions.rules import (entry_or_exit, event_date, is_active, journey_label,
                                    journey_override, opening_date)

D1, D2, END = dt.date(2024, 1, 1), dt.date(2023, 6, 1), dt.date(9999, 12, 31)


def test_event_date_and_side(spark):
    df = spark.createDataFrame(
        [("resseg in", D1, D2), ("resseg out", D1, D2), ("outro", D1, D2), (None, D1, D2)],
        "canal string, data_aceite_ressegmentacao date, data_abertura_conta date")
    got = [tuple(r) for r in df.select(event_date(), entry_or_exit()).collect()]
    assert got == [(D1, "entrada"), (D1, "resseg out"), (D2, "entrada"), (D2, "entrada")]


def test_override_first_list_wins_and_empty_lists(spark):
    df = spark.createDataFrame([("a", "resseg in"), ("b", "outros"), ("c", None)],
                               "k string, canal string")
    both = df.select(journey_override("k", "canal", ["a", "b"], ["b", "c"])).collect()
    assert [r[0] for r in both] == ["outros", "outros", "onboarding"]
    none = df.select(journey_override("k", "canal", [], [])).collect()
    assert [r[0] for r in none] == ["resseg in", "outros", None]


def test_label_opening_and_active(spark):
    df = spark.createDataFrame(
        [("resseg in", D1, D2, None), ("outros", D1, D2, END), ("outro", D1, D2, D1),
         (None, D1, D2, None), ("onboarding", D1, D2, D2)],
        "jornada string, data_aceite_ressegmentacao date, "
        "data_inicio_relacionamento_bancario date, closing date")
    got = [tuple(r) for r in df.select(journey_label(), opening_date(),
                                       is_active("closing")).collect()]
    assert got == [("ressegmentacao", D1, True), ("one_itau", D2, True), ("one_itau", D2, False),
                   (None, D2, True), ("onboarding", D2, False)]
    assert df.select(is_active("closing", dt.date(2024, 1, 1)).alias("a")).where(
        F.col("a")).count() == 3
