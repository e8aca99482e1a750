
import pytest
from pyspark.sql import functions as F

from possum.plans.queries import _Job
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def job(spark):
    return _Job(spark, SF_MID)


def test_one_row_per_key(job):
    latest = job.latest_pdv()
    assert latest.count() == latest.select("num_pdv").distinct().count() == 1498
    estab = job.estab()
    assert estab.count() == estab.select("cnpj14").distinct().count() == 150


def test_no_exit_journey_and_flag_rule(job):
    acc = job.accounts()
    assert acc.where(F.col("jornada") == "resseg out").count() == 0
    bad = acc.where(F.col("flag_conta_ativa") != (
        F.col("data_encerramento_conta_emps").isNull()
        | (F.col("data_encerramento_conta_emps") == F.lit("9999-12-31").cast("date"))))
    assert bad.count() == 0
    counts = {r.jornada: r["count"] for r in acc.groupBy("jornada").count().collect()}
    assert counts == {"onboarding": 990, "one_itau": 1897, "ressegmentacao": 1004, None: 5}


def test_every_flagship_row_is_eligible(job):
    out = job.pdv_emps()
    can, rtvc = F.col("data_cancelamento_ponto_venda"), F.col("data_reativacao_ponto_venda")
    assert out.where(~((F.coalesce(can, F.lit(0)) == 0) | (can >= 20231001) | (rtvc >= can))).count() == 0
    assert out.count() == 15065


def test_lifecycle_sizes(job):
    life = job.lifecycle()
    assert life.count() == 3913
    assert life.where(F.col("data_encerramento_conta").isNotNull()).count() == 1648
