"""Plan checks: partition pruning, column pruning, join kinds, no Python in plans."""

import os

import pytest

from possum.operators import clients as C
from possum.operators.pdv import pdv_history, pdv_normalised
from possum.plans.queries import QUERIES
from possum.sources import fixtures
from possum.sources.scans import extract, scan_since, scan_upto
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def partitioned(spark, tmp_path_factory):
    """The fixture inputs written as the daily-partitioned tables they model."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    base = str(tmp_path_factory.mktemp("tables"))
    inp = fixtures.load_inputs(spark, SF_SMALL)
    inp.s_pdv.write.partitionBy("ano", "mes", "dia").parquet(os.path.join(base, "s_pdv"))
    inp.cli.write.partitionBy("anomesdia").parquet(os.path.join(base, "cli"))
    return (spark.read.parquet(os.path.join(base, "s_pdv")),
            spark.read.parquet(os.path.join(base, "cli")))


def test_history_scan_prunes_partitions(partitioned):
    s_pdv, _ = partitioned
    plan = _plan(scan_upto(s_pdv, 20240115))
    assert "PartitionFilters: [" in plan
    pf = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "20240115" in pf and "lpad" in pf
    # Partition text read back as int (mes=1) still gives the right rows.
    assert scan_upto(s_pdv, 20240115).count() == 1384


def test_string_predicate_prunes_too(partitioned):
    s_pdv, _ = partitioned
    pred = "CAST(PDV.ano || LPAD(CAST(PDV.mes AS STRING), 2, '0') || LPAD(CAST(PDV.dia AS STRING), 2, '0') AS INT) <= 20240115"
    df = extract(s_pdv, predicate=pred, columns=["PDV.num_pdv AS num_pdv"], alias="PDV")
    plan = _plan(df)
    assert "20240115" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert df.count() == 1384


def test_client_snapshot_reads_one_day(partitioned):
    _, cli = partitioned
    plan = _plan(C.client_snapshot(cli, 20240115, ()))
    pf = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "20240115" in pf
    assert "20240115" in _plan(scan_since(cli, 20240115)).split("PartitionFilters: [", 1)[1]


def test_column_pruning_reaches_scan(spark):
    df = QUERIES["revenue_matrix"](spark, SF_SMALL)
    schema = _plan(df).split("ReadSchema: ", 1)[1].split("\n", 1)[0]
    assert "l_suppkey" in schema and "l_shipdate" in schema and "l_extendedprice" in schema
    assert "l_comment" not in schema and "l_quantity" not in schema


def test_window_normalisation_uses_one_exchange(spark):
    inp = fixtures.load_inputs(spark, SF_SMALL)
    h = pdv_history(inp.s_pdv, 20240115, keep=("seq",))
    plan = pdv_normalised(h, ("seq",), "window")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_semi_and_anti_joins(spark):
    inp = fixtures.load_inputs(spark, SF_SMALL)
    exits = C.exit_accounts(inp.cli, ())
    assert "LeftSemi" in _plan(C.exit_history(inp.cli, exits))
    assert "LeftAnti" in _plan(C.never_left_accounts(C.client_snapshot(inp.cli, 20240115, ()), exits))


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_in_any_registered_plan(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                   "MapInPandas"):
        assert marker not in plan


def test_bucketed_history_needs_no_exchange(spark):
    from possum.operators.pdv import latest_pdv

    inp = fixtures.load_inputs(spark, SF_SMALL)
    name = "possum_bucketed_pdv"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (inp.s_pdv.write.partitionBy("ano", "mes", "dia").bucketBy(8, "num_pdv")
        .sortBy("num_pdv").saveAsTable(name))
    try:
        hist = pdv_history(spark.table(name), 20240115, keep=("seq",))
        latest = latest_pdv(hist, ("seq",))
        plan = _plan(latest)
        assert "Exchange" not in plan
        assert latest.count() == 150
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_revenue_aggregation_stays_in_codegen(spark):
    df = QUERIES["revenue_matrix"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    aggs = [line for line in final.splitlines() if "HashAggregate(" in line]
    assert len(aggs) == 2 and all("*(" in line for line in aggs)
