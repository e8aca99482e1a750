"""Sink reruns replace only their day; the run loads the flagship."""

import os

from pyspark.sql import functions as F

from possum.plans.job import run
from possum.sources import fixtures
from possum.sources.sinks import load
from tests.conftest import SF_SMALL


def test_path_rerun_replaces_only_its_day(spark, scratch_dir):
    path = os.path.join(scratch_dir, "out")
    day = lambda d, n: spark.range(n).select(F.col("id"), F.lit(d).alias("anomesdia"))
    load(day(20240101, 3), path=path)
    load(day(20240102, 2), path=path)
    load(day(20240101, 5), path=path)
    got = {r.anomesdia: r["count"] for r in spark.read.parquet(path).groupBy("anomesdia").count().collect()}
    assert got == {20240101: 5, 20240102: 2}


def test_table_rerun_replaces_only_its_day(spark):
    name = "possum_sink_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    day = lambda d, n: spark.range(n).select(F.col("id"), F.lit(d).alias("anomesdia"))
    load(day(20240101, 3), table=name)
    load(day(20240102, 4), table=name)
    load(day(20240102, 1), table=name)
    got = {r.anomesdia: r["count"] for r in spark.table(name).groupBy("anomesdia").count().collect()}
    assert got == {20240101: 3, 20240102: 1}
    spark.sql(f"DROP TABLE {name}")


def test_run_loads_flagship(spark, scratch_dir):
    inp = fixtures.load_inputs(spark, SF_SMALL)
    path = os.path.join(scratch_dir, "emps")
    run(inp.s_pdv, inp.s_estb, inp.cli, fixtures.FIXTURE_PARAMS, path=path)
    back = spark.read.parquet(path)
    assert back.count() == 1635
    assert {r.anomesdia for r in back.select("anomesdia").distinct().collect()} == {20240115}


def test_run_from_catalog_two_days_and_rerun(spark):
    import dataclasses

    from possum.plans.job import run_from_catalog

    inp = fixtures.load_inputs(spark, SF_SMALL)
    names = {"pdv": "possum_s_pdv", "estb": "possum_s_estb", "cli": "possum_cli", "out": "possum_emps"}
    for n in names.values():
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    inp.s_pdv.write.partitionBy("ano", "mes", "dia").saveAsTable(names["pdv"])
    inp.s_estb.write.partitionBy("ano", "mes", "dia").saveAsTable(names["estb"])
    inp.cli.write.partitionBy("anomesdia").saveAsTable(names["cli"])
    p = fixtures.FIXTURE_PARAMS
    args = (names["pdv"], names["estb"], names["cli"], names["out"])
    run_from_catalog(spark, p, *args)
    before = spark.table(names["out"]).count()
    assert before == 1635
    earlier = dataclasses.replace(p, execute_date=20240114)
    run_from_catalog(spark, earlier, *args)
    run_from_catalog(spark, p, *args)          # rerun: replaces only its own day
    days = {r.anomesdia: r["count"] for r in spark.table(names["out"]).groupBy("anomesdia").count().collect()}
    assert set(days) == {20240114, 20240115} and days[20240115] == 1635
    for n in names.values():
        spark.sql(f"DROP TABLE {n}")


def test_load_needs_a_target(spark):
    import pytest

    with pytest.raises(ValueError):
        load(spark.range(1).withColumn("anomesdia", F.lit(1)))


def _day(spark, d, n):
    return spark.range(n).select(F.col("id"), F.lit(d).alias("anomesdia"))


def _days(df):
    return {r.anomesdia: r["count"] for r in df.groupBy("anomesdia").count().collect()}


def test_empty_rerun_empties_only_its_day(spark, scratch_dir):
    path = os.path.join(scratch_dir, "out")
    name = "possum_sink_empty"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for target in ({"path": path}, {"table": name}):
        load(_day(spark, 20240101, 3), day=20240101, **target)
        load(_day(spark, 20240102, 2), day=20240102, **target)
        load(_day(spark, 20240101, 0), day=20240101, **target)
        back = spark.table(name) if "table" in target else spark.read.parquet(path)
        assert _days(back) == {20240102: 2}
    spark.sql(f"DROP TABLE {name}")


def test_unpartitioned_target_raises_and_keeps_rows(spark, scratch_dir):
    import pytest

    path = os.path.join(scratch_dir, "flat")
    name = "possum_sink_flat"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _day(spark, 20240101, 3).write.parquet(path)
    _day(spark, 20240101, 3).write.saveAsTable(name)
    for target in ({"path": path}, {"table": name}):
        with pytest.raises(ValueError):
            load(_day(spark, 20240102, 1), day=20240102, **target)
    assert _days(spark.read.parquet(path)) == _days(spark.table(name)) == {20240101: 3}
    spark.sql(f"DROP TABLE {name}")


def test_job_splits_skew_and_restores_the_session(spark):
    from possum.plans.session import skew_split

    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    with skew_split(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == "false"
    spark.conf.set(key, before)


def _dir(path):
    return [n for n in sorted(os.listdir(path)) if n[0] not in "._" or n == "_staging"]


def _jobs(spark, action):
    """How many Spark jobs an action starts."""
    sc = spark.sparkContext
    group = f"count-{id(action)}"
    sc.setJobGroup(group, group)
    try:
        out = action()
    finally:
        sc._jsc.sc().clearJobGroup()
    return len(sc.statusTracker().getJobIdsForGroup(group)), out


def test_load_evaluates_its_plan_once(spark, scratch_dir):
    import pyspark

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    for name, n in (("rows", 1000), ("none", 0)):
        seen = spark.sparkContext.accumulator(0)
        assert isinstance(seen, pyspark.Accumulator)
        plan = spark.range(1000).withColumn("anomesdia", F.lit(20240101)).mapInArrow(
            count, "id bigint, anomesdia int").where(F.col("id") < n)
        load(plan, path=os.path.join(scratch_dir, name), day=20240101)
        assert seen.value == 1000


class Crash(Exception):
    pass


def _crash_in(monkeypatch, name, at=1):
    """Let the ``at``-th call of a sink step fail, once."""
    from possum.sources import sinks

    real, calls = getattr(sinks, name), [0]

    def step(*args):
        calls[0] += 1
        if calls[0] == at:
            raise Crash
        return real(*args)

    monkeypatch.setattr(sinks, name, step)


def test_crash_before_the_marker_keeps_the_old_day(spark, scratch_dir, monkeypatch):
    import pytest

    path = os.path.join(scratch_dir, "out")
    load(_day(spark, 20240101, 3), path=path, day=20240101)
    with monkeypatch.context() as m, pytest.raises(Crash):
        _crash_in(m, "_write_text")
        load(_day(spark, 20240101, 7), path=path, day=20240101)
    assert _days(spark.read.parquet(path)) == {20240101: 3}
    load(_day(spark, 20240102, 2), path=path, day=20240102)
    assert _days(spark.read.parquet(path)) == {20240101: 3, 20240102: 2}
    assert os.listdir(os.path.join(path, "_staging")) == []


def test_failing_plan_keeps_the_old_day(spark, scratch_dir):
    import pytest

    path = os.path.join(scratch_dir, "out")
    load(_day(spark, 20240101, 3), path=path, day=20240101)
    bad = _day(spark, 20240101, 5).withColumn("id", F.expr("CASE WHEN id = 4 THEN raise_error('x') ELSE id END"))
    with pytest.raises(Exception, match="x"):
        load(bad, path=path, day=20240101)
    assert _days(spark.read.parquet(path)) == {20240101: 3}


def test_crash_during_the_swap_is_finished_by_the_next_load(spark, scratch_dir, monkeypatch):
    import pytest

    two = _day(spark, 20240101, 5).unionByName(_day(spark, 20240102, 6))
    for at in (2, 3, 4, 5):  # each move of the swap in turn; the first is the marker's
        path = os.path.join(scratch_dir, f"out{at}")
        load(_day(spark, 20240101, 3).unionByName(_day(spark, 20240102, 4)), path=path)
        with monkeypatch.context() as m, pytest.raises(Crash):
            _crash_in(m, "_move", at)
            load(two, path=path)
        load(_day(spark, 20240103, 1), path=path, day=20240103)
        assert _days(spark.read.parquet(path)) == {20240101: 5, 20240102: 6, 20240103: 1}


def test_crash_before_emptying_a_day_of_a_table(spark, monkeypatch):
    import pytest

    from possum.sources import sinks

    name = "possum_sink_crash"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    load(_day(spark, 20240101, 3).unionByName(_day(spark, 20240102, 4)), table=name)
    with monkeypatch.context() as m, pytest.raises(Crash):
        _crash_in(m, "_swap")
        load(_day(spark, 20240101, 0), table=name, day=20240101)
    assert _days(spark.table(name)) == {20240101: 3, 20240102: 4}
    place = sinks._describe(spark, name)["Location"]
    assert sinks.finish_loads(spark, place, name) == 1
    assert _days(spark.table(name)) == {20240102: 4}
    spark.sql(f"DROP TABLE {name}")


def test_load_keeps_the_types_of_the_table(spark):
    name = "possum_sink_types"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    load(_day(spark, 20240101, 3), table=name)
    load(_day(spark, 20240102, 2).select(F.col("anomesdia"), F.col("id").cast("int").alias("id")), table=name)
    assert spark.table(name).schema["id"].dataType.simpleString() == "bigint"
    assert spark.table(name).agg(F.sum("id")).first()[0] == 4
    spark.sql(f"DROP TABLE {name}")
