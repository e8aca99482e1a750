"""Sink: a result partitioned by run day, rewritten one day at a time.

A load evaluates its plan once, into a staging folder below the target
(readers skip names that start with an underscore).  A marker file then makes
the new days final, and each is renamed into place.  A load that dies before
its marker leaves every day as it was; one that dies after it is finished by
the next load of the target (``finish_loads``).  Loads of one target must not
run at the same time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

STAGING = "_staging"
MARKER = "_COMMITTED"


def _folder(spark: SparkSession, path: str):
    """(file system, path) of ``path``, wherever it is stored."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _folder(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def _has_loose_files(spark: SparkSession, path: str) -> bool:
    """Whether data files lie directly in ``path`` (so it is not partitioned)."""
    fs, folder = _folder(spark, path)
    return fs.exists(folder) and any(
        f.isFile() and f.getPath().getName()[0] not in "._" for f in fs.listStatus(folder))


def _drop(spark: SparkSession, path: str) -> None:
    fs, folder = _folder(spark, path)
    if fs.exists(folder):
        fs.delete(folder, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, old = _folder(spark, source)
    _, new = _folder(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside ``path``, then rename: the file is there whole or not at all."""
    fs, part = _folder(spark, f"{path}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    _move(spark, f"{path}.part", path)


def _read_text(spark: SparkSession, path: str) -> str:
    fs, file = _folder(spark, path)
    stream = fs.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _swap(spark: SparkSession, location: str, stage: str) -> tuple[list[str], list[str]]:
    """Put the staged partitions in place; doing it again changes nothing.

    Returns the names of the partitions that were replaced and emptied.
    """
    plan = json.loads(_read_text(spark, f"{stage}/{MARKER}"))
    for name in plan["replaced"]:
        if _exists(spark, f"{stage}/new/{name}"):  # else it is in place already
            _drop(spark, f"{stage}/old/{name}")
            if _exists(spark, f"{location}/{name}"):
                _move(spark, f"{location}/{name}", f"{stage}/old/{name}")
            _move(spark, f"{stage}/new/{name}", f"{location}/{name}")
    for name in plan["emptied"]:
        _drop(spark, f"{location}/{name}")
    return plan["replaced"], plan["emptied"]


def _update_catalog(spark: SparkSession, table: str, replaced: list[str], emptied: list[str]) -> None:
    def spec(name: str) -> str:
        column, value = name.split("=", 1)
        return f"PARTITION (`{column}` = '{value}')"

    for name in replaced:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec(name)}")
    for name in emptied:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec(name)}")
    spark.catalog.refreshTable(table)


def finish_loads(spark: SparkSession, location: str, table: str | None = None) -> int:
    """Finish the loads of ``location`` that died after their marker and remove
    what others left; returns how many were finished."""
    done = 0
    for name in _names(spark, f"{location}/{STAGING}"):
        stage = f"{location}/{STAGING}/{name}"
        if _exists(spark, f"{stage}/{MARKER}"):
            replaced, emptied = _swap(spark, location, stage)
            if table is not None:
                _update_catalog(spark, table, replaced, emptied)
            done += 1
        _drop(spark, stage)
    return done


def _describe(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(
        "col_name IN ('Location', 'Provider')").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def load(df: DataFrame, table: str | None = None, path: str | None = None,
         partition_by: str = "anomesdia", fmt: str = "parquet", day: int | None = None) -> None:
    """Write ``df`` partitioned by ``partition_by``; a rerun replaces only its days.

    With ``table``: the first run creates the catalog table (at ``path`` when
    given).  With only ``path``: a path-based dataset.  Days without rows in
    ``df`` stay untouched, but for ``day``: an empty result empties it.  ``df``
    is evaluated once.  A target that is not partitioned by ``partition_by``
    raises before any write.
    """
    if table is None and path is None:
        raise ValueError("give a table name or a path")
    spark = df.sparkSession
    location = path
    if table is not None:
        if spark.catalog.tableExists(table):
            parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
            if parts != [partition_by]:
                raise ValueError(f"{table} is partitioned by {parts}, not by [{partition_by!r}]")
        else:
            writer = spark.createDataFrame([], df.schema).write.format(fmt).partitionBy(partition_by)
            (writer.option("path", path) if path is not None else writer).saveAsTable(table)
        known = _describe(spark, table)
        location, fmt = known["Location"], known["Provider"]
        df = df.to(spark.table(table).schema)
    elif _has_loose_files(spark, path):
        raise ValueError(f"{path} is not partitioned by {partition_by}")
    finish_loads(spark, location, table)
    stage = f"{location}/{STAGING}/{uuid.uuid4().hex}"
    df.write.format(fmt).partitionBy(partition_by).save(f"{stage}/new")
    replaced = [n for n in _names(spark, f"{stage}/new") if n.startswith(f"{partition_by}=")]
    own = f"{partition_by}={day}"
    emptied = [own] if day is not None and own not in replaced else []
    _write_text(spark, f"{stage}/{MARKER}", json.dumps({"replaced": replaced, "emptied": emptied}))
    finish_loads(spark, location, table)
