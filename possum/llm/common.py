"""Small helpers shared by the operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import checkpoint_dir

ROOT = str(Path(__file__).resolve().parents[2])


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: its root joins their PYTHONPATH.

    On a cluster the package is installed on the workers or sent with
    ``--py-files``; then this entry is harmless.
    """
    env = spark.sparkContext.environment
    # Workers give memory back after large batches instead of keeping it.
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    env.setdefault("MALLOC_ARENA_MAX", "1")
    env.setdefault("MALLOC_TRIM_THRESHOLD_", "1048576")
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text column, null counting as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``shared_path`` named, once nothing reads it any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256,
           most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The batches cut to few rows and about ``most`` bytes of texts, so that few whole
    texts become Python objects at once.  A longer text is a slice of its own."""
    for batch in batches:
        held = np.zeros(batch.num_rows, dtype=np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                held += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(held)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            end = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + most, "right"))))
            yield batch.slice(at, end - at)
            at = end


def map_rows(df: DataFrame, schema: str, rows: Callable[[list[dict]], Iterator[tuple]],
             chunk: int = 256) -> DataFrame:
    """``mapInArrow`` for functions over small lists of row dicts.

    ``rows`` gets at most ``chunk`` input rows at a time, and a few MB of text,
    and yields output tuples in the order of ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    out_schema = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, chunk):
            got = list(rows(batch.to_pylist()))
            if got:
                cols = [pa.array(c, type=f.type) for c, f in zip(zip(*got), out_schema)]
                yield pa.RecordBatch.from_arrays(cols, schema=out_schema)

    return df.mapInArrow(run, schema)
