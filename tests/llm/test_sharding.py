"""The directory against splitting by hand, and the writing tasks' bounds."""

import collections
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from possum.llm import sharding
from tests.conftest import SF_SMALL

BITS = sharding.BITS


def split(rows, limit, prefix=0, depth=0):
    """Shards of (hash, bytes) rows: a bucket is split on its next bit only if it is too large."""
    if sum(b for _, b in rows) <= limit or len(rows) == 1 or depth == BITS:
        return {(format(prefix, f"0{depth}b") if depth else "-"): rows} if rows or not depth else {}
    out = {}
    for bit in (0, 1):
        part = [r for r in rows if r[0] >> (BITS - depth - 1) & 1 == bit]
        if part:
            out |= split(part, limit, prefix << 1 | bit, depth + 1)
    return out


@pytest.mark.parametrize("limit", [5_000, 20_000, 10**9])
def test_directory_is_minimal(spark, limit):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").dropDuplicates(["doc_id"])
    rows = [(r["__h"], r["__bytes"]) for r in sharding.hashed(docs).collect()]
    want = split(rows, limit)
    placed, shards = sharding.assign(docs, limit)
    got = collections.defaultdict(list)
    for r in placed.select("doc_id", "text", "shard").join(
            sharding.hashed(docs).select("doc_id", "__h", "__bytes"), "doc_id").collect():
        got[r["shard"]].append((r["__h"], r["__bytes"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert {(r["shard"], r["shard_bytes"]) for r in shards.collect()} == {
        (k, sum(b for _, b in v)) for k, v in want.items()}


def test_each_shard_is_one_tasks_and_tasks_are_bounded(spark, scratch_dir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    limit, path = 20_000, os.path.join(scratch_dir, "shards")
    shards = {r["shard"]: r["shard_bytes"] for r in sharding.write_shards(docs, path, limit).collect()}
    back = spark.read.schema(T.StructType([*docs.schema.fields, T.StructField("shard", T.StringType())])).parquet(path)
    files = back.select("shard", F.input_file_name().alias("f")).distinct().collect()
    assert len(files) == len(shards)                        # one file a shard: one task wrote it
    held = collections.Counter()
    for r in files:
        held[os.path.basename(r["f"]).split("-")[1]] += shards[r["shard"]]
    assert len(held) > 3
    largest = max(shards.values())
    assert max(held.values()) <= sharding.TASK_SHARDS * max(limit, largest)


def test_clashing_and_odd_columns_are_kept(spark, scratch_dir):
    rows = [(1, "a b", "mine", 5), (1, "a b", "mine", 5), (None, None, None, None), (2, "", "x", 1), (3, "é" * 50, "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string, bytes int")
    assert sharding.shard_column(docs) == "shard_"
    path = os.path.join(scratch_dir, "shards")
    sharding.write_shards(docs, path, 60)
    back = spark.read.schema(T.StructType([*docs.schema.fields, T.StructField("shard_", T.StringType())])).parquet(path)
    assert sorted(map(str, back.drop("shard_").collect())) == sorted(map(str, docs.collect()))
    got = sharding.shard_documents(docs, 60)
    assert sorted(got.columns) == ["bytes", "depth", "doc_id", "shard", "shard_bytes"]
    assert sorted((str(r["doc_id"]), r["bytes"]) for r in got.collect()) == sorted(
        (str(i), len((t or "").encode())) for i, t, _, _ in rows)
    assert sharding.shard_documents(docs.limit(0), 60).collect() == []
