"""Extendible hashing: documents into shards of bounded size (operator 10).

A document's hash decides its shard.  The directory maps hash prefixes to
buckets; a bucket over the byte limit is split on its next bit, others stay
as they are, until every bucket fits.  Sizes of all prefixes come from one
aggregate of the documents at a depth a few bits below the expected one,
added up towards the root; only what is still too large there is looked at
again, deeper.  A shard is named by its bits.

Defined results: a null or empty text has 0 bytes; a document over the limit
has a shard of its own; rows that are repeated until their copies exceed the
limit are told apart by their place in the input, so the input must be read
the same way twice (a table or a written result is); a null doc_id hashes
like any value; an empty table gives no rows and no shards.  Extra columns
are written with their documents, but for one named ``shard``, which is
replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import materialise
from .common import shared_path, text_of

LIMIT = 64 * 1024 * 1024
BITS = 62            # bits of the hash that a directory can use
EXTRA = 4            # bits below the expected depth that one aggregate looks at
# Directory entries up to this number are broadcast (two numbers each).
BROADCAST_ENTRIES = 500_000
TASK_SHARDS = 3      # limits a writing task may hold


def hashed(docs: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """``docs`` with __h (62 bits), __bytes."""
    text = text_of()
    out = (docs.withColumn("__h", F.shiftrightunsigned(F.xxhash64("doc_id", text), 64 - BITS))
           .withColumn("__bytes", F.octet_length(text).cast("long")))
    if heavy is not None:
        # At most total bytes / limit hashes, a stored result.
        few = heavy.count() <= BROADCAST_ENTRIES
        heavy = heavy.withColumn("__heavy", F.lit(True))
        out = out.withColumn("__rid", F.monotonically_increasing_id())
        out = out.join(F.broadcast(heavy) if few else heavy, "__h", "left")
        mixed = F.shiftrightunsigned(F.xxhash64("__h", "__rid"), 64 - BITS)
        out = out.withColumn("__h", F.when(F.col("__heavy"), mixed).otherwise(F.col("__h")))
        out = out.drop("__rid", "__heavy")
    return out


def _bits(prefix, depth):
    """The prefix as ``depth`` binary digits; '-' for the root."""
    return F.when(depth == 0, F.lit("-")).otherwise(F.lpad(F.bin(prefix), depth, "0"))


def directory(sizes: DataFrame, limit: int) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """Maps per depth of lookup, and the shards.

    Returns [(bits, entries (prefix, shard))], each for the documents that no
    earlier map has, and (shard, depth, shard_bytes, documents).
    """
    total = sizes.agg(F.sum("__bytes")).first()[0] or 0
    from_depth, depth = 0, min(BITS, math.ceil(math.log2(max(1, total / limit))) + EXTRA)
    open_rows, maps, shards = sizes, [], None
    while True:
        leaves = materialise(open_rows.groupBy(
            F.shiftrightunsigned("__h", BITS - depth).alias("prefix"))
            .agg(F.sum("__bytes").alias("bytes"), F.count(F.lit(1)).alias("documents")))
        up = leaves.select("prefix", "bytes", "documents", F.explode(F.sequence(
            F.lit(0 if from_depth == 0 else from_depth + 1), F.lit(depth))).alias("depth"))
        at = F.expr(f"shiftrightunsigned(prefix, {depth} - depth)")
        tree = (up.groupBy("depth", at.alias("node"))
                .agg(F.sum("bytes").alias("bytes"), F.sum("documents").alias("documents")))
        tree = materialise(tree.withColumn("fits", (F.col("bytes") <= limit)
                                           | (F.col("documents") == 1)))
        parents = tree.where(~F.col("fits")).select(
            (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
        top = from_depth + 1 if from_depth else 0
        split = tree.withColumn("parent", F.shiftrightunsigned("node", 1)).join(
            parents.withColumn("asked", F.lit(True)), ["depth", "parent"], "left")
        chosen = materialise(split.where(F.col("fits") & (F.col("asked") | (F.col("depth") == top)))
                             .select("depth", "node", _bits(F.col("node"), F.col("depth"))
                                     .alias("shard"), "bytes", "documents"))
        entries = materialise(up.select("depth", at.alias("node"), "prefix")
                              .join(chosen.select("depth", "node", "shard"), ["depth", "node"])
                              .select("prefix", "shard"))
        maps.append((depth, entries))
        done = chosen.select("shard", "depth", F.col("bytes").alias("shard_bytes"), "documents")
        shards = done if shards is None else shards.unionByName(done)
        large = tree.where((F.col("depth") == depth) & ~F.col("fits")).select("node")
        if depth >= BITS or large.isEmpty():
            return maps, materialise(shards)
        open_rows = materialise(open_rows.join(
            large, F.shiftrightunsigned("__h", BITS - depth) == F.col("node"), "left_semi"))
        from_depth, depth = depth, min(BITS, depth + 8)


def assign(docs: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """(``docs`` with ``shard``, the shards)."""
    sizes = materialise(hashed(docs).select("__h", "__bytes"))
    heavy = materialise(sizes.groupBy("__h").agg(F.sum("__bytes").alias("b"), F.count("*").alias("n"))
                        .where((F.col("b") > limit) & (F.col("n") > 1)).select("__h"))
    if heavy.isEmpty():
        heavy = None
    else:
        sizes = materialise(hashed(docs, heavy).select("__h", "__bytes"))
    maps, shards = directory(sizes, limit)
    name = shard_column(docs)
    out, found = hashed(docs, heavy), []
    for k, (depth, entries) in enumerate(maps):
        small = entries.count() <= BROADCAST_ENTRIES
        entries = entries.toDF(f"__prefix{k}", f"__shard{k}")
        on = F.shiftrightunsigned("__h", BITS - depth) == F.col(f"__prefix{k}")
        out = out.join(F.broadcast(entries) if small else entries, on, "left")
        found.append(F.col(f"__shard{k}"))
    return out.select(*docs.columns, F.col("__bytes"), F.coalesce(*found).alias(name)), shards


def shard_column(docs: DataFrame) -> str:
    """Name of the added column: ``shard``, longer if the table has such a column."""
    name = "shard"
    while name in docs.columns:
        name += "_"
    return name


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Write one folder per shard below ``path``; return the shards.

    Shards are at most ``limit`` bytes (or one document).  In the order of
    their names they are dealt to tasks of at most ``TASK_SHARDS`` limits, so
    a task's work does not grow with the corpus and no shard is cut.
    """
    placed, shards = assign(docs, limit)
    name = shard_column(docs)
    # One row per shard is sorted here.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    tasks = materialise(shards.select(F.col("shard").alias(name), F.floor(
        F.coalesce(F.sum("shard_bytes").over(before), F.lit(0)) / ((TASK_SHARDS - 1) * limit))
        .alias("start")).select(name, (F.dense_rank().over(Window.orderBy("start")) - 1).alias("__task")))
    many = tasks.agg(F.max("__task")).first()[0]
    if many is not None:
        small = tasks.count() <= BROADCAST_ENTRIES
        dealt = placed.drop("__bytes").join(F.broadcast(tasks) if small else tasks, name)
        (dealt.repartitionById(many + 1, F.col("__task")).drop("__task")
         .write.partitionBy(name).parquet(path))
    return shards


def shard_documents(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Write the shards to the shared folder; one row per written document:
    doc_id, bytes, shard, depth, shard_bytes."""
    spark = docs.sparkSession
    path = shared_path(spark, "shards")
    shards = write_shards(docs, path, limit)
    if shards.isEmpty():
        return spark.createDataFrame([], "doc_id bigint, bytes bigint, shard string, depth int, "
                                         "shard_bytes bigint")
    name = shard_column(docs)
    schema = docs.select("doc_id", "text").schema.add(name, "string")
    written = spark.read.schema(schema).parquet(path).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length(text_of()).cast("long").alias("bytes"), F.col(name).alias("shard"))
    return written.join(shards.select("shard", "depth", "shard_bytes"), "shard").select(
        "doc_id", "bytes", "shard", "depth", "shard_bytes")
