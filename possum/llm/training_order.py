"""Training-order materialisation of token ids (operator 1).

Texts become ids (each closed by the end id) in one stream, cut into
sequences of ``SEQUENCE`` ids; only the last is filled up with end ids.  A
keyed Feistel permutation with cycle-walking over exactly the number of
sequences gives each a global slot, and the sequences are written in slot
order: shard k holds slots k * per_shard and up as records of one fixed
stride (unsigned 16-bit little-endian ids and one line feed), so a reader
finds slot s at byte (s mod per_shard) * stride of its shard and can resume
anywhere.

1. One pass tokenises and writes each text's ids with its place in its task's
   part of the stream; the parts' lengths (one number a task) give the places
   in the whole stream.
2. The pieces of sequences are dealt to their shard by slot (one shuffle),
   sorted, joined to records and written by Spark's text writer, which passes
   bytes through and commits each shard once.

The stream's order is that of the input's rows; the written ids fix it, so a
lost executor cannot change it.  Defined results: a null or empty text is the
end id alone; repeated rows appear as often as they occur; a null doc_id
stays null in the listing; an empty table writes nothing.  Extra columns are
ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import materialise
from ..plans.session import settings
from .common import map_rows, shared_path, ship, text_of
from .tokens import vocabulary_path, word_ids

SEQUENCE = 2048
PER_SHARD = 8192
END_ID = 1
KEY = 2024
ROUNDS = 6


@dataclass
class Layout:
    """What a reader needs: number of sequences, ids in one, records in a shard, key."""

    sequences: int
    sequence: int
    per_shard: int
    key: int

    @property
    def stride(self) -> int:
        return 2 * self.sequence + 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slots(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The keyed permutation of 0..n-1, applied to ``index``."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)

    def once(x: np.ndarray) -> np.ndarray:
        a, b = x >> half, x & mask
        for r in range(ROUNDS):
            salt = np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % 2**64)
            a, b = b, a ^ (_mix(b + salt) & mask)
        return (a << half) | b

    x = once(np.asarray(index, dtype=np.uint64))
    while (out := x >= np.uint64(n)).any():
        x[out] = once(x[out])
    return x.astype(np.int64)


STAGED = "doc_id bigint, part int, at bigint, n int, ids binary"


def _staged(docs: DataFrame, path: str, vocabulary: str) -> DataFrame:
    place = {"task": -1, "at": 0}

    def rows(batch: list[dict]) -> Iterator[tuple]:
        task = TaskContext.get()
        if place["task"] != task.taskAttemptId():
            place.update(task=task.taskAttemptId(), at=0)
        coder = word_ids(vocabulary)
        if len(coder.ends) > 1 << 16:
            raise ValueError("records hold 16-bit ids; the vocabulary has more")
        coded = coder.encode_batch([d["text"] for d in batch])
        for d, ids in zip(batch, coded):
            ids = np.append(ids, END_ID).astype("<u2")
            yield d["doc_id"], task.partitionId(), place["at"], len(ids), ids.tobytes()
            place["at"] += len(ids)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    map_rows(texts, STAGED, rows).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(STAGED).parquet(path)


def _bases(staged: DataFrame) -> tuple[dict[int, int], int]:
    """Start of each task's part in the stream (one number a task), and the stream's length."""
    sizes = staged.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("n")).collect()
    bases, total = {}, 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        bases[r["part"]] = total
        total += r["n"]
    return bases, total


def _pieces(begin: int, n: int, sequence: int) -> Iterator[tuple[int, int, int, int]]:
    """(sequence, place in it, from, to) of ids ``begin``.. of the stream."""
    at = 0
    while at < n:
        seq, place = divmod(begin + at, sequence)
        take = min(n - at, sequence - place)
        yield seq, place, at, at + take
        at += take


def _dealt(staged: DataFrame, bases: dict[int, int], layout: Layout, with_ids: bool) -> DataFrame:
    """One row per piece of a sequence: its slot and place, its doc_id or its ids."""

    def rows(batch: list[dict]) -> Iterator[tuple]:
        found = [(d, p) for d in batch
                 for p in _pieces(bases[d["part"]] + d["at"], d["n"], layout.sequence)]
        slot = slots(np.array([p[0] for _, p in found]), layout.sequences, layout.key)
        for (d, (_, place, a, b)), s in zip(found, slot.tolist()):
            yield s, place, d["ids"][2 * a:2 * b] if with_ids else d["doc_id"]

    cols = ["part", "at", "n", "ids" if with_ids else "doc_id"]
    return map_rows(staged.select(*cols),
                    f"slot bigint, place int, {'ids binary' if with_ids else 'doc_id bigint'}", rows)


def _records(dealt: DataFrame, layout: Layout) -> DataFrame:
    """Pieces sorted by (slot, place) joined to whole records."""
    full, end = 2 * layout.sequence, np.uint16(END_ID).astype("<u2").tobytes()
    last = int(slots(np.array([layout.sequences - 1]), layout.sequences, layout.key)[0])
    ship(dealt.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids.cache_clear()  # the worker's token tables make room for the records
        slot, parts = None, []

        def record() -> bytes:
            got = b"".join(parts)
            if slot == last:
                got += end * ((full - len(got)) // 2)
            if len(got) != full:
                raise ValueError(f"slot {slot} has {len(got)} bytes instead of {full}")
            return got

        for batch in batches:
            out = []
            for s, ids in zip(batch.column("slot").to_pylist(), batch.column("ids").to_pylist()):
                if s != slot:
                    if parts:
                        out.append(record())
                    slot, parts = s, []
                parts.append(ids)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([record()], pa.binary())], names=["record"])

    return dealt.mapInArrow(run, "record binary")


def materialise_order(docs: DataFrame, path: str, vocabulary: str | None = None,
                      sequence: int = SEQUENCE, per_shard: int = PER_SHARD,
                      key: int = KEY) -> tuple[Layout, DataFrame]:
    """Write the shards to ``path`` (and the layout to ``path``-layout).

    Returns the layout and (slot, place, doc_id) of every piece of a text.
    """
    spark = docs.sparkSession
    staged = _staged(docs, f"{path}-ids", vocabulary or vocabulary_path())
    bases, total = _bases(staged)
    layout = Layout(-(-total // sequence), sequence, per_shard, key)
    if layout.sequences:
        shards = -(-layout.sequences // per_shard)
        dealt = (_dealt(staged, bases, layout, True)
                 .repartitionById(shards, F.floor(F.col("slot") / per_shard).cast("int"))
                 .sortWithinPartitions("slot", "place"))
        (_records(dealt, layout).select(F.col("record").cast("string").alias("value"))
         .write.option("lineSep", "\n").text(path))
    spark.createDataFrame([(json.dumps(asdict(layout)),)], "value string").coalesce(1) \
        .write.text(f"{path}-layout")
    return layout, _dealt(staged, bases, layout, False)


def read_layout(spark: SparkSession, path: str) -> Layout:
    return Layout(**json.loads(spark.read.text(f"{path}-layout").first()["value"]))


def _read(spark: SparkSession, path: str, layout: Layout, start: int, stop: int, schema: str,
          columns: Callable[[list[bytes]], list[pa.Array]]) -> DataFrame:
    """slot, shard, byte_offset and ``columns`` of the records of slots start..stop-1."""
    shard = F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    files = (spark.read.format("binaryFile").load(path).select(shard.alias("shard"), "content")
             .where(F.col("shard").between(start // layout.per_shard,
                                           (stop - 1) // layout.per_shard)))
    names = spark.createDataFrame([], schema).columns
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids.cache_clear()  # the worker's token tables make room for the shards
        for batch in batches:
            for k in range(batch.num_rows):
                shard_no = batch.column(0)[k].as_py()
                content = memoryview(batch.column(1)[k].as_buffer())
                first = shard_no * layout.per_shard
                low, high = max(start, first), min(stop, first + layout.per_shard)
                for at in range(low, high, 512):
                    numbers = range(at, min(at + 512, high))
                    begins = [(s - first) * layout.stride for s in numbers]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(numbers, pa.int64()), pa.array([shard_no] * len(begins), pa.int32()),
                         pa.array(begins, pa.int64()),
                         *columns([content[b:b + layout.stride - 1] for b in begins])], names=names)

    return files.mapInArrow(run, schema)


def read_order(spark: SparkSession, path: str, start: int = 0, stop: int | None = None) -> DataFrame:
    """(slot, shard, byte_offset, ids) of slots start..stop-1; only their shards are read."""
    layout = read_layout(spark, path)
    stop = layout.sequences if stop is None else min(stop, layout.sequences)
    schema = "slot bigint, shard int, byte_offset bigint, ids binary"
    if start >= stop:
        return spark.createDataFrame([], schema)
    return _read(spark, path, layout, start, stop, schema,
                 lambda records: [pa.array([bytes(r) for r in records], pa.binary())])


def _digests(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """slot, shard, byte_offset, n_ids, ids_crc32 of every record as it is read back.

    One Python pass over one shard at a time: a second worker beside the reader, or
    a batch of several shards, would hold an executor's memory for nothing.
    """
    schema = "slot bigint, shard int, byte_offset bigint, n_ids int, ids_crc32 bigint"
    if not layout.sequences:
        return spark.createDataFrame([], schema)
    found = _read(spark, path, layout, 0, layout.sequences, schema,
                  lambda records: [pa.array([len(r) // 2 for r in records], pa.int32()),
                                   pa.array([zlib.crc32(r) for r in records], pa.int64())])
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}):
        return materialise(found)


def training_order(docs: DataFrame) -> DataFrame:
    """Write the order to the shared folder; one row per sequence read back:
    slot, shard, byte_offset, n_ids, ids_crc32 (of its bytes), doc_ids."""
    spark = docs.sparkSession
    path = shared_path(spark, "training_order")
    layout, listed = materialise_order(docs, path)
    found = _digests(spark, path, layout)
    # At most SEQUENCE pieces in a sequence.
    docs_in = listed.groupBy("slot").agg(F.array_sort(F.collect_list(F.struct("place", "doc_id")))
                                         .alias("parts"))
    return found.join(docs_in, "slot").select(
        "slot", "shard", "byte_offset", "n_ids", "ids_crc32",
        F.col("parts.doc_id").alias("doc_ids"))
