"""Large-item matching: pack documents into few fixed-size sequences (operator 8).

Token counts are at most the capacity, so the whole packing problem is a
histogram of lengths with at most ``capacity`` entries, whatever the number of
documents.  ``plan_bins`` packs that histogram on the driver: lengths above a
third of the capacity fit at most twice in a bin and are matched greedily
(the longest with the longest that still fits), then smaller lengths, longest
first, fill the tightest gap that holds them, then new bins.  Equal lengths
are placed many at a time, so the plan is a bounded list of runs: pieces of
length L with ranks a..a+n-1 go to bins b..b+n-1 at offset o.

Spark numbers the pieces of each length (salted, so a length that holds a
third of all pieces is numbered by many tasks) and looks each up in the plan.

Defined results: a null or empty text is the end-of-document id alone; a
document longer than the capacity is cut into whole sequences and one rest;
repeated rows are packed as often as they occur; a null doc_id stays null;
an empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import materialise
from .common import map_rows, ship, shuffle_partitions, text_of
from .tokens import vocabulary_path, word_ids

CAPACITY = 4096
END_ID = 1
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@dataclass
class Plan:
    """Runs of equal pieces, sorted by (length, rank)."""

    length: np.ndarray
    rank: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    bins: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset) of pieces given their length and rank from 0."""
        first = np.searchsorted(self.length, length, "left")
        last = np.searchsorted(self.length, length, "right")
        # The last run of that length whose first rank is not above the piece's.
        while (open_ := last - first > 1).any():
            mid = (first + last) // 2
            below = open_ & (self.rank[mid.clip(max=len(self.rank) - 1)] <= rank)
            first, last = np.where(below, mid, first), np.where(open_ & ~below, mid, last)
        return self.bin[first] + rank - self.rank[first], self.offset[first]


def plan_bins(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """``counts[L]``: number of pieces of length L, 0 < L <= capacity."""
    left = np.array(counts, dtype=np.int64)
    next_rank = np.zeros_like(left)
    runs: list[tuple[int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first bin, bins)
    open_bins = np.zeros(capacity + 1, dtype=np.int64)
    bins = 0

    def put(length: int, n: int, first_bin: int, offset: int) -> None:
        runs.append((length, int(next_rank[length]), first_bin, offset))
        next_rank[length] += n
        left[length] -= n

    def leave(gap: int, first_bin: int, n: int) -> None:
        if gap:
            gaps[gap].append((first_bin, n))
            open_bins[gap] += n

    third = capacity // 3
    for length in range(capacity, third, -1):
        while left[length]:
            fits = min(length, capacity - length)
            partners = np.flatnonzero(left[third + 1:fits + 1]) + third + 1
            if len(partners) and partners[-1] == length and left[length] == 1:
                partners = partners[:-1]
            if not len(partners):
                n = int(left[length])
                put(length, n, bins, 0)
                leave(capacity - length, bins, n)
            else:
                other = int(partners[-1])
                n = int(left[length] // 2 if other == length else min(left[length], left[other]))
                put(length, n, bins, 0)
                put(other, n, bins, length)
                leave(capacity - length - other, bins, n)
            bins += n
    for length in range(third, 0, -1):
        while left[length]:
            tight = np.flatnonzero(open_bins[length:])
            if len(tight):
                gap = int(tight[0]) + length
                first_bin, have = gaps[gap].pop()
                n = min(have, int(left[length]))
                open_bins[gap] -= have
                if have > n:
                    leave(gap, first_bin + n, have - n)
                put(length, n, first_bin, capacity - gap)
                leave(gap - length, first_bin, n)
            else:
                each = capacity // length
                n, rest = divmod(int(left[length]), each)
                n, each = (n, each) if n else (1, rest)
                for k in range(each):
                    put(length, n, bins, k * length)
                leave(capacity - each * length, bins, n)
                bins += n
    runs.sort()
    cols = np.array(runs, dtype=np.int64).reshape(-1, 4).T
    return Plan(cols[0], cols[1], cols[2], cols[3], bins)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenised documents cut at ``capacity``: one row per piece."""

    def rows(docs_in: list[dict]) -> Iterator[tuple]:
        coded = word_ids(path).encode_batch([d["text"] for d in docs_in])
        for d, ids in zip(docs_in, coded):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            for k, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at:at + capacity]
                yield d["doc_id"], k, at, len(part), zlib.crc32(part.tobytes())

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                text_of().alias("text")), PIECES, rows)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, salts: int | None = None) -> DataFrame:
    """One row per piece with its sequence_id and offset there."""
    spark = docs.sparkSession
    salts = salts or max(64, shuffle_partitions(spark))
    cut = materialise(pieces(docs, path or vocabulary_path(), capacity, end_id)
                      .withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"),
                                                 F.lit(salts)).cast("int")))
    # At most capacity x salts rows.
    sizes = materialise(cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # <= capacity rows
        counts[r["length"]] = r["n"]
    plan = plan_bins(counts, capacity)
    earlier = (Window.partitionBy("length").orderBy("salt")
               .rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select("length", "salt",
                          F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (cut.withColumn("local", F.row_number().over(order) - 1)
              .join(before, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("before") + F.col("local")).alias("rank")))
    schema = f"{PIECES}, sequence_id bigint, offset bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seq, offset = plan.place(b.column("length").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(seq), pa.array(offset)],
                names=[*b.schema.names[:5], "sequence_id", "offset"])

    ship(spark)
    return ranked.mapInArrow(run, schema)
