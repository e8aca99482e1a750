"""Phrase collocations (operator 13): frequent phrases of 2 to 4 words that belong together.

Two passes over the texts find every phrase of 1 to 4 words with at least
``least`` occurrences in its language:

1. Each task hashes the n-grams of a few million words at a time to classes
   of ``class_bits`` bits and ships, per hash partition, the distinct classes
   with their counts.  A partition merges them into a Misra-Gries summary
   whose capacity exceeds its mass divided by ``least``, so a class with
   ``least`` occurrences cannot leave it.  (A class counts at least as often as
   each of its n-grams; two n-grams in one class only keep more.)
2. The surviving classes become a bit filter of at most 2 x 2**29 bits, which
   is broadcast.  The texts are read again and only n-grams that pass the
   filter, with all their shorter parts, are counted, as text.  A place counts
   for the longest such n-gram that starts there only; the shorter ones there are
   summed from the merged counts.  A task sums the phrases of its chunks and
   ships them as one packed table per hash partition, which sums them again.
   The counts are exact: neither hash decides them.  The phrases shipped are
   at most one per word of the text, however many become frequent.

Beyond 2**26 surviving classes the filter passes more n-grams to the exact
count; the result stays the same and the cost linear.

A candidate's score is ``floor(2000000 * a / (l + r))`` at its lowest-scoring
cut into a first part (``l`` occurrences) and a rest (``r``), ties to the
shortest first part; candidates that lie inside a longer candidate at least
80 % as frequent go; each language's best ``top`` stay.  Products are decimals.

Defined results: a null or empty text has no words; a null lang is ``und``;
repeated rows count again; ties in score and frequency are ordered by the
phrase's UTF-8 bytes; an empty table gives no rows; only ``text`` and ``lang``
are read, so other columns, whatever their names, change nothing.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import materialise
from .common import ship

LONGEST = 4
LEAST = 30
TOP = 2000
INSIDE_PERCENT = 80
UNKNOWN = "und"
# Words whose n-grams a task holds before it ships them.
CHUNK_WORDS = 2_000_000
# Bytes of a text that are cut into words at once.
SEGMENT = 1 << 20
# Words a worker keeps numbered between chunks.
VOCABULARY = 1_000_000
# Occurrences a partition is planned for: its summary then holds at most a 30th of them.
PARTITION_MASS = 1 << 27
FEWEST_PARTITIONS = 64
SMALLEST_SUMMARY = 1 << 20
# Bytes of counted phrases that a task holds before it sends them on.
HELD_BYTES = 48 << 20
FILTER_BITS = (20, 29)

BREAK = b"\xff"  # never part of UTF-8
_PIECES = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(b + 32 if 65 <= b <= 90 else 0xFF if b in _PIECES else b for b in range(256))
_K = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class Layout:
    """Widths of the class hash and of its leading bits, which name the partition."""

    class_bits: int
    part_bits: int

    @staticmethod
    def of(n_bytes: int) -> "Layout":
        mass = LONGEST * (n_bytes // 2 + 1)  # a word and its separator take two bytes
        parts = max(FEWEST_PARTITIONS, -(-mass // PARTITION_MASS))
        return Layout(min(64, max(26, math.ceil(math.log2(mass)) + 6)), math.ceil(math.log2(parts)))

    @property
    def parts(self) -> int:
        return 1 << self.part_bits

    def part_of(self, classes: np.ndarray) -> np.ndarray:
        return classes >> np.uint64(self.class_bits - self.part_bits)


class Words:
    """Numbers of distinct words; 0 is a break between pieces."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = defaultdict(itertools.count().__next__)
        self.number[BREAK]
        self.names: list[bytes] = []
        self.hashes = np.zeros(0, dtype=np.uint64)

    def ids(self, text: str) -> list[np.ndarray]:
        """The text's words in order, by segments, with a break at the end."""
        data = text.encode().translate(_TABLE)
        out, at = [], 0
        while at < len(data):
            end = len(data)
            if end - at > SEGMENT:
                cuts = [i for c in (b" ", b"\t", BREAK) if (i := data.find(c, at + SEGMENT)) >= 0]
                end = min(cuts, default=end)
            words = data[at:end].replace(BREAK, b" \xff ").split()
            out.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
            at = end
        out.append(np.zeros(1, dtype=np.int32))
        return out

    def finish(self) -> None:
        """Names and hashes of the words numbered since the last call."""
        import xxhash

        new = list(itertools.islice(self.number, len(self.names), None))
        if new:
            self.names += new
            self.hashes = np.concatenate([self.hashes, np.fromiter(
                map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))])


class Chunk:
    """Words of some documents in a row, and the n-grams that start at each."""

    def __init__(self, words: Words, langs: list[str], ids: list[np.ndarray], lang_of: list[int],
                 lengths: list[int], layout: Layout):
        import xxhash

        words.finish()
        self.layout = layout
        self.names = words.names
        self.langs = langs
        self.tok = np.concatenate(ids)
        self.lang = np.repeat(np.array(lang_of, dtype=np.int32), lengths)
        self.word_hash = words.hashes[self.tok]
        self.lang_hash = np.array([xxhash.xxh3_64_intdigest(s, seed=1) for s in langs], np.uint64)

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words, class at each start, whether the n-gram lies in one piece)."""
        shift = np.uint64(64 - self.layout.class_bits)
        word = self.tok != 0
        state = _mix(self.word_hash + self.lang_hash[self.lang])
        inside = word
        yield 1, state >> shift, inside
        for n in range(2, LONGEST + 1):
            state = _mix(state[:-1] * _K + self.word_hash[n - 1:])
            inside = inside[:-1] & word[n - 1:]
            yield n, state >> shift, inside

    def words_by_lang(self) -> np.ndarray:
        return np.bincount(self.lang[self.tok != 0], minlength=len(self.langs))


def _chunks(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[Chunk]:
    words = Words()
    number: dict[str, int] = {}
    ids: list[np.ndarray] = []
    lang_of: list[int] = []
    lengths: list[int] = []
    held = 0
    for batch in batches:
        texts, langs = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            if not text:
                continue
            got = words.ids(text)
            size = sum(map(len, got))
            ids += got
            lang_of.append(number.setdefault(langs[i].as_py(), len(number)))
            lengths.append(size)
            held += size
            if held >= CHUNK_WORDS:
                yield Chunk(words, list(number), ids, lang_of, lengths, layout)
                ids, lang_of, lengths, held = [], [], [], 0
                if len(words.number) > VOCABULARY:
                    words.clear()
                if len(number) > VOCABULARY:
                    number = {}
    if held:
        yield Chunk(words, list(number), ids, lang_of, lengths, layout)


def _pack(values: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed: planes of zeros take no room."""
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def _counted(classes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct classes, sorted, with the sums of their counts."""
    if not len(classes):
        return classes, np.zeros(0, dtype=np.int64)
    if counts is None:
        classes = np.sort(classes)
    else:
        order = np.argsort(classes, kind="stable")
        classes, counts = classes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
    if counts is None:
        sums = np.diff(first, append=len(classes))
    else:
        sums = np.add.reduceat(counts, first)
    return classes[first], sums.astype(np.int64)


class Summary:
    """Misra-Gries summary of classes; summaries of parts of the data merge into it."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.classes = np.zeros(0, dtype=np.uint64)
        self.counts = np.zeros(0, dtype=np.int64)
        self.lost = 0  # what a class can have lost at most
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def merge(self, classes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((classes, counts))
        self.held += len(classes)
        if self.held > self.capacity:
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        parts = [(self.classes, self.counts), *self.waiting]
        self.waiting, self.held = [], 0
        classes, counts = _counted(np.concatenate([c for c, _ in parts]),
                                   np.concatenate([n for _, n in parts]))
        if len(classes) > self.capacity:
            # Less by the largest count beyond the capacity: at least capacity + 1
            # counters fall by it, so all such steps together stay below
            # mass / capacity.
            at = len(counts) - self.capacity - 1
            less = int(np.partition(counts, at)[at])
            self.lost += less
            stay = counts > less
            classes, counts = classes[stay], counts[stay] - less
        self.classes, self.counts = classes, counts

    def at_least(self, least: int) -> np.ndarray:
        """All classes that can have ``least`` occurrences."""
        self.settle()
        return self.classes[self.counts + self.lost >= least]


_SHIPPED = "part int, kind int, mass bigint, classes binary, counts binary"
_SURVIVORS = "part int, n bigint, classes binary"
_PACKED = "part int, counts binary"
_COUNTS = "lang string, size int, phrase string, n bigint"


def _ship_classes(layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(layout.parts, dtype=np.int64)
        for chunk in _chunks(batches, layout):
            distinct, sums = _counted(np.concatenate([c[ok] for _, c, ok in chunk.grams()]))
            if not len(distinct):
                continue
            part = layout.part_of(distinct)
            mass += np.bincount(part.astype(np.int64), sums, layout.parts).astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            ends = np.append(starts[1:], len(part))
            yield pa.record_batch([
                pa.array(part[starts].astype(np.int32)),
                pa.array(np.ones(len(starts), np.int32)),
                pa.nulls(len(starts), pa.int64()),
                pa.array([_pack(np.diff(distinct[a:b], prepend=np.uint64(0)))
                          for a, b in zip(starts, ends)], pa.binary()),
                pa.array([_pack(sums[a:b]) for a, b in zip(starts, ends)], pa.binary()),
            ], ["part", "kind", "mass", "classes", "counts"])
        own = np.flatnonzero(mass)
        yield pa.record_batch([
            pa.array(own.astype(np.int32)), pa.array(np.zeros(len(own), np.int32)),
            pa.array(mass[own]), pa.nulls(len(own), pa.binary()), pa.nulls(len(own), pa.binary()),
        ], ["part", "kind", "mass", "classes", "counts"])
    return run


def _summarise(least: int, smallest: int):
    """Rows come sorted by (part, kind): a partition's masses before its classes."""
    def rows_of(part: int, summary: Summary) -> Iterator[pa.RecordBatch]:
        classes = summary.at_least(least)
        for at in range(0, len(classes), 1 << 20):
            some = classes[at:at + (1 << 20)]
            yield pa.record_batch([
                pa.array([part], pa.int32()), pa.array([len(some)], pa.int64()),
                pa.array([_pack(np.diff(some, prepend=np.uint64(0)))], pa.binary()),
            ], ["part", "n", "classes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None
        for batch in batches:
            for i in range(batch.num_rows):
                p, kind = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if p != part:
                    if summary is not None:
                        yield from rows_of(part, summary)
                    part, mass, summary = p, 0, None
                if kind == 0:
                    mass += batch.column(2)[i].as_py()
                    continue
                if summary is None:
                    summary = Summary(max(mass // least + 1, smallest))
                summary.merge(np.cumsum(_unpack(batch.column(3)[i].as_py()), dtype=np.uint64),
                              _unpack(batch.column(4)[i].as_py()).astype(np.int64))
        if summary is not None:
            yield from rows_of(part, summary)
    return run


@dataclass(frozen=True)
class Filter:
    """Two bit tables; each partition of the classes owns a slice of both."""

    layout: Layout
    bits: int
    tables: tuple[np.ndarray, np.ndarray] | None = None

    @staticmethod
    def width(layout: Layout, survivors: int) -> int:
        low, high = FILTER_BITS
        return max(min(high, max(low, math.ceil(math.log2(32 * max(survivors, 1))))),
                   layout.part_bits + 3)

    def places(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = self.bits - self.layout.part_bits
        first = classes >> np.uint64(self.layout.class_bits - self.bits)
        second = ((self.layout.part_of(classes) << np.uint64(own))
                  | (_mix(classes + _K) >> np.uint64(64 - own)))
        return first, second

    def slices(self, classes: np.ndarray) -> tuple[bytes, bytes]:
        """The owning partition's slice of both tables with the classes' bits set."""
        own = np.uint64(self.bits - self.layout.part_bits)
        out = []
        for place in self.places(classes):
            flags = np.zeros(1 << int(own), dtype=np.uint8)
            flags[place & np.uint64((1 << int(own)) - 1)] = 1
            out.append(np.packbits(flags, bitorder="little").tobytes())
        return out[0], out[1]

    def passes(self, classes: np.ndarray) -> np.ndarray:
        keep = np.ones(len(classes), dtype=bool)
        for table, place in zip(self.tables, self.places(classes)):
            keep &= (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return keep


def _filter_of(survivors: DataFrame, layout: Layout) -> Filter:
    """Built by slices in Spark; the driver puts at most 2 x 64 MB together."""
    total = survivors.agg(F.sum("n")).first()[0] or 0
    plan = Filter(layout, Filter.width(layout, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                classes = np.cumsum(_unpack(batch.column(2)[i].as_py()), dtype=np.uint64)
                first, second = plan.slices(classes)
                yield pa.record_batch([pa.array([batch.column(0)[i].as_py()], pa.int32()),
                                       pa.array([first], pa.binary()), pa.array([second], pa.binary())],
                                      ["part", "first", "second"])

    size = 1 << (plan.bits - layout.part_bits - 3)
    tables = tuple(np.zeros(layout.parts * size, dtype=np.uint8) for _ in range(2))
    for row in survivors.mapInArrow(run, "part int, first binary, second binary").toLocalIterator():
        at = slice(row["part"] * size, (row["part"] + 1) * size)
        for table, got in zip(tables, (row["first"], row["second"])):
            table[at] |= np.frombuffer(got, dtype=np.uint8)
    return Filter(layout, plan.bits, tables)


def _phrases(chunk: Chunk, known: Filter) -> Iterator[pa.RecordBatch]:
    """Exact counts of the chunk's n-grams that pass the filter with all their parts: each
    place counts once, for the longest that starts there.  The shorter ones there are its
    first words, so their counts are sums over the longer."""
    def batch(langs: list[str], size: int, phrases: list[bytes], n: np.ndarray,
              classes: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([
            pa.array(langs, pa.string()), pa.array(np.full(len(n), size, np.int32)),
            pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(n.astype(np.int64)),
            pa.array(chunk.layout.part_of(classes).astype(np.int32)),
        ], ["lang", "size", "phrase", "n", "part"])

    totals = chunk.words_by_lang()
    yield batch(chunk.langs, 0, [b""] * len(totals), totals,
                chunk.lang_hash >> np.uint64(64 - chunk.layout.class_bits))
    names, tok = chunk.names, chunk.tok

    def ended(size: int, starts: np.ndarray, counts: np.ndarray,
              classes: np.ndarray) -> Iterator[pa.RecordBatch]:
        met = np.flatnonzero(counts)
        for i in range(0, len(met), 200_000):
            some = starts[met[i:i + 200_000]]
            words = [[names[t] for t in tok[some + k].tolist()] for k in range(size)]
            yield batch([chunk.langs[k] for k in chunk.lang[some].tolist()], size,
                        [b" ".join(w) for w in zip(*words)], counts[met[i:i + 200_000]],
                        classes[some])

    kept = rank = starts = shorter = None
    for n, classes, inside in chunk.grams():
        if n > 1:
            inside = inside & kept[:-1] & kept[1:]
        at = np.flatnonzero(inside)
        at = at[known.passes(classes[at])]
        if n > 1:
            longest = kept.copy()
            longest[at] = False
            yield from ended(n - 1, starts, np.bincount(rank[longest], minlength=len(starts)),
                             shorter)
        if not len(at):
            return
        # Numbers of equal n-grams, exact: the number of the n-gram's first
        # n - 1 words (of its language at n = 1) beside its last word.
        ahead = rank[at] if n > 1 else chunk.lang[at].astype(np.int64)
        _, first, same = np.unique(ahead << 32 | tok[at + n - 1], return_index=True,
                                   return_inverse=True)
        kept = np.zeros(len(classes), dtype=bool)
        kept[at] = True
        rank = np.zeros(len(classes), dtype=np.int64)
        rank[at] = same
        starts, shorter = at[first], classes
    yield from ended(LONGEST, starts, np.bincount(rank[kept], minlength=len(starts)), shorter)


class Sums:
    """Sums of counted phrases in a bounded room: what does not fit is sent on early and
    added up by whoever comes next."""

    def __init__(self, keys: list[str], most: int):
        self.keys = keys
        self.most = most
        self.settled: pa.Table | None = None
        self.waiting: list[pa.Table] = []
        self.held = 0

    def add(self, counts: pa.Table) -> Iterator[pa.Table]:
        self.waiting.append(counts)
        self.held += counts.nbytes
        if self.held > self.most // 2:
            self.settle()
            if self.settled.nbytes > self.most // 2:
                yield from self.take()

    def settle(self) -> None:
        if self.waiting:
            parts = self.waiting if self.settled is None else [self.settled, *self.waiting]
            self.settled = (pa.concat_tables(parts).group_by(self.keys, use_threads=False)
                            .aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
                            .select(parts[0].column_names))
            self.waiting, self.held = [], 0

    def take(self) -> Iterator[pa.Table]:
        self.settle()
        if self.settled is not None and self.settled.num_rows:
            yield self.settled
        self.settled = None


def _packed(counts: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, counts.schema,
                           options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(counts)
    return sink.getvalue().to_pybytes()


def _ship_phrases(layout: Layout, known: Broadcast[Filter], most: int):
    """One row per partition for all the phrases a task has met, or for each time its room
    was full."""
    def packed(sums: pa.Table) -> Iterator[pa.RecordBatch]:
        sums = sums.sort_by([("part", "ascending"), ("lang", "ascending"), ("phrase", "ascending")])
        part = sums["part"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = np.append(starts[1:], len(part))
        counts = sums.select(["lang", "size", "phrase", "n"])
        for a, b in zip(starts, ends):
            yield pa.record_batch([
                pa.array(part[a:a + 1]),
                pa.array([_packed(counts.slice(a, b - a).combine_chunks())], pa.binary()),
            ], ["part", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(["lang", "size", "phrase", "part"], most)
        for chunk in _chunks(batches, layout):
            for batch in _phrases(chunk, known.value):
                for full in sums.add(pa.table(batch)):
                    yield from packed(full)
        for rest in sums.take():
            yield from packed(rest)
    return run


def _sum_phrases(most: int):
    """A partition's phrases with their counts; a phrase comes once more each time the
    room was full."""
    def rows_of(sums: pa.Table) -> Iterator[pa.RecordBatch]:
        return iter(sums.select(["lang", "size", "phrase", "n"]).to_batches(max_chunksize=50_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(["lang", "size", "phrase"], most)
        for batch in batches:
            for packed in batch.column(1):
                with pa.ipc.open_stream(packed.as_buffer()) as stream:
                    for full in sums.add(stream.read_all()):
                        yield from rows_of(full)
        for rest in sums.take():
            yield from rows_of(rest)
    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST,
                     smallest_summary: int = SMALLEST_SUMMARY,
                     held_bytes: int = HELD_BYTES) -> DataFrame:
    """lang, size, phrase, n: every phrase of 1 to 4 words with at least ``least``
    occurrences, and per lang one row of size 0 with the number of its words."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("text"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    layout = Layout.of(n_bytes)
    shipped = texts.mapInArrow(_ship_classes(layout), _SHIPPED)
    by_part = shipped.repartitionById(layout.parts, "part").sortWithinPartitions("part", "kind")
    survivors = materialise(by_part.mapInArrow(_summarise(least, smallest_summary), _SURVIVORS))
    known = spark.sparkContext.broadcast(_filter_of(survivors, layout))
    longest = (texts.mapInArrow(_ship_phrases(layout, known, held_bytes), _PACKED)
               .repartitionById(layout.parts, "part")
               .mapInArrow(_sum_phrases(held_bytes), _COUNTS))
    counted = materialise(longest.select("lang", "phrase", "n", F.explode(
        F.expr("sequence(least(size, 1), size)")).alias("size"))
        .select("lang", "size", F.expr("substring_index(phrase, ' ', size)").alias("phrase"), "n")
        .groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
        .where((F.col("size") == 0) | (F.col("n") >= least)))
    known.unpersist()
    return counted


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP,
                 smallest_summary: int = SMALLEST_SUMMARY) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best ``top`` phrases."""
    counted = frequent_phrases(docs, least, smallest_summary)
    total = counted.where(F.col("size") == 0).select("lang", F.col("n").alias("n"))
    known = counted.where(F.col("size") > 0)
    candidates = known.where(F.col("size") > 1).select(
        "lang", "phrase", F.col("n").alias("a"), "size", F.split("phrase", " ").alias("w"))
    # Both parts of every cut meet their counts in one join.
    parts = candidates.select("lang", "phrase", "a", F.explode(F.expr(
        "flatten(transform(sequence(1, size - 1), k -> array("
        "  struct(k, true AS ahead, array_join(slice(w, 1, k), ' ') AS part),"
        "  struct(k, false AS ahead, array_join(slice(w, k + 1, size - k), ' ') AS part))))"
    )).alias("c")).select("lang", "phrase", "a", "c.k", "c.ahead", "c.part")
    counts = known.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    cuts = parts.join(counts, ["lang", "part"]).groupBy("lang", "phrase", "a").agg(*[
        F.max(F.when((F.col("k") == k) & (F.col("ahead") == ahead), F.col("f"))).alias(f"{side}{k}")
        for k in range(1, LONGEST) for ahead, side in ((True, "l"), (False, "r"))])
    scored = cuts.select("lang", "phrase", "a", F.array_min(F.filter(F.array(*[
        F.when(F.col(f"l{k}").isNotNull(), F.struct(
            F.expr(f"(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)))"
                   f" div (CAST(l{k} AS DECIMAL(19,0)) + CAST(r{k} AS DECIMAL(19,0)))").alias("score"),
            F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        for k in range(1, LONGEST)]), lambda c: c.isNotNull())).alias("cut"))
    # The most frequent longer candidate around each candidate.
    around = candidates.where(F.col("size") > 2).select("lang", F.col("a").alias("longer"), F.explode(
        F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1),"
               " i -> array_join(slice(w, i, m), ' '))))")).alias("phrase"))
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    stay = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull()
        | F.expr(f"CAST(longer AS DECIMAL(19,0)) * 100 < CAST(a AS DECIMAL(19,0)) * {INSIDE_PERCENT}"))
    rows = stay.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                       F.col("cut.score").alias("score"))
    # First the best of hashed shares of a language, then of the language: no
    # task sorts all phrases of a large one.
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    shares = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = (shares.withColumn("at", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best)))
           .where(F.col("at") <= top).drop("share", "at"))
    ranked = (few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
              .where(F.col("rank") <= top))
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
