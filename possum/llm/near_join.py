"""Chosen-path similarity join of word n-gram sets (operator 7).

Documents whose sets of five-word shingles have a Jaccard similarity of 0.8
or more are linked.

1. One pass over the texts gives each document its set's digest and a sketch
   of 64 minimum hashes (one permutation, empty bins filled from full ones).
   Documents with equal sets form a class; one of them stands for it.
2. Runs deal the classes into buckets by a sampled shared token (bin and
   minimum).  A bucket over ``SMALL`` classes is split again on two tokens
   sampled for it, level by level, until it is small or its average
   similarity is so high that splitting cannot part it.  ``runs_needed`` gives
   the runs that find a pair at the threshold with probability ``RECALL``:
   seven without a split, nine at the deepest.  Classes in buckets that were
   split get the further runs that the depth reached asks for.
   Buckets with the same members are kept once.
3. Buckets are compared by brute force on exact sets (of 64-bit hashes).  A
   bucket over ``BLOCK`` classes (or their shingles) is cut into blocks, and
   each pair of blocks is a task of its own, so no bucket is one task's work
   and none is dropped.  The links of a family of m different, mutually alike
   texts are counted exactly, so its cost grows with m squared: a text
   travels m / ``BLOCK`` times.  A pair that shares several buckets counts in the first only.
   Tasks return one row per class (its links, the first member of its linked
   group), not pairs: a group of n near copies never becomes n*n rows.
4. Connected components of these rows give the groups.

Texts of fewer than five words have one shingle of all their words.  Defined
results: a null text counts as empty; texts without words are linked to
nothing and form groups of their own; rows with a null doc_id take part and
sort after all others; a group's id is its smallest doc_id; repeated rows are
copies of each other; an empty table gives no rows.  Extra columns are
ignored by the join and kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import materialise
from .common import map_rows, ship, shuffle_partitions, text_of

WORDS = 5
LEAST = 0.8
BINS = 64
RECALL = 0.9999      # of pairs at LEAST, whatever the number of splits
SMALL = 4096         # classes in a bucket that is compared at once
BLOCK = 4096         # classes in a block of a larger bucket
BLOCK_SHINGLES = 1_000_000
LEVELS = 12
FILTER = 1 << 21     # numbers by which texts in no bucket are left out
KEPT_WORDS = 500_000  # hashes a worker keeps
PROBES = 32          # bins that estimate a bucket's average similarity
DENSE = 0.7          # average similarity from which a bucket is not split

_RNG = np.random.default_rng(20240104)
_PLACE = _RNG.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# For each bin, the order in which full bins are looked for if it is empty.
_ORDER = np.stack([_RNG.permutation(BINS) for _ in range(BINS)])
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(58)


class _WordHashes(dict[bytes, int]):
    """64-bit hashes of words, kept for the words met lately."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= KEPT_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word, seed=20240104)
        return got


_WORD_HASHES = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    words = text.encode().split()  # at ASCII white space
    if not words:
        return np.zeros(0, dtype=np.uint64)
    word = np.fromiter(map(_WORD_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(word))
    count = len(word) - width + 1
    out = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        out += word[k:k + count] * _PLACE[k]
    return np.unique(_mix(out))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Minimum of each bin (by the hash's top bits) as 32 bits; empty bins borrow."""
    at = np.searchsorted(hashes, _EDGES)
    full = np.diff(np.append(at, len(hashes))) > 0
    source = np.arange(BINS)
    if not full.all():
        empty = np.flatnonzero(~full)
        order = _ORDER[empty]
        source[empty] = order[np.arange(len(empty)), full[order].argmax(1)]
    return (hashes[at[source]] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def _key(doc_id: int | None, text_hash: int) -> bytes:
    """Sorts by doc_id, nulls last, then by the text's hash."""
    return struct.pack(">BQq", doc_id is None, ((doc_id or 0) + 2**63) % 2**64, text_hash)


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, key, cls (digest of the set), n (its size), mins."""

    def rows(batch: list[dict]) -> Iterator[tuple]:
        for d in batch:
            found, key = shingles(d["text"]), _key(d["doc_id"], d["text_hash"])
            cls = hashlib.blake2b(found.tobytes() or key, digest_size=16).digest()
            mins = sketch(found).tolist() if len(found) else []
            yield d["doc_id"], d["text_hash"], key, cls, len(found), mins

    return map_rows(_with_hash(docs), "doc_id bigint, text_hash bigint, key binary, "
                                      "cls binary, n int, mins array<int>", rows)


def _with_hash(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))


def _child(bucket, bin_):
    return F.xxhash64(bucket, bin_, F.element_at("mins", bin_ + 1))


def runs_needed(depth: int, recall: float = RECALL) -> int:
    """Runs that find a pair of similarity LEAST with probability ``recall`` when
    its buckets are split ``depth`` times.

    A pair that agrees in a share f of its bins leaves a run at the root with
    probability 1 - f, and a split if both sampled tokens lose it.  The number
    of bins that agree is binomial.
    """
    shares = [(k / BINS, math.comb(BINS, k) * LEAST**k * (1 - LEAST)**(BINS - k))
              for k in range(BINS + 1)]
    lost = []
    for f, weight in shares:
        below = 0.0
        for _ in range(depth):
            below = (1 - f + f * below) ** 2
        lost.append((1 - f + f * below, weight))
    return next((r for r in range(1, BINS) if sum(w * x**r for x, w in lost) <= 1 - recall), BINS)


def _children() -> Column:
    """Buckets that a member of ``bucket`` goes on to: two bins are sampled for the bucket."""
    first = F.pmod(F.xxhash64("bucket", F.lit(0)), F.lit(BINS))
    second = F.pmod(first + 1 + F.pmod(F.xxhash64("bucket", F.lit(1)), F.lit(BINS - 1)), F.lit(BINS))
    return F.array(*[F.struct(b.cast("int").alias("b"),
                              F.element_at("mins", b.cast("int") + 1).alias("v"))
                     for b in (first, second)])


def similarity(inside: DataFrame) -> DataFrame:
    """Average similarity of the members of each bucket.

    For one bin it is the sum of squared shares of its values.  Adding up a
    random sign per value and squaring estimates that sum in one aggregate
    (tug of war), so members are counted, not paired or multiplied.
    """
    tugs = [F.sum(F.lit(1) - 2 * F.shiftright("signs", k).bitwiseAND(F.lit(1)))
            for k in range(PROBES)]
    squares = sum((F.col(f"tug{k}").cast("double") ** 2 for k in range(PROBES)), F.lit(0.0))
    return (inside.groupBy("bucket")
            .agg(F.count(F.lit(1)).cast("double").alias("n"),
                 *[t.alias(f"tug{k}") for k, t in enumerate(tugs)])
            .select("bucket", (squares / (PROBES * F.col("n") ** 2)).alias("alike")))


def _signs() -> Column:
    """A random bit for the value of each probed bin, packed."""
    bits = [F.shiftleft(F.xxhash64(F.element_at("mins", b + 1), F.lit(b)).bitwiseAND(F.lit(1)), k)
            for k, b in enumerate(range(0, BINS, BINS // PROBES))]
    return sum(bits[1:], bits[0])


def _dealt(sketches: DataFrame, runs: range) -> tuple[DataFrame, DataFrame, DataFrame | None, int]:
    """Buckets to be compared, all (key, n, bucket) rows, classes whose buckets were
    split and the number of splits, for some of the runs over ``sketches``."""
    roots = np.random.default_rng(20240105).permutation(BINS)
    cur = sketches.select("key", "n", F.explode(F.array(*[
        _child(F.lit(run), F.lit(int(roots[run]))) for run in runs])).alias("bucket"))
    leaves, members, split, depth = None, None, None, 0
    for level in range(LEVELS):
        cur = materialise(cur)
        sizes = materialise(cur.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"),
            F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("sum"),
            F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("xor")).where("members > 1"))
        small = sizes.where(F.col("members") <= SMALL)
        large = sizes.where(F.col("members") > SMALL)
        done = small
        more = None
        if not large.isEmpty():
            if level + 1 == LEVELS:
                done = sizes
            else:
                inside = cur.join(large.select("bucket", "members"), "bucket").join(
                    sketches.select("key", "mins"), "key")
                if level == 0:
                    # From here on only classes in a large bucket matter.
                    sketches = materialise(inside.select("key", "n", "mins").dropDuplicates(["key"]))
                inside = materialise(inside.select("key", "n", "bucket", _signs().alias("signs"),
                                                   _children().alias("children")))
                alike = materialise(similarity(inside))
                dense = alike.where(F.col("alike") >= DENSE).select("bucket")
                sparse = alike.where(F.col("alike") < DENSE).select("bucket")
                done = small.unionByName(large.join(dense, "bucket", "left_semi"))
                if not sparse.isEmpty():
                    depth = level + 1
                    parted = inside.join(sparse, "bucket", "left_semi")
                    if level == 0:
                        split = materialise(sketches.join(parted.select("key"), "key", "left_semi"))
                    more = (parted.select("key", "n", "bucket", F.explode("children").alias("c"))
                            .select("key", "n", F.xxhash64("bucket", "c.b", "c.v").alias("bucket")))
        leaves = done if leaves is None else leaves.unionByName(done)
        rows = cur.select("key", "bucket")
        members = rows if members is None else members.unionByName(rows)
        if more is None:
            break
        cur = more
    return leaves, members, split, depth


def buckets(classes: DataFrame) -> DataFrame:
    """(key, bucket, members, shingles) for every bucket to be compared."""
    sketches = classes.where("n > 0").select("key", "n", "mins")
    runs = range(runs_needed(0))
    leaves, members, split, deepest = _dealt(sketches, runs)
    # A pair that lost a split has both its classes in ``split``.
    while runs.stop < runs_needed(deepest):
        runs = range(runs.stop, runs_needed(deepest))
        more, rows, _, depth = _dealt(split, runs)
        leaves, members = leaves.unionByName(more), members.unionByName(rows)
        deepest = max(deepest, depth)
    # Of buckets with the same members one is enough; a bucket number that two
    # levels share is one bucket with the members of both.
    kept = (leaves.groupBy("members", "sum", "xor")
            .agg(F.min("bucket").alias("bucket"), F.max("shingles").alias("shingles"))
            .groupBy("bucket").agg(F.sum("members").alias("members"),
                                   F.sum("shingles").alias("shingles")))
    return materialise(members.join(materialise(kept), "bucket").dropDuplicates(["bucket", "key"]))


def _shared(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], low: int, high: int,
            m: int) -> np.ndarray:
    """Shared tokens of sets ``low`` to ``high`` of ``a`` with all ``m`` sets of ``b``.

    Both sides are (token, owner) sorted by token, tokens numbered alike.  A
    token that many pairs share is a column of a matrix product; the pairs of
    the others are listed and counted.
    """
    inside = (a[1] >= low) & (a[1] < high)
    token, owner = a[0][inside], a[1][inside] - low
    many = int(max(token[-1] if len(token) else -1, b[0][-1] if len(b[0]) else -1)) + 1
    times = np.bincount(b[0], minlength=many)
    frequent = np.bincount(token, minlength=many) * times > (high - low) * m // 64
    out = np.zeros((high - low, m), dtype=np.float32)
    column = np.cumsum(frequent) - 1
    columns = int(frequent.sum())
    width = max(256, (1 << 23) // m)
    for at in range(0, columns, width):
        sides = []
        for t, o, n in ((token, owner, high - low), (b[0], b[1], m)):
            here = frequent[t] & (column[t] >= at) & (column[t] < at + width)
            side = np.zeros((n, min(width, columns - at)), dtype=np.float32)
            side[o[here], column[t[here]] - at] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    rare = ~frequent[token] & (times[token] > 0)
    token, owner = token[rare], owner[rare]
    first = np.searchsorted(b[0], token)
    pairs = np.cumsum(times[token])
    at = 0
    while at < len(token):
        end = max(at + 1, int(np.searchsorted(pairs, (pairs[at - 1] if at else 0) + (1 << 22), "right")))
        n = times[token[at:end]]
        behind = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        cell = np.repeat(owner[at:end] * m, n) + b[1][np.repeat(first[at:end], n) + behind]
        np.add.at(out.reshape(-1), cell, np.float32(1))
        at = end
    return out


STRIP = 512  # sets whose pairs with the others are counted at once


def compare(rows: list[dict], cross: bool) -> Iterator[tuple]:
    """Links inside one bucket, or between its blocks 0 and 1 if ``cross``.

    Yields (key, linked documents, first member of the linked group) for each
    member with a link.
    """
    rows = list({r["key"]: r for r in rows}.values())
    low = min((r["block"] for r in rows), default=0) if cross else 0
    rows.sort(key=lambda r: (cross and r["block"] != low, r["key"]))
    m = len(rows)
    cut = sum(r["block"] == low for r in rows) if cross else m
    if m < 2 or (cross and cut == m):
        return
    sets = [shingles(r["text"]) for r in rows]
    size = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(m), size)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[token] > 1
    token, owner = (np.cumsum(times > 1) - 1)[token[common]], owner[common]
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    # Columns of the link matrix: the other block, or all members.
    begin = cut if cross else 0
    right = owner >= begin
    other = token[right], owner[right] - begin
    mine = rows[0]["bucket"]
    names = {b: k for k, b in enumerate({b for r in rows for b in r["in_buckets"] if b < mine})}
    before = [(i, names[b]) for i, r in enumerate(rows) for b in r["in_buckets"] if b < mine]
    where = np.zeros((m, len(names)), dtype=np.float32)
    if before:
        where[tuple(zip(*before))] = 1
    copies = np.array([r["copies"] for r in rows], dtype=np.int64)
    linked = np.zeros((cut, m - begin), dtype=bool)
    links = np.zeros(m, dtype=np.int64)
    for at in range(0, cut, STRIP):
        end = min(at + STRIP, cut)
        shared = _shared((token, owner), other, at, end, m - begin)
        union = size[at:end, None] + size[None, begin:] - shared
        part = shared >= LEAST * union - 1e-9
        if not cross:
            part[np.arange(end - at), np.arange(at, end)] = False
        linked[at:end] = part
        if names:  # a pair in an earlier bucket is counted there
            part = part & (where[at:end] @ where[begin:].T == 0)
        links[at:end] += part @ copies[begin:]
        if cross:
            links[begin:] += copies[at:end] @ part
    first = _groups(linked, cross)
    keys = [r["key"] for r in rows]
    lowest: dict[int, bytes] = {}
    for i, g in enumerate(first.tolist()):
        lowest[g] = min(lowest.get(g, keys[i]), keys[i])
    some = linked.any(1) if not cross else np.concatenate([linked.any(1), linked.any(0)])
    for i in np.flatnonzero(some):
        yield keys[i], int(links[i]), lowest[int(first[i])]


def _groups(linked: np.ndarray, cross: bool) -> np.ndarray:
    """A number per member, equal for members that links connect: a search that
    takes each member's row of the matrix once."""
    cut, m = linked.shape[0], linked.shape[0] + linked.shape[1] if cross else linked.shape[0]
    group = np.full(m, -1)
    for start in range(m):
        if group[start] >= 0:
            continue
        group[start] = start
        new = np.array([start])
        while len(new):
            if cross:
                met = np.concatenate([linked[:, new[new >= cut] - cut].any(1), linked[new[new < cut]].any(0)])
            else:
                met = linked[new].any(0)
            new = np.flatnonzero(met & (group < 0))
            group[new] = start
    return group


def linked_classes(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, links, first): see ``compare``; one row per class and task."""
    spark = docs.sparkSession
    inside = buckets(classes)
    active = inside.groupBy("key").agg(
        F.collect_list("bucket").alias("in_buckets"),
        F.collect_list(F.struct("bucket", "members", "shingles")).alias("places"))
    active = materialise(active.join(classes.select("key", "doc_id", "text_hash", "copies"), "key"))
    # Most texts are in no bucket: a broadcast set of at most 2**21 numbers
    # spares them the shuffle (all of them, while the set is sparse).
    number = F.pmod("text_hash", F.lit(FILTER))
    met = active.select(number.alias("number")).distinct()
    texts = (_with_hash(docs).withColumn("number", number)
             .join(F.broadcast(met), "number", "left_semi").drop("number").alias("t"))
    if not classes.where("repeated").isEmpty():
        texts = texts.dropDuplicates(["doc_id", "text_hash"])
    same = (F.col("t.doc_id").eqNullSafe(F.col("a.doc_id"))
            & (F.col("t.text_hash") == F.col("a.text_hash")))
    found = (active.alias("a").join(texts, same)
             .select("key", "copies", "in_buckets", "text", F.explode("places").alias("p")))
    blocks = F.greatest(
        F.ceil(F.col("p.members") / BLOCK), F.ceil(F.col("p.shingles") / BLOCK_SHINGLES)).cast("int")
    block = F.pmod(F.xxhash64("key", F.lit(2)), F.col("blocks")).cast("int")
    dealt = (found.withColumn("blocks", blocks).withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.col("p.bucket").alias("bucket"),
                     F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                     "block", "key", "copies", "in_buckets", "text"))
    dealt = (dealt.repartition(shuffle_partitions(spark), "bucket", "x", "y")
             .sortWithinPartitions("bucket", "x", "y"))
    schema = "key binary, links bigint, first binary"
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def flush() -> Iterator[pa.RecordBatch]:
            got = list(compare(held, held[0]["x"] != held[0]["y"])) if len(held) > 1 else []
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in
                     zip(zip(*got), (pa.binary(), pa.int64(), pa.binary()))],
                    names=["key", "links", "first"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if held and any(held[0][c] != row[c] for c in ("bucket", "x", "y")):
                        yield from flush()
                        held.clear()
                    held.append(row)
        if held:
            yield from flush()

    return materialise(dealt.mapInArrow(run, schema))


def components(edges: DataFrame) -> DataFrame:
    """(key, root) for every node of ``edges`` (a, b): root is the group's smallest node.

    Each round takes the smallest label among a node's neighbours, then the
    label's own label, so labels travel in doubling steps.
    """
    both = materialise(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .distinct())
    label = materialise(both.groupBy("a").agg(F.min("b").alias("near"))
                        .select(F.col("a").alias("key"), F.least("a", "near").alias("root")))
    while True:
        near = (both.join(label.select(F.col("key").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("key")).agg(F.min("root").alias("near")))
        step = materialise(label.join(near, "key")
                           .select("key", F.col("root").alias("old"),
                                   F.least("root", "near").alias("to")))
        jump = step.select(F.col("key").alias("to"), F.col("to").alias("root"))
        new = materialise(step.join(jump, "to").select("key", "root", "old"))
        label = new.select("key", "root")
        if new.where("root <> old").isEmpty():
            return label


def near_copies(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its group),
    n_links (documents linked to it), n_copies (documents with its set),
    text_hash, class_key, key."""
    base = materialise(fingerprinted(docs))
    classes = materialise(base.groupBy("cls").agg(
        F.min(F.struct("key", "doc_id", "text_hash")).alias("top"),
        F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("mins").alias("mins"),
        (F.count(F.lit(1)) > F.count_distinct("key")).alias("repeated"))
        .select("cls", "top.*", "copies", "n", "mins", "repeated"))
    found = linked_classes(docs, classes)
    roots = components(found.where("key <> first")
                       .select(F.col("key").alias("a"), F.col("first").alias("b")))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    known = materialise(
        classes.select("cls", "key", "copies")
        .join(links, "key", "left").join(roots, "key", "left")
        .select("cls", "copies", F.coalesce("root", "key").alias("class_key"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    raw = F.conv(F.hex(F.substring("class_key", 2, 8)), 16, 10).cast("decimal(20,0)")
    class_id = F.when(F.hex(F.substring("class_key", 1, 1)) == "00",
                      (raw - F.lit("9223372036854775808").cast("decimal(20,0)")).cast("long"))
    return (base.select("doc_id", "text_hash", "key", "cls").join(known.hint("merge"), "cls")
            .select("doc_id", class_id.alias("class_id"), "n_links",
                    F.col("copies").alias("n_copies"), "text_hash", "class_key", "key"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their group, with all their columns."""
    kept = materialise(near_copies(docs).where(F.col("key") == F.col("class_key"))
                       .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")))
    once = kept.dropDuplicates()
    same = (F.col("doc_id").eqNullSafe(F.col("__id"))
            & (F.xxhash64(text_of()) == F.col("__hash")))
    out = docs.join(once, same, "left_semi")
    if once.count() < kept.count():  # repeated rows: one of each stays
        out = (out.groupBy(F.col("doc_id").alias("__id"), F.xxhash64(text_of()).alias("__hash"))
               .agg(F.first(F.struct(*[F.col(c) for c in docs.columns])).alias("__row"))
               .select("__row.*"))
    return out.select(*docs.columns)
