"""Secret scans with a randomness test battery (operator 6).

Three fixed patterns find base spans.  The battery adds spans: every run of
16 or more key characters, and every piece of 16 or more between the '/', '_'
and '-' in it, gets an encoding (the smallest alphabet that holds it, from
digits to all key characters) and three tests of its symbols
against that alphabet: chi-squared uniformity, runs about the middle of the
alphabet, and correlation of neighbours.  Fisher's method combines the three
into one probability.

False discoveries are controlled per class, an encoding and a range of
lengths.  The null is ordinary text: of each whole text, outside its base
spans, the characters of an encoding are joined and cut into consecutive
strings of each length, which are scored like candidates.  A candidate's
p-value is the share of its class's strings that look at least as random; in
each class the candidates pass by the Benjamini-Hochberg rule at ``rate``, if
the battery also does not reject randomness itself.  Both distributions are
counted over all texts, as bins: at most classes x bins numbers reach the
driver.

Defined results: a null or empty text has no spans; spans count code points,
end exclusive; a candidate inside a base span or an added run is not added; equal texts get
equal spans; an empty table gives no rows.  Extra columns are ignored by the
scan and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import materialise
from .common import map_rows, ship, slices, text_of

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

LEAST_RUN = 16                      # of key characters
PIECE = re.compile(r"[A-Za-z0-9+]{16,}")
CLASSES = (16, 24, 32, 48, 64)      # least length of each length class
BINS = 200                          # bins of the log probability
RATE = 0.01                         # false discoveries among added spans
PART = 1 << 17                      # symbols of ordinary text scored at once
LEAST_BIN = BINS - 1 - 30           # battery probabilities below 0.001 are not random
MOST_HALF = 11.5                    # -log of a product of p-values that Fisher puts below 0.001

_UPPER, _LOWER, _DIGIT = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789")
# Smaller ones first.
ALPHABETS = {"digits": _DIGIT, "hex": _DIGIT + "abcdef", "HEX": _DIGIT + "ABCDEF",
             "lower": _LOWER, "upper": _UPPER, "base32": _UPPER + "234567",
             "letters": _UPPER + _LOWER, "alnum": _UPPER + _LOWER + _DIGIT,
             "base64": _UPPER + _LOWER + _DIGIT + "+/", "base64url": _UPPER + _LOWER + _DIGIT + "-_",
             "any": _UPPER + _LOWER + _DIGIT + "+/-_"}
_SETS = {name: frozenset(chars) for name, chars in ALPHABETS.items()}
_NUMBER = {name: k for k, name in enumerate(ALPHABETS)}
_VALUES = {name: {c: i for i, c in enumerate(chars)} for name, chars in ALPHABETS.items()}


# Bytes to the values of an encoding, and the bytes outside it.
_TABLES = {name: bytes(found.get(chr(c), 0) for c in range(256)) for name, found in _VALUES.items()}
_OUTSIDE = {name: bytes(c for c in range(256) if chr(c) not in found) for name, found in _VALUES.items()}


def encoding_of(run: str) -> str:
    """The smallest alphabet that holds the run."""
    chars = set(run)
    return next(name for name in ALPHABETS if chars <= _SETS[name])


def _upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _upper_chi2(x: float, df: int) -> float:
    """Upper tail of chi-squared, by the cube-root normal approximation."""
    a = 2 / (9 * df)
    return _upper_normal(((x / df) ** (1 / 3) - (1 - a)) / math.sqrt(a))


def battery(run: str, encoding: str) -> float:
    """Probability of so uneven or so ordered a run if its symbols were random."""
    values, size, n = _VALUES[encoding], len(ALPHABETS[encoding]), len(run)
    v = [values[c] for c in run]
    groups = max(2, min(size, n // 5))
    seen = Counter(x * groups // size for x in v)
    share = Counter(x * groups // size for x in range(size))
    chi2 = sum((seen[g] - n * k / size) ** 2 / (n * k / size) for g, k in share.items())
    p_even = _upper_chi2(chi2, groups - 1)
    high = [2 * x >= size for x in v]
    n1 = sum(high)
    n0 = n - n1
    if n1 and n0:
        runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
        mean = 2 * n1 * n0 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * _upper_normal(abs(runs - mean) / math.sqrt(max(var, 1e-9)))
    else:
        p_runs = 2.0 ** (1 - n)
    middle = sum(v) / n
    spread = sum((x - middle) ** 2 for x in v)
    if spread:
        r = sum((a - middle) * (b - middle) for a, b in zip(v, v[1:])) / spread
        p_serial = 2 * _upper_normal(abs(r + 1 / n) * math.sqrt(n))
    else:
        p_serial = 0.0
    logs = sum(math.log(max(p, 1e-30)) for p in (p_even, min(p_runs, 1.0), min(p_serial, 1.0)))
    half = -logs  # Fisher: -2 sum(log p) is chi-squared with 6 degrees of freedom
    return math.exp(-half) * (1 + half + half * half / 2)


def _upper_normals(z: np.ndarray) -> np.ndarray:
    """``_upper_normal`` of an array, by a Chebyshev fit (relative error 1.2e-7)."""
    x = np.abs(z) / math.sqrt(2)
    t = 1 / (1 + x / 2)
    fit = np.zeros_like(t)
    for c in (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806,
              0.09678418, 0.37409196, 1.00002368, -1.26551223):
        fit = fit * t + c
    half = t * np.exp(-x * x + fit) / 2
    return np.where(z >= 0, half, 1 - half)


def _groups(size: int, n: int) -> int:
    """Groups of symbols that chi-squared compares in strings of ``n``."""
    return max(2, min(size, n // 5))


# Running sums of group sizes share words: (length, first group, groups, bits a
# group) from the lowest bits up.  A field holds its length's largest size, and
# the shorter lengths lie above, so a longer string overflows only into fields
# that it does not read.  The last group's size is the rest.
_WORDS = (((32, 0, 5, 6), (24, 0, 3, 5), (16, 0, 2, 5)), ((64, 9, 2, 7), (48, 0, 8, 6)), ((64, 0, 9, 7),))


@lru_cache(maxsize=None)
def _layout(size: int) -> tuple[np.ndarray, dict[int, list[tuple[int, int, int, int]]]]:
    """Per word what each symbol adds, and per length its groups as (group, word, shift, mask)."""
    adds = np.zeros((len(_WORDS), 256), dtype=np.uint64)
    fields: dict[int, list[tuple[int, int, int, int]]] = {n: [] for n in CLASSES}
    for w, parts in enumerate(_WORDS):
        shift = 0
        for n, first, many, bits in parts:
            groups = _groups(size, n)
            of = np.arange(256) * groups // size
            for g in range(first, min(first + many, groups - 1)):
                adds[w, of == g] += np.uint64(1 << shift)
                fields[n].append((g, w, shift, (1 << bits) - 1))
                shift += bits
    return adds, fields


@lru_cache(maxsize=None)
def _tables(size: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For strings of ``n`` symbols of an alphabet: a weight per group, and logarithms of
    two probabilities.

    Squared group sizes by weights add up to a whole number that gives
    chi-squared, so its probability is looked up; that of the runs is looked
    up by the symbols above the middle and the number of runs.
    """
    groups = _groups(size, n)
    share = np.bincount(np.arange(size) * groups // size, minlength=groups)
    weight = math.lcm(*share.tolist()) // share
    chi2 = np.arange(n * n * int(weight.max()) + 1) * (size / (n * float(weight[0] * share[0]))) - n
    a = 2 / (9 * (groups - 1))
    even = _upper_normals(((np.maximum(chi2, 0) / (groups - 1)) ** (1 / 3) - (1 - a)) / math.sqrt(a))
    n1, runs = np.arange(n + 1.0)[:, None], np.arange(n + 1.0)[None, :]
    mean = 2 * n1 * (n - n1) / n + 1
    var = np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    p_runs = np.where((n1 > 0) & (n1 < n), 2 * _upper_normals(np.abs(runs - mean) / np.sqrt(var)),
                      2.0 ** (1 - n))
    return weight.astype(np.int64), _logs(even), _logs(p_runs).reshape(-1)


def _logs(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-30, 1.0))


def _sums(x: np.ndarray) -> np.ndarray:
    """Running sums, from 0; differences are right modulo 2**64."""
    out = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(x, out=out[1:])
    return out


@lru_cache(maxsize=None)
def _packed(size: int) -> np.ndarray:
    """Per symbol its value, its square and whether it is high, in 16, 32 and 16 bits."""
    v = np.arange(256, dtype=np.uint64)
    high = (v >= (size + 1) // 2).astype(np.uint64)
    return v | v * v << np.uint64(16) | high << np.uint64(48)


class Running:
    """Running sums of strings' symbols, read at the ends of strings of any length.

    Sums are packed side by side into 64 bits; a string's own sums fit their fields.
    """

    def __init__(self, v: np.ndarray, size: int):
        self.v, self.size = v, size
        at = v.astype(np.int64)
        alone, w = _packed(size).take(at), at.view(np.uint64)
        self.alone = _sums(alone)
        self.groups = [_sums(add.take(at)) for add in _layout(size)[0]]
        # Products of neighbours, and in bit 32 whether just one of them is high.
        beside = (alone[1:] ^ alone[:-1]) >> np.uint64(48) << np.uint64(32)
        beside |= w[1:] * w[:-1]
        self.beside = _sums(beside)

    def bins(self, starts: np.ndarray, n: int) -> np.ndarray:
        """``bin_of(battery(...))`` of the strings of ``n`` symbols at ``starts``."""
        weight, log_even, log_runs = _tables(self.size, n)
        ends = starts + n
        alone = self.alone.take(ends) - self.alone.take(starts)
        beside = self.beside.take(ends - 1) - self.beside.take(starts)
        logs = log_runs.take(((alone >> np.uint64(48)) * np.uint64(n + 1) + np.uint64(1)
                              + (beside >> np.uint64(32))).view(np.int64))
        # Not random by the first tests alone: the third cannot change that.
        open_ = np.flatnonzero(logs >= -MOST_HALF)
        starts, ends, logs = starts[open_], ends[open_], logs[open_]
        words: dict[int, np.ndarray] = {}
        rest = np.full(len(starts), n, dtype=np.int64)
        q = np.zeros(len(starts), dtype=np.int64)
        for g, w, shift, mask in _layout(self.size)[1][n]:
            if w not in words:
                words[w] = self.groups[w].take(ends) - self.groups[w].take(starts)
            c = (words[w] >> np.uint64(shift) & np.uint64(mask)).view(np.int64)
            rest -= c
            q += weight[g] * c * c
        logs += log_even.take(q + weight[-1] * rest * rest)
        still = np.flatnonzero(logs >= -MOST_HALF)
        out = np.zeros(len(alone), dtype=np.int64)
        open_ = open_[still]
        out[open_] = self._serial(alone[open_], beside[open_], starts[still], n, logs[still])
        return out

    def _serial(self, alone: np.ndarray, beside: np.ndarray, starts: np.ndarray, n: int,
                logs: np.ndarray) -> np.ndarray:
        """Bins, from the packed sums and the logarithms of the other tests."""
        low, field = np.uint64(0xFFFF), np.uint64(0xFFFFFFFF)
        total = (alone & low).view(np.int64)
        squares = (alone >> np.uint64(16) & field).view(np.int64)
        products = (beside & field).view(np.int64)
        middle = total / n
        spread = squares - total * middle
        # The sum of (a - middle) * (b - middle) over neighbours.
        edge = self.v[starts].astype(np.int64) + self.v[starts + n - 1]
        both = products - middle * (2 * total - edge) + (n - 1) * middle * middle
        r = both / np.maximum(spread, 1e-9)
        p_serial = np.where(squares * n > total * total,
                            2 * _upper_normals(np.abs(r + 1 / n) * math.sqrt(n)), 0.0)
        half = -logs - _logs(p_serial)
        log_p = np.log1p(half + half * half / 2) - half
        bins = BINS - 1 + np.floor(log_p * (10 / math.log(10))).astype(np.int64)
        return np.where(bins < LEAST_BIN, 0, bins)


def class_of(n: int, encoding: str) -> int:
    """Number of the class of an encoding and a length."""
    return _NUMBER[encoding] * len(CLASSES) + sum(n >= least for least in CLASSES) - 1


def bin_of(p: float) -> int:
    """0: not random; else up to BINS - 1, ten bins to a power of ten."""
    found = BINS - 1 + math.floor(10 * math.log10(max(p, 1e-30)))
    return found if found >= LEAST_BIN else 0


_KEYS = bytes(120 if chr(c) in ALPHABETS["any"] else 32 for c in range(256))
_WORDS_OF_ASSIGN = (b"password", b"passwd", b"secret", b"token", b"api")


def key_runs(raw: bytes) -> list[tuple[int, int]]:
    """(start, end) of the maximal runs of key characters that are long enough."""
    marks = raw.translate(_KEYS)
    out, least = [], b"x" * LEAST_RUN
    at = marks.find(least)
    while at >= 0:
        end = marks.find(b" ", at)
        end = len(marks) if end < 0 else end
        out.append((at, end))
        at = marks.find(least, end)
    return out


def base_spans(text: str, raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; hex runs lie inside ``runs``."""
    found = []
    low = raw.lower()
    if any(word in low for word in _WORDS_OF_ASSIGN):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
              if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for start, end in runs if end - start >= LEAST_HEX
              for m in HEX.finditer(text, start, end) if len(m[0]) >= LEAST_HEX]
    return sorted(found)


def candidates(text: str, runs: list[tuple[int, int]],
               base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, class, bin) of the runs, and pieces of runs, that the battery tests."""
    for run in runs:
        spans = [run, *(p.span() for p in PIECE.finditer(text, *run))]
        for start, end in dict.fromkeys(spans):
            if not any(a <= start and end <= b for a, _, b in base):
                found = text[start:end]
                encoding = encoding_of(found)
                yield start, end, class_of(end - start, encoding), bin_of(battery(found, encoding))


def outside(text: str, base: list[tuple[int, int, int]]) -> np.ndarray:
    """The text without its base spans, a byte a character."""
    data = np.frombuffer(text.encode("ascii", "replace"), dtype=np.uint8)
    if base:
        data = data.copy()
        for start, _, stop in base:
            data[start:stop] = 0
    return data


def ordinary(texts: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """(class, bin, strings) of the consecutive strings of each encoding and length
    that the whole texts hold; no string crosses from a text into another."""
    raw = [t.tobytes() for t in texts]
    for name, values in _TABLES.items():
        counted = np.zeros((len(CLASSES), BINS + 1), dtype=np.int64)
        plain = (np.frombuffer(t.translate(values, _OUTSIDE[name]), dtype=np.uint8) for t in raw)
        for parts in _parts(plain):
            sums = Running(np.concatenate(parts), len(ALPHABETS[name]))
            size = np.array([len(v) for v in parts])
            first = np.cumsum(size) - size
            for k, n in enumerate(CLASSES):
                many = size // n
                place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                if len(place):
                    counted[k] += np.bincount(sums.bins(np.repeat(first, many) + place * n, n),
                                              minlength=BINS + 1)
        for k, b in zip(*np.nonzero(counted)):
            yield class_of(CLASSES[k], name), int(b), int(counted[k, b])


def _parts(plain: Iterable[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The texts some at a time; a long one is cut where strings of every length end."""
    whole = PART // math.lcm(*CLASSES) * math.lcm(*CLASSES)
    held, size = [], 0
    for v in plain:
        for at in range(0, len(v), whole):
            held.append(v[at:at + whole])
            size += len(held[-1])
            if size >= PART:
                yield held
                held, size = [], 0
    if held:
        yield held


def scan(text: str):
    """(base spans, candidates) of a whole text."""
    raw = text.encode("ascii", "replace")  # a byte a code point
    runs = key_runs(raw)
    base = base_spans(text, raw, runs)
    return base, list(candidates(text, runs, base))


def thresholds(counted: list[tuple[int, bool, int, int]], rate: float = RATE) -> list[int]:
    """Least bin that passes, per class; BINS where none does.

    ``counted``: (class, ordinary text?, bin, strings).
    """
    out = []
    nulls, gots = [[[0] * (BINS + 1) for _ in range(len(ALPHABETS) * len(CLASSES))]
                   for _ in range(2)]
    for cls, plain, b, n in counted:
        (nulls if plain else gots)[cls][b] += n
    for null, got in zip(nulls, gots):
        all_null, all_got, best = sum(null), sum(got), BINS
        above_null = above_got = 0
        for b in range(BINS - 1, LEAST_BIN - 1, -1):
            above_null, above_got = above_null + null[b], above_got + got[b]
            if above_got and (1 + above_null) / (1 + all_null) <= rate * above_got / all_got:
                best = b
        out.append(best)
    return out


def count_bins(scored: DataFrame) -> list[tuple[int, bool, int, int]]:
    """Bins of candidates and of ordinary text over all rows (classes x bins rows at most)."""
    one = scored.select(F.explode(F.concat(
        F.transform("found", lambda c: F.struct(c["cls"].alias("cls"), F.lit(False).alias("plain"),
                                                c["bin"].alias("bin"), F.lit(1).cast("long").alias("n"))),
        F.transform("plain", lambda c: F.struct(c["cls"].alias("cls"), F.lit(True).alias("plain"),
                                                c["bin"].alias("bin"), c["n"].alias("n"))))).alias("s"))
    rows = one.groupBy("s.cls", "s.plain", "s.bin").agg(F.sum("s.n").alias("n")).collect()
    return [(r["cls"], r["plain"], r["bin"], r["n"]) for r in rows]


SCORED = ("doc_id bigint, base array<struct<start:int,kind:int,stop:int>>, "
          "found array<struct<start:int,stop:int,cls:int,bin:int>>, "
          "plain array<struct<cls:int,bin:int,n:bigint>>")


def scored_texts(docs: DataFrame) -> DataFrame:
    """Spans and candidates of each row; its chunk's first row has the chunk's null counts."""
    def rows(batch: list[dict]) -> Iterator[tuple]:
        scans = [scan(d["text"]) for d in batch]
        counts = [dict(zip(("cls", "bin", "n"), c)) for c in ordinary(
            [outside(d["text"], base) for d, (base, _) in zip(batch, scans)])]
        for k, (d, (base, found)) in enumerate(zip(batch, scans)):
            yield (d["doc_id"], [dict(zip(("start", "kind", "stop"), s)) for s in base],
                   [dict(zip(("start", "stop", "cls", "bin"), c)) for c in found],
                   [] if k else counts)

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                text_of().alias("text")), SCORED, rows)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{stop}" for start, kind, stop in sorted(spans))


def find_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """One row per document: counts and digest of base spans, and all spans."""
    scored = materialise(scored_texts(docs))  # spans only, no texts
    least = thresholds(count_bins(scored), rate)

    def rows(batch: list[dict]) -> Iterator[tuple]:
        for d in batch:
            base = [(s["start"], s["kind"], s["stop"]) for s in d["base"]]
            more, at = [], 0
            for c in d["found"]:  # a run comes before its pieces
                if c["bin"] >= least[c["cls"]] and c["start"] >= at:
                    more.append((c["start"], 3, c["stop"]))
                    at = c["stop"]
            kinds = Counter(kind for _, kind, _ in base)
            yield (d["doc_id"], kinds[0], kinds[1], kinds[2],
                   hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + more),
                   len(more))

    return map_rows(scored.select("doc_id", "base", "found"),
                    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
                    "base_sha256 string, spans string, n_random bigint", rows)


MASK = "[secret]"


def masked(text: str, least: list[int]) -> str:
    """The text with every span, overlapping ones merged, replaced by ``MASK``."""
    base, found = scan(text)
    spans = sorted([(a, b) for a, _, b in base]
                   + [(a, b) for a, b, cls, bin_ in found if bin_ >= least[cls]])
    out, at = [], 0
    for start, stop in spans:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rate: float = RATE, text_col: str = "text",
           n_col: str = "n_chars") -> DataFrame:
    """``docs`` with masked secrets; texts without any, and all else, unchanged.

    Two passes over the texts (count, then mask), no shuffle of texts.  The
    character count column, if there is one, follows the new text.
    """
    least = thresholds(count_bins(scored_texts(docs)), rate)
    ship(docs.sparkSession)
    names = docs.columns
    counts_chars = n_col in names and isinstance(docs.schema[n_col].dataType, T.IntegralType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            cols = list(batch.columns)
            at = names.index(text_col)
            old = cols[at].to_pylist()
            new = [t if t is None else masked(t, least) for t in old]
            cols[at] = pa.array(new, type=cols[at].type)
            if counts_chars:
                k = names.index(n_col)
                counts = [n if a == b else len(b)
                          for n, a, b in zip(cols[k].to_pylist(), old, new)]
                cols[k] = pa.array(counts, type=cols[k].type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
