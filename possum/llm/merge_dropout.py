"""Seeded merge-dropout for a SentencePiece BPE vocabulary (operator 2).

Symbols start as characters.  An agenda holds every neighbouring pair that
is a piece, the best score first, then the leftmost; a candidate taken from it is
skipped at the dropout rate, else it is merged and its new neighbours join the
agenda.  Short parts are merged side by side: one step takes the next candidate of
each of many parts.  A part with characters outside the vocabulary has an
agenda of its own, a list with one place per pair, and a long one a heap; all
take the same candidates.  Skips are drawn as gaps, the
numbers of candidates merged before the next skip (geometric, which is the
same as a draw for each candidate).  They depend on the seed, the text's
checksum and the number of the part in it, so each occurrence of a word varies
by itself and a run can be repeated exactly.
What stays outside the vocabulary becomes byte pieces.  Without dropout the
ids are the vocabulary's own.

No piece crosses from another character into a space, into a line break, nor
from a letter into most punctuation marks (checked when the vocabulary is
loaded), so texts are cut there and the parts encoded one by one.  What a part
becomes without a skip is remembered per worker in a bounded table, with its
number of candidates: the first gap tells whether a skip falls.

A character that the vocabulary uses for the space is encoded as bytes, so
that decoding restores it.  Defined results: a null or empty text has no ids;
equal texts get equal ids; repeated rows too; an empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, text_of
from .tokens import spans, vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
RATE = 0.1
SEED = 7
CACHE_ENTRIES = 800_000
SHORT = 64           # symbols up to which the agenda is a list
SIDE_BY_SIDE = 8192  # parts that take their candidates together
SEGMENT = 1 << 20    # characters of texts that are encoded together
SPACE = "▁"
PUNCTUATION = ".,!?;:|*$%&#"
_MARK = SPACE + "\0" + SPACE
_STEP, _LEVEL = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_FULL = 2**64 - 1
NEVER = 2**62        # a gap beyond every part's candidates


def _mixed(x, full=_FULL):
    """Splitmix of 64-bit integers; arrays of them wrap by themselves."""
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & full
    x = (x ^ x >> 27) * 0x94D049BB133111EB & full
    return x ^ x >> 31


_PLACES = 128                      # places in a part, below the candidate's level
_NO_LEVEL = (1 << 24) - 1
_NONE = _NO_LEVEL * _PLACES        # agenda entries from here on are no candidates
_SLOTS = 20                        # bits of a pair's slot


class Pairs:
    """(left piece, right piece) -> level and piece of what they merge to, in an open hash table."""

    def __init__(self, ids: dict[str, int], order: dict[str, int], size: int):
        self.span = size + 1       # piece ``size`` pairs with none
        found = {}
        for p, i in ids.items():
            for cut in range(1, len(p)):
                left, right = ids.get(p[:cut]), ids.get(p[cut:])
                if left is not None and right is not None:
                    found[left * self.span + right] = order[p] << 32 | i
        bits = max(_SLOTS, (4 * len(found)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.zeros(1 << bits, dtype=np.int64)
        keys = np.fromiter(found.keys(), np.int64, len(found))
        values = np.fromiter(found.values(), np.int64, len(found))
        slot = self._slot(keys)
        while len(keys):
            first = np.unique(slot, return_index=True)[1]
            first = first[self.keys[slot[first]] < 0]
            self.keys[slot[first]], self.values[slot[first]] = keys[first], values[first]
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(_STEP) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(level, piece) of each pair; level ``_NO_LEVEL`` where it is no piece."""
        key = left.astype(np.int64) * self.span + right
        slot = self._slot(key)
        got = self.keys[slot]
        value = np.where(got == key, self.values[slot], _NO_LEVEL << 32)
        miss = np.flatnonzero((got != key) & (got >= 0))
        slot = slot[miss]
        while len(miss):
            slot = slot + 1 & self.mask
            got = self.keys[slot]
            hit = got == key[miss]
            value[miss[hit]] = self.values[slot[hit]]
            on = ~hit & (got >= 0)
            miss, slot = miss[on], slot[on]
        return (value >> 32).astype(np.int32), (value & 0xFFFFFFFF).astype(np.int32)


class Parts(dict[str, int]):
    """Numbers of parts with their ids and merged candidates; ``new`` lists those
    that were numbered by a look-up.  Number 0 has no ids."""

    def __init__(self) -> None:
        self[""] = 0
        self.new: list[str] = []
        self.start = np.zeros(1 << 10, dtype=np.int64)
        self.length = np.zeros(1 << 10, dtype=np.int64)
        self.merged = np.zeros(1 << 10, dtype=np.int64)
        self.odd = np.zeros(1 << 10, dtype=bool)    # holds characters outside the vocabulary
        self.pool = np.zeros(1 << 12, dtype=np.int32)
        self.used = 0

    def __missing__(self, part: str) -> int:
        number = self[part] = len(self)
        self.new.append(part)
        return number

    def store(self, at: np.ndarray, ids: np.ndarray, sizes: np.ndarray,
              merged: np.ndarray, odd: np.ndarray) -> None:
        """What the parts numbered ``at`` become; their ids one after the other."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self) > len(self.start):
            self.start, self.length, self.merged, self.odd = (
                np.concatenate([x, np.zeros_like(x)])
                for x in (self.start, self.length, self.merged, self.odd))
        self.pool[self.used:self.used + len(ids)] = ids
        self.start[at] = self.used + np.cumsum(sizes) - sizes
        self.length[at], self.merged[at], self.odd[at] = sizes, merged, odd
        self.used += len(ids)


class Dropout:
    def __init__(self, path: str, rate: float, seed: int,
                 cache_entries: int = CACHE_ENTRIES):
        import sentencepiece
        import xxhash

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.hash = xxhash.xxh64_intdigest
        self.rate, self.seed, self.limit = rate, seed, cache_entries
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.bytes: dict[int, int] = {}      # byte -> id
        self.byte_of: dict[int, int] = {}    # id -> byte
        self.ids: dict[str, int] = {}
        for i, p in enumerate(self.pieces):
            if model.is_byte(i):
                self.bytes[int(p[1:-1], 16)] = i
                self.byte_of[i] = int(p[1:-1], 16)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[p] = i
        self.rank = {p: -model.get_score(i) for p, i in self.ids.items()}
        levels = {r: k for k, r in enumerate(sorted(set(self.rank.values())))}
        self.order = {p: levels[r] for p, r in self.rank.items()}   # 0 merges first
        pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        marks = [c for c in PUNCTUATION
                 if not any(b == c and a.isalpha() for a, b in pairs)]
        if any((b == SPACE and a != SPACE) or "\n" in (a, b) for a, b in pairs):
            self.parts = re.compile(r".+", re.S)
        else:
            # A run of spaces with what follows; a line break stands alone, and
            # letters end before a mark that no piece has after a letter.
            word = rf" *+[^\W\d_]++(?=[{re.escape(''.join(marks))}])|" if marks else ""
            self.parts = re.compile(rf"\n|{word} *+[^ \n]++| +")
        # Chances, in 2**53, that a skip comes within 1, 2, ... candidates.
        most = (0 if rate <= 0 else 1 if rate >= 1
                else min(math.ceil(-37 / math.log1p(-rate)), 1 << 20))
        self.within = [round(2**53 * -math.expm1(k * math.log1p(-rate))) if rate < 1 else 2**53
                       for k in range(1, most + 1)]
        self.within_steps = np.array(self.within, dtype=np.uint64)
        self.pairs = Pairs(self.ids, self.order, size)
        self.single = np.full(0x110000, -1, dtype=np.int32)   # character -> piece
        for p, i in self.ids.items():
            if len(p) == 1:
                self.single[ord(p)] = i
        self.single[ord(" ")], self.single[ord(SPACE)] = self.single[ord(SPACE)], -1
        # Two generations: a full table becomes the older one, so frequent parts survive.
        self.cache, self.older = [Parts()], [Parts()]

    def split(self, text: str) -> list[str]:
        """The text with its leading space, in parts no piece crosses."""
        return self.parts.findall(" " + text) if text else []

    def _gap(self, draw: int, level: int) -> int:
        """Candidates merged before the next skip, after ``level`` skips."""
        if not self.within:
            return NEVER
        return bisect_right(self.within, _mixed((draw + level * _LEVEL) & _FULL) >> 11)

    def _gaps(self, draw: int) -> Iterator[int]:
        level = 0
        while True:
            yield self._gap(draw, level)
            level += 1

    def encode_part(self, part: str, draw: int) -> list[int]:
        """Ids of the occurrence of ``part`` that has this draw."""
        return self._encoded(part, self._gaps(draw))[1]

    def _encoded(self, part: str, gaps: Iterator[int]) -> tuple[int, list[int]]:
        """(candidates after the last skip, ids)."""
        # A literal space mark never merges: no piece holds its stand-in.
        sym = [SPACE if c == " " else _MARK if c == SPACE else c for c in part]
        merge = self._merge_short if len(sym) <= SHORT else self._merge_long
        merged, sym = merge(sym, gaps)
        ids, out = self.ids, []
        for s in sym:
            found = ids.get(s)
            if found is not None:
                out.append(found)
            else:
                raw = SPACE if s == _MARK else s
                out.extend(self.bytes[b] for b in raw.encode())
        return merged, out

    def _merge_short(self, sym: list[str], gaps: Iterator[int]) -> tuple[int, list[str]]:
        order, none = self.order.get, len(self.order)
        gap, merged = next(gaps, NEVER), 0
        agenda = [order(a + b, none) for a, b in zip(sym, sym[1:])]
        while agenda:
            best = min(agenda)
            if best == none:
                break
            k = agenda.index(best)
            if merged == gap:
                agenda[k] = none
                gap, merged = next(gaps, NEVER), 0
                continue
            merged += 1
            sym[k] = piece = sym[k] + sym[k + 1]
            del sym[k + 1], agenda[k]
            if k < len(agenda):
                agenda[k] = order(piece + sym[k + 1], none)
            if k:
                agenda[k - 1] = order(sym[k - 1] + piece, none)
        return merged, sym

    def _merge_long(self, sym: list[str], gaps: Iterator[int]) -> tuple[int, list[str]]:
        rank, push = self.rank, heapq.heappush
        gap, merged = next(gaps, NEVER), 0
        end = len(sym)
        left, right = list(range(-1, end - 1)), list(range(1, end + 1))
        agenda: list[tuple[float, int, str]] = []
        for i in range(end - 1):
            piece = sym[i] + sym[i + 1]
            if piece in rank:
                push(agenda, (rank[piece], i, piece))
        while agenda:
            _, i, piece = heapq.heappop(agenda)
            j = right[i]
            if j >= end or not sym[i] or sym[i] + sym[j] != piece:
                continue
            if merged == gap:
                gap, merged = next(gaps, NEVER), 0
                continue
            merged += 1
            sym[i], sym[j] = piece, ""
            nxt = right[i] = right[j]
            if nxt < end:
                left[nxt] = i
                both = piece + sym[nxt]
                if both in rank:
                    push(agenda, (rank[both], i, both))
            before = left[i]
            if before >= 0:
                both = sym[before] + piece
                if both in rank:
                    push(agenda, (rank[both], before, both))
        return merged, [s for s in sym if s]

    def _next_gaps(self, draws: np.ndarray, level: np.ndarray | int) -> np.ndarray:
        """``_gap`` of many draws."""
        if not self.within:
            return np.full(len(draws), NEVER)
        at = draws + np.asarray(level, dtype=np.uint64) * np.uint64(_LEVEL)
        return np.searchsorted(self.within_steps, _mixed(at, np.uint64(_FULL)) >> np.uint64(11), "right")

    def _merge_all(self, pieces: np.ndarray, start: np.ndarray, length: np.ndarray,
                   gaps: np.ndarray | None = None, draws: np.ndarray | None = None) -> None:
        """Merge parts of single pieces in place: a piece takes its first place, the others get -1.
        Without ``gaps`` nothing is skipped."""
        order = np.argsort(length, kind="stable")
        for at in range(0, len(order), SIDE_BY_SIDE):
            block = order[at:at + SIDE_BY_SIDE]
            self._merge_block(pieces, start[block], length[block],
                              None if gaps is None else gaps[block],
                              None if gaps is None else draws[block])

    def _merge_block(self, pieces: np.ndarray, start: np.ndarray, length: np.ndarray,
                     gaps: np.ndarray | None, draws: np.ndarray | None) -> None:
        """One column per part, one row per place, with a row of no piece before and after."""
        wide, n = int(length.max()), len(start)
        none = self.pairs.span - 1
        rows = np.arange(wide)[:, None]
        sym = np.full((wide + 2, n), none, dtype=np.int32)
        own = rows < length
        sym[1:-1][own] = pieces[(start + rows)[own]]
        agenda = np.full((wide + 2, n), _NONE, dtype=np.int32)
        into = np.zeros((wide + 2, n), dtype=np.int32)
        level, piece = self.pairs(sym[1:-2].ravel(), sym[2:-1].ravel())
        agenda[1:-2] = level.reshape(-1, n) * _PLACES + np.arange(1, wide, dtype=np.int32)[:, None]
        into[1:-2] = piece.reshape(-1, n)
        after = np.repeat(np.arange(1, wide + 3, dtype=np.int32)[:, None], n, axis=1)
        before = after - 2
        if gaps is not None:
            gaps, skips, merged = gaps.copy(), np.zeros(n, np.int64), np.zeros(n, np.int64)

        def give_back(columns: np.ndarray) -> None:
            own = rows < length[columns]
            pieces[(start[columns] + rows)[own]] = sym[1:-1, columns][own]

        while n:
            best = agenda.min(axis=0)
            live = best < _NONE
            c = np.flatnonzero(live)
            if 4 * len(c) < 3 * n:     # ended parts leave
                give_back(np.flatnonzero(~live))
                start, length, best, n = start[c], length[c], best[c], len(c)
                sym, agenda, into, after, before = (
                    x[:, c] for x in (sym, agenda, into, after, before))
                if gaps is not None:
                    gaps, draws, skips, merged = gaps[c], draws[c], skips[c], merged[c]
                c = np.arange(n)
            if not len(c):
                break
            k = (best[c] & (_PLACES - 1)).astype(np.int64)
            if gaps is not None:
                skip = merged[c] == gaps[c]
                if skip.any():
                    s = c[skip]
                    agenda[k[skip], s] = _NONE
                    skips[s] += 1
                    gaps[s], merged[s] = self._next_gaps(draws[s], skips[s]), 0
                    c, k = c[~skip], k[~skip]
                merged[c] += 1
            j = after[k, c]
            end, ahead = after[j, c], before[k, c]
            new = into[k, c]
            sym[k, c], sym[j, c] = new, -1
            agenda[j, c] = _NONE
            after[k, c], before[end, c] = end, k
            level, piece = self.pairs(new, sym[end, c])
            agenda[k, c], into[k, c] = level * _PLACES + k, piece
            level, piece = self.pairs(sym[ahead, c], new)
            agenda[ahead, c], into[ahead, c] = level * _PLACES + ahead, piece
        if n:
            give_back(np.arange(n))

    def _pieces(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pieces of the single characters, each part's start, its length)."""
        length = np.fromiter(map(len, parts), np.int64, len(parts))
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        return self.single[codes], np.cumsum(length) - length, length

    def _learn(self, table: Parts) -> None:
        """What the newest parts of the table become without a skip."""
        new, table.new = table.new, []
        older = self.older[0]
        at = np.arange(len(table) - len(new), len(table))
        old = np.fromiter((older.get(p, 0) for p in new), np.int64, len(new))
        seen = np.flatnonzero(old)
        k = old[seen]
        table.store(at[seen], older.pool[spans(older.start[k], older.length[k])],
                    older.length[k], older.merged[k], older.odd[k])
        fresh = np.flatnonzero(old == 0)
        if not len(fresh):
            return
        pieces, start, length = self._pieces([new[i] for i in fresh.tolist()])
        odd = np.minimum.reduceat(pieces, start) < 0
        whole = np.flatnonzero(~odd)
        if len(whole):
            pieces = pieces[spans(start[whole], length[whole])]
            length = length[whole]
            begin = np.cumsum(length) - length
            self._merge_all(pieces, begin, length)
            sizes = np.add.reduceat(pieces >= 0, begin, dtype=np.int64)
            table.store(at[fresh[whole]], pieces[pieces >= 0], sizes, length - sizes,
                        np.zeros(len(whole), dtype=bool))
        for i in fresh[odd].tolist():
            merged, ids = self._encoded(new[i], iter(()))
            table.store(at[i:i + 1], np.array(ids, dtype=np.int32), np.array([len(ids)]),
                        np.array([merged]), np.ones(1, dtype=bool))

    def _encode_parts(self, parts: list[str], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all occurrences, number of ids of each)."""
        table, long = self.cache[0], []
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        if size.max() >= SHORT:
            long = np.flatnonzero(size >= SHORT).tolist()
            short = list(parts)
            for i in long:
                short[i] = ""
        number = np.fromiter(map(table.__getitem__, short if long else parts), np.int64, len(parts))
        if table.new:
            self._learn(table)
        gaps = self._next_gaps(draws, 0)
        skipped = gaps < table.merged[number]
        size = table.length[number]
        odd = {i: self.encode_part(parts[i], int(draws[i]))
               for i in [*long, *np.flatnonzero(skipped & table.odd[number]).tolist()]}
        for i, ids in odd.items():
            size[i] = len(ids)
        some = np.flatnonzero(skipped & ~table.odd[number])
        if len(some):
            pieces, start, length = self._pieces([parts[i] for i in some.tolist()])
            self._merge_all(pieces, start, length, gaps[some], draws[some])
            size[some] = np.add.reduceat(pieces >= 0, start, dtype=np.int64)
        begin = np.cumsum(size) - size
        out = np.empty(int(size.sum()), dtype=np.int32)
        known = np.ones(len(parts), dtype=bool)
        known[some] = False
        known[list(odd)] = False
        known = np.flatnonzero(known)
        out[spans(begin[known], size[known])] = table.pool[spans(table.start[number[known]], size[known])]
        if len(some):
            out[spans(begin[some], size[some])] = pieces[pieces >= 0]
        for i, ids in odd.items():
            out[begin[i]:begin[i] + len(ids)] = ids
        return out, size

    def draws(self, text: str, parts: int) -> np.ndarray:
        """A 64-bit draw for each part of a text."""
        first = self.hash(text.encode(), self.seed & _FULL)
        at = np.arange(parts, dtype=np.uint64) * np.uint64(_STEP) + np.uint64(first)
        return _mixed(at, np.uint64(_FULL))

    def _encode_some(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.split(t) for t in texts]
        draws = np.concatenate([self.draws(t, len(p)) for t, p in zip(texts, split)])
        parts = [p for some in split for p in some]
        # A share of the table at a time, so that a full one can make room before.
        most = max(16, self.limit // 4)
        got = []
        for at in range(0, len(parts), most):
            if len(self.cache[0]) + most > self.limit // 2:
                self.older[0], self.cache[0] = self.cache[0], Parts()
            got.append(self._encode_parts(parts[at:at + most], draws[at:at + most]))
        if not got:
            return [np.zeros(0, dtype=np.int32)] * len(texts)
        ends = np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in got]))])
        ids = np.concatenate([i for i, _ in got])
        return np.split(ids, ends[np.cumsum([len(p) for p in split])[:-1]])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out, at = [], 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and held < SEGMENT:
                held += len(texts[end])
                end += 1
            out += self._encode_some(texts[at:end])
            at = end
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text that ``encode`` got."""
        out = bytearray()
        for i in ids.tolist():
            b = self.byte_of.get(i)
            if b is None:
                out += self.pieces[i].replace(SPACE, " ").encode()
            else:
                out.append(b)
        return out.decode()[1:] if out else ""


@lru_cache(maxsize=4)
def dropout(path: str, rate: float, seed: int) -> Dropout:
    """One per Python worker and setting, kept between its tasks."""
    return Dropout(path, rate, seed)


def encode(docs: DataFrame, path: str | None = None, rate: float = RATE,
           seed: int = SEED) -> DataFrame:
    """doc_id, ids of every whole text."""
    path = path or vocabulary_path(VOCABULARY)

    def rows(batch: list[dict]) -> Iterator[tuple]:
        coder = dropout(path, rate, seed)
        for d, ids in zip(batch, coder.encode_batch([d["text"] for d in batch])):
            yield d["doc_id"], ids

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                text_of().alias("text")), "doc_id bigint, ids array<int>", rows)


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of every row of ids."""
    path = path or vocabulary_path(VOCABULARY)

    def rows(batch: list[dict]) -> Iterator[tuple]:
        coder = dropout(path, 0.0, 0)
        for d in batch:
            yield d["doc_id"], coder.decode(np.array(d["ids"] or [], dtype="<i4"))

    return map_rows(coded.select("doc_id", "ids"), "doc_id bigint, text string", rows)
