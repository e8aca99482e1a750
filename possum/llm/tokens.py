"""Token ids of texts by the public word-level BPE vocabulary.

The vocabulary lower-cases, drops white space and never merges across it, so
a text's ids are those of its white-space chunks in order.  ``WordIds`` looks
the chunks themselves (no hashes of them) up in a bounded table per worker and
asks the tokenizer only for new ones.  Lower-casing and a mark after a word's
last letter are taken off whole segments before the look-up; a chunk of plain
letters with more punctuation is asked for as its letters and its punctuation,
which the tokenizer separates as well.  A text holding a character on which this split and the
tokenizer could disagree about white space goes to the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

VOCABULARY = "word_bpe_49k.json"
# Entries per table; a full table forgets what was met once (a cache: results never change).
CACHE_ENTRIES = 300_000
# Bytes that are looked up at once; longer texts are cut at white space.
SEGMENT = 1 << 20
# Unicode white space and separators beyond ASCII's plain white space.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
TRAIL = ".,!?;:|*$%&#()[]\"-"
# Stands between texts that are looked up together; never part of UTF-8.
BETWEEN = b"\xff"
_JOIN = b" \xff "
# 1: ASCII letter, 2: mark of TRAIL, 3: white space.
_KIND = bytes(1 if chr(b).isalpha() and b < 128 else 2 if b < 128 and chr(b) in TRAIL
              else 3 if b in b" \t\n\r\x0b\x0c" else 0 for b in range(256))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _cut(data: bytes) -> Iterator[bytes]:
    """``data`` in segments of about ``SEGMENT`` bytes, cut at white space only."""
    at = 0
    while len(data) - at > SEGMENT:
        end = max(data.rfind(c, at + 1, at + SEGMENT) for c in (b" ", b"\n"))
        if end < 0:
            later = [i for c in (b" ", b"\n") if (i := data.find(c, at + SEGMENT)) >= 0]
            end = min(later, default=len(data))
        yield data[at:end]
        at = end
    yield data[at:]


def _mark_apart(data: bytes) -> bytes:
    """``data``, which ends in white space, with a blank between an ASCII letter and one
    mark at a chunk's end.  The tokenizer separates them as well."""
    kind = np.frombuffer(data.translate(_KIND), dtype=np.uint8)
    lone = np.flatnonzero((kind[:-2] == 1) & (kind[1:-1] == 2) & (kind[2:] == 3)) + 1
    if not len(lone):
        return data
    out = np.full(len(data) + len(lone), 32, dtype=np.uint8)
    old = np.ones(len(out), dtype=bool)
    old[lone + np.arange(len(lone))] = False
    out[old] = np.frombuffer(data, dtype=np.uint8)
    return out.tobytes()


def _lowered(text: str) -> bytes:
    """The text in UTF-8; ASCII letters are lower-cased where that changes no id: no
    character composes with a letter, and no special token is in it."""
    data = text.encode()
    if text.isascii() or np.frombuffer(data, dtype=np.uint8).max() <= 0xC3:  # up to U+00FF
        return data if b"<|" in data else data.lower()
    return data


def spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every span, one after the other."""
    stop = np.cumsum(length)
    return np.repeat(start - (stop - length), length) + np.arange(stop[-1] if len(stop) else 0)


class Chunks(dict[bytes, int]):
    """Numbers of chunks; ``new`` lists those that were numbered by a look-up.
    Number 0 is ``BETWEEN``."""

    def __init__(self) -> None:
        self[BETWEEN] = 0
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


class WordIds:
    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        # The same model for words that are already lower-cased and split.  They are
        # new, so the model remembers none of them.
        with open(path) as file:
            spec = json.load(file)["model"]
        model = models.BPE(
            vocab=spec["vocab"],
            merges=[tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["merges"]],
            cache_capacity=0, end_of_word_suffix=spec["end_of_word_suffix"])
        self.words = Tokenizer(model)  # of printable ASCII, which byte-level symbols keep
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.beyond = Tokenizer(model)
        self.beyond.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.CharDelimiterSplit(" "),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.whole.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.limit = cache_entries
        self._empty()

    def _empty(self) -> None:
        """Forget all. Chunk 0, between texts, has no ids."""
        self.known = Chunks()
        self.start = np.zeros(1 << 16, dtype=np.int64)
        self.length = np.zeros(1 << 16, dtype=np.int64)
        self.uses = np.zeros(1 << 16, dtype=np.int64)
        self.pool = np.zeros(1 << 18, dtype=np.uint32)
        self.used = 0

    def _forget_rare(self) -> None:
        """Keep the chunks that were met again, the most used ones, at most half a table."""
        uses = self.uses[:len(self.known)]
        keep = np.flatnonzero(uses > 1)
        keep = keep[keep > 0]
        if len(keep) > self.limit // 2:
            keep = np.sort(keep[np.argsort(-uses[keep], kind="stable")[:self.limit // 2]])
        chunks = list(self.known)
        start, length, uses, pool = self.start[keep], self.length[keep], uses[keep] // 2, self.pool
        self._empty()
        for k in keep.tolist():
            self.known[chunks[k]]
        self.known.new.clear()
        at = np.arange(1, len(keep) + 1)
        self._store(at, pool[spans(start, length)], length)
        self.uses[at] = uses

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        got = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in got]

    def _store(self, at: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Ids of the chunks numbered ``at``, one after the other in ``ids``."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.known) > len(self.start):
            self.start, self.length, self.uses = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length, self.uses))
        self.pool[self.used:self.used + len(ids)] = ids
        self.start[at] = self.used + np.cumsum(sizes) - sizes
        self.length[at] = sizes
        self.used += len(ids)

    def _learn(self, chunks: list[bytes]) -> None:
        """Ids of the newest chunks."""
        first = len(self.known) - len(chunks)
        plain, at, beyond, beyond_at, other, other_at = [], [], [], [], [], []
        for number, chunk in enumerate(chunks, first):
            if chunk.isalpha():  # ASCII letters
                plain.append(chunk)
                at.append(number)
                continue
            text = chunk.decode()
            core = text.rstrip(TRAIL)
            if core.isalpha() and (core.isascii() or max(core) < "Ā"):
                into, own = (plain, at) if core.isascii() else (beyond, beyond_at)
                into.append(core.encode())
                own.append(number)
                if len(core) < len(text):
                    into.append(text[len(core):].encode())
                    own.append(number)
            else:
                other.append(text)
                other_at.append(number)
        for words, own, coder in ((plain, at, self.words), (beyond, beyond_at, self.beyond)):
            if not words:
                continue
            ids = np.array(coder.encode_batch_fast(
                [b" ".join(words).decode().lower()], add_special_tokens=False)[0].ids, dtype=np.uint32)
            sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            if len(sizes) != len(words):
                raise AssertionError("a word without exactly one end token")
            begins = np.flatnonzero(np.diff(own, prepend=-1))
            self._store(np.array(own)[begins], ids, np.add.reduceat(sizes, begins))
        if other:
            got = self._whole(other)
            self._store(np.array(other_at), np.concatenate(got), np.array([len(ids) for ids in got]))

    def _segment(self, parts: list[bytes]) -> list[np.ndarray]:
        """Ids of each part; all parts together are about one segment."""
        if len(self.known) > self.limit:
            self._forget_rare()
        chunks = _mark_apart(_JOIN.join(parts) + b" ").split()  # at ASCII white space
        word = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        if self.known.new:
            self._learn(self.known.new)
            self.known.new.clear()
        met = np.bincount(word, minlength=1)
        self.uses[:len(met)] += met
        size = self.length[word]
        stop = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[spans(self.start[word], size)]
        return np.split(ids, stop[np.flatnonzero(word == 0)])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        queue: list[tuple[int, bytes]] = []
        held = 0

        def flush() -> None:
            nonlocal queue, held
            for (i, _), ids in zip(queue, self._segment([b for _, b in queue])):
                out[i].append(ids)
            queue, held = [], 0

        for i, text in enumerate(texts):
            if ODD_SPACE.search(text):
                out[i].append(self._whole([text])[0])
                continue
            for part in _cut(_lowered(text)):
                queue.append((i, part))
                held += len(part) + 1
                if held >= SEGMENT:
                    flush()
        if queue:
            flush()
        return [ids[0] if len(ids) == 1 else np.concatenate(ids) for ids in out]


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One per Python worker, kept between its tasks."""
    return WordIds(path)
