"""Licence scan (operator 12).

Two Aho-Corasick automata run over every whole text: one over its words finds
notice phrases, one over its lower-cased bytes finds identifier tags.  Behind
a tag stands an expression of identifiers with ``and``, ``or``, ``with`` and
parentheses; a shunting-yard parser evaluates it.  An expression ends before
the first token that does not fit or is no known identifier, at the end of its
line at the latest; parentheses that stay open close there.

Words are runs of ASCII digits, lower-cased A-Z and all code points above
ASCII.  ``score`` says how restrictive the statements of a document are: 0
without any, else the value of ``RESTRICTION`` (``or`` takes the freer side,
``and`` the stricter one, ``with`` an exception at most that of a weak
copyleft), and the strictest of all statements.  A phrase inside an expression
is a statement of its own.

Defined results: a null or empty text has 0 words, empty label lists, null
first and last word and score 0; repeated rows repeat; a null doc_id stays
null; overlapping places of base phrases all count; a phrase of the method
inside a longer one found at the same place adds no label.  Extra columns are
ignored; an empty table gives no rows.  No row needs another, so there is no
shuffle and a long text costs its own length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

# --- fixed values: phrases and labels of the contract ---
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# --- phrases of the method, as words ---
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under mit": "mit",
    "licensed under the mit": "mit",
    "licensed under the apache license": "apache-2",
    "apache license 2 0": "apache-2",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under the bsd": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "boost software license version 1": "bsl-1",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license v2": "gpl-2",
    "gnu general public license v3": "gpl-3",
    "gnu gpl version 2": "gpl-2",
    "gnu gpl version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu lesser general public license version 2 1": "lgpl-2.1",
    "gnu lesser general public license version 3": "lgpl-3",
    "gnu affero general public license": "agpl",
    "gnu affero general public license version 3": "agpl-3",
    "mozilla public license version 2": "mpl-2",
    "mozilla public license v 2": "mpl-2",
    "eclipse public license version 2": "epl-2",
    "eclipse public license v 2": "epl-2",
    "released into the public domain": "public-domain",
    "dedicated to the public domain": "public-domain",
    "free and unencumbered software released into the public domain": "unlicense",
    "cc0 1 0": "cc0",
    "creative commons zero": "cc0",
    "cc by 4 0": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "creative commons attribution noncommercial sharealike": "cc-by-nc-sa",
    "creative commons attribution noncommercial noderivatives": "cc-by-nc-nd",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx-license-identifier:", "license:", "licence:", '"license":', "'license':",
        "license =", "licence =")
# Restriction of each label, from 0 (none) to 1.
RESTRICTION = {
    "public-domain": 0.05, "unlicense": 0.05, "cc0": 0.05, "wtfpl": 0.05,
    "mit": 0.1, "mit-0": 0.1, "isc": 0.1, "zlib": 0.1, "bsl-1": 0.1, "bsd": 0.1,
    "0bsd": 0.1, "bsd-2-clause": 0.1, "bsd-3-clause": 0.1, "ncsa": 0.1, "python-2": 0.1,
    "apache-2": 0.15, "artistic-2": 0.15, "cc-by": 0.2,
    "lgpl": 0.4, "lgpl-2": 0.4, "lgpl-2.1": 0.4, "lgpl-3": 0.4, "mpl-1.1": 0.4, "mpl-2": 0.4,
    "epl-1": 0.4, "epl-2": 0.4, "cddl-1": 0.4, "eupl-1.2": 0.45,
    "cc-by-sa": 0.5, "gpl": 0.6, "gpl-2": 0.6, "gpl-3": 0.6, "agpl": 0.7, "agpl-3": 0.7,
    "sspl-1": 0.8, "cc-by-nd": 0.8, "cc-by-nc": 0.85, "cc-by-nc-sa": 0.9, "cc-by-nc-nd": 0.95,
    "all-rights-reserved": 1.0, "licenseref": 1.0,
}
WEAK_COPYLEFT = 0.4  # what an exception leaves of a stricter licence

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_GAPS = re.compile(b"  +")
_OPENING = re.compile(b"[ \t\"'=:]*")
_TOKEN = re.compile(rb"[ \t]*(\(|\)|[a-z0-9][a-z0-9.+-]*)")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str | None:
    """Label of a lower-case licence identifier; None if it is unknown.

    The label leaves out which later versions count too, a final ``.0``, and
    the version of a Creative Commons licence.
    """
    if identifier.startswith("licenseref-"):
        return "licenseref"
    name = re.sub(r"(-only|-or-later|\+)$", "", identifier.rstrip("."))
    name = re.sub(r"^(cc.*?)-\d+\.\d+$", r"\1", name)
    name = re.sub(r"\.0$", "", name)
    return name if name in RESTRICTION else None


def is_exception(identifier: str) -> bool:
    return "exception" in identifier or identifier == "linux-syscall-note"


@dataclass(frozen=True)
class Expression:
    text: str
    labels: frozenset[str]
    restriction: float


def _tokens(data: bytes, at: int) -> list[str]:
    """The longest run of tokens from ``at`` that ends behind an operand and fits the grammar."""
    out: list[str] = []
    complete = depth = 0
    operand = True  # whether an operand comes next
    at = _OPENING.match(data, at).end()
    while (got := _TOKEN.match(data, at)) is not None:
        token = got.group(1).decode()
        at = got.end()
        if operand:
            if token == "(":
                depth += 1
            elif out and out[-1] == "with":
                if not is_exception(token):
                    break
                operand = False
            elif token in _PRECEDENCE or token == ")" or label_of(token) is None:
                break
            else:
                operand = False
        elif token == ")" and depth:
            depth -= 1
        elif token == "with" and (out[-1] == ")" or out[-2:-1] == ["with"]):
            break  # an exception belongs to one licence
        elif token in _PRECEDENCE:
            operand = True
        else:
            break
        out.append(token)
        if not operand:
            complete = len(out)
    return out[:complete]


def parse(data: bytes, at: int = 0) -> Expression | None:
    """The expression that starts at ``at`` of lower-cased bytes, evaluated by the
    shunting-yard method; None if none does."""
    operands: list[Expression] = []
    operators: list[str] = []

    def apply(operator: str) -> None:
        right, left = operands.pop(), operands.pop()
        if operator == "with":
            value = min(left.restriction, WEAK_COPYLEFT)
        else:
            value = (min if operator == "or" else max)(left.restriction, right.restriction)
        operands.append(Expression(f"({left.text} {operator} {right.text})",
                                   left.labels | right.labels, value))

    for token in _tokens(data, at):
        if token in _PRECEDENCE:
            while operators and operators[-1] != "(" and _PRECEDENCE[operators[-1]] >= _PRECEDENCE[token]:
                apply(operators.pop())
            operators.append(token)
        elif token == "(":
            operators.append(token)
        elif token == ")":
            while operators[-1] != "(":
                apply(operators.pop())
            operators.pop()
        elif operators and operators[-1] == "with":
            operands.append(Expression(token, frozenset(), 0.0))
        else:
            label = label_of(token)
            operands.append(Expression(label, frozenset([label]), RESTRICTION[label]))
    while operators:
        if (operator := operators.pop()) != "(":
            apply(operator)
    return operands[0] if operands else None


@dataclass(frozen=True)
class Found:
    n_words: int
    base_starts: list[int]
    base_labels: set[str]
    labels: set[str]
    score: float
    expressions: list[str]


class Scanner:
    """Both automata, over texts as bytes (one character per byte)."""

    def __init__(self) -> None:
        import ahocorasick

        self.phrases = ahocorasick.Automaton()
        for phrase, label in (NOTICE_PHRASES | BASE_PHRASES).items():
            self.phrases.add_word(f" {phrase} ", (len(phrase) + 2, label, phrase in BASE_PHRASES))
        self.phrases.make_automaton()
        self.tags = ahocorasick.Automaton()
        for tag in TAGS:
            self.tags.add_word(tag, tag)
        self.tags.make_automaton()

    def scan(self, text: str) -> Found:
        raw = text.encode()
        words = _GAPS.sub(b" ", b" " + raw.translate(_WORDS) + b" ")
        n_words = words.count(b" ") - 1
        labels, base_labels, base_at, own = set(), set(), [], []
        for end, (size, label, is_base) in self.phrases.iter(words.decode("latin-1")):
            start = end - size + 1
            own.append((start, -end, label))
            if is_base:
                base_at.append(start)
                base_labels.add(label)
        last = -1
        for start, end, label in sorted(own):
            if -end > last:  # not inside a longer phrase
                labels.add(label)
                last = -end
        score = max((RESTRICTION[label] for label in labels | base_labels), default=0.0)
        starts, at, number = [], 0, 0
        for start in sorted(base_at):
            number += words.count(b" ", at, start)
            at = start
            starts.append(number)
        expressions = []
        low = raw.translate(_LOWER)
        behind = -1
        for end, tag in self.tags.iter(low.decode("latin-1")):
            if end == behind:  # a tag inside a longer one
                continue
            behind = end
            if (found := parse(low, end + 1)) is not None:
                expressions.append(found.text)
                labels |= found.labels
                score = max(score, found.restriction)
        return Found(n_words, starts, base_labels, labels | base_labels, score, expressions)


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    """One per Python worker, kept between its tasks."""
    return Scanner()


_NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
          "expressions"]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [scanner().scan(text.as_py() or "") for text in batch.column(1)]
        longs = [[f.n_words for f in found], [len(f.base_starts) for f in found],
                 [f.base_starts[0] if f.base_starts else None for f in found],
                 [f.base_starts[-1] if f.base_starts else None for f in found]]
        yield pa.record_batch([
            batch.column(0), *[pa.array(c, pa.int64()) for c in longs],
            pa.array([",".join(sorted(f.base_labels)) for f in found], pa.string()),
            pa.array([",".join(sorted(f.labels)) for f in found], pa.string()),
            pa.array([f.score for f in found], pa.float64()),
            pa.array([f.expressions for f in found], pa.list_(pa.string())),
        ], _NAMES)


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, base places, labels, restriction score, expressions."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _scan, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
               " base_labels string, labels string, score double, expressions array<string>")
