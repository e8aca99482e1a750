"""Licence scan against regular expressions and plain Python, expressions by hand."""

import re

import pytest

import __spark_entry__ as E
from possum.llm import licences as L
from tests.conftest import SF_SMALL

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, lang string, score string, n_words string, labels int"


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def places(words, phrases):
    out = []
    for phrase, label in phrases.items():
        p = phrase.split()
        out += [(i, i + len(p), label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return out


def brute(text):
    words = words_of(text)
    base = places(words, L.BASE_PHRASES)
    found = places(words, L.NOTICE_PHRASES | L.BASE_PHRASES)
    outer = [f for f in found if not any((g[0] <= f[0] and f[1] <= g[1] and g[:2] != f[:2]) for g in found)]
    starts = [b[0] for b in base]
    base_labels = {b[2] for b in base}
    return (len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base_labels)), {f[2] for f in outer} | base_labels)


def check(rows, texts):
    assert [r["doc_id"] for r in rows] == [i for i, _ in texts]
    for r, (_, text) in zip(rows, texts):
        n, n_base, first, last, base, labels = brute(text)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            n, n_base, first, last, base)
        got = set(filter(None, r["labels"].split(",")))
        assert got >= labels and (r["expressions"] or got == labels)
        assert r["labels"] == ",".join(sorted(got)) and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == bool(got)


def test_query_matches_brute_force(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet")
             .select("doc_id", "text").orderBy("doc_id").collect()]
    df = E.queries()["op12_licence_scan"](spark, SF_SMALL)
    assert df.columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                              "labels", "score"]
    rows = df.orderBy("doc_id").collect()
    check(rows, texts)
    assert sum(r["n_base"] for r in rows) > 0


def test_odd_texts(spark):
    long = "lorem ipsum dolor " * 50_000 + "sit CC-BY-NC " * 1000
    texts = [(1, None), (2, ""), (3, "\x00 \x7f ---"), (None, "Under the MIT License"), (4, long),
             (5, "cc by nc by nc cc by nc cc by nc"), (5, "cc by nc by nc cc by nc cc by nc"),
             (6, "xcc by nc, cc by ncx; éunder the mit license under the mit\tlicenseé"),
             (7, "Apache License,\nVersion 2.0 and GNU General Public License, version 3"),
             (8, "ÀPACHE LICENSE VERSION 2 apache license version 2"),
             (9, "Creative Commons Attribution-NonCommercial-ShareAlike. CC BY-NC-SA 4.0"),
             (10, "free and unencumbered software released into the public domain")]
    docs = spark.createDataFrame([(i, t, None, "s", "n", 1) for i, t in texts], SCHEMA).coalesce(1)
    rows = L.scan_licences(docs).collect()
    check(rows, texts)
    assert rows[8]["labels"] == "apache-2,gpl-3" and rows[8]["score"] == L.RESTRICTION["gpl-3"]
    assert rows[11]["labels"] == "unlicense"
    assert L.scan_licences(docs.limit(0)).collect() == []


@pytest.mark.parametrize("text,shown,labels,value", [
    ("mit", "mit", {"mit"}, 0.1),
    ("MIT OR GPL-3.0-only", "(mit or gpl-3)", {"mit", "gpl-3"}, 0.1),
    ("MIT and GPL-3.0-or-later", "(mit and gpl-3)", {"mit", "gpl-3"}, 0.6),
    ("GPL-2.0+ WITH Classpath-exception-2.0", "(gpl-2 with classpath-exception-2.0)", {"gpl-2"}, 0.4),
    # and binds closer than or, with closer than both
    ("GPL-3.0 OR MIT AND CC-BY-NC-4.0", "(gpl-3 or (mit and cc-by-nc))", {"gpl-3", "mit", "cc-by-nc"}, 0.6),
    ("(GPL-3.0 OR MIT) AND CC-BY-4.0", "((gpl-3 or mit) and cc-by)", {"gpl-3", "mit", "cc-by"}, 0.2),
    ("MIT OR GPL-2.0 WITH Linux-syscall-note AND ISC",
     "(mit or ((gpl-2 with linux-syscall-note) and isc))", {"mit", "gpl-2", "isc"}, 0.1),
    # the rest of the line is prose
    ("Apache-2.0 and so on", "apache-2", {"apache-2"}, 0.15),
    ("MIT, see file", "mit", {"mit"}, 0.1),
    ("MIT.", "mit", {"mit"}, 0.1),
    ("MIT\nOR GPL-3.0", "mit", {"mit"}, 0.1),
    ("(MIT OR (ISC AND BSD-3-Clause", "(mit or (isc and bsd-3-clause))", {"mit", "isc", "bsd-3-clause"}, 0.1),
    ("(MIT))) OR ISC", "mit", {"mit"}, 0.1),
    ('"MIT OR Apache-2.0",', "(mit or apache-2)", {"mit", "apache-2"}, 0.1),
    ("MIT WITH ISC", "mit", {"mit"}, 0.1),
    ("(MIT) WITH x-exception", "mit", {"mit"}, 0.1),
    ("LicenseRef-my-own OR GPL-2.0", "(licenseref or gpl-2)", {"licenseref", "gpl-2"}, 0.6),
])
def test_expressions(text, shown, labels, value):
    got = L.parse(text.lower().encode())
    assert (got.text, got.labels, got.restriction) == (shown, labels, value)
    found = L.scanner().scan(f"# SPDX-License-Identifier: {text}")
    assert found.expressions == [shown] and found.labels == labels
    # a base phrase inside an expression is a statement of its own
    assert found.score == max([value, *map(L.RESTRICTION.get, found.base_labels)])


@pytest.mark.parametrize("text", ["", "see the file", "or mit", ")", "((", "with", "and"])
def test_no_expression(text):
    assert L.parse(text.encode()) is None
    assert L.scanner().scan(f"License: {text}").expressions == []


def test_against_python_logic():
    """Random expressions: the value equals Python's evaluation of the same nesting."""
    import random

    rng = random.Random(4)
    names = {"mit": 0.1, "gpl-3.0": 0.6, "cc-by-nc-4.0": 0.85, "mpl-2.0": 0.4, "unlicense": 0.05}

    def build(depth):
        if depth == 0 or rng.random() < 0.3:
            name = rng.choice(list(names))
            return name, names[name], 9
        op = rng.choice(["and", "or"])
        level = 2 if op == "and" else 1
        parts = [build(depth - 1) for _ in range(2)]
        text = f" {op} ".join(f"({t})" if p < level or rng.random() < 0.2 else t for t, _, p in parts)
        return text, (max if op == "and" else min)(v for _, v, _ in parts), level

    for _ in range(300):
        text, value, _ = build(5)
        assert L.parse(text.encode()).restriction == value, text
