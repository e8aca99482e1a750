"""Phrase collocations against SQL and against counting in plain Python."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from checks.compare import duck, rows_of
from possum.llm import collocations as C
from tests.conftest import SF_SMALL

SCHEMA = "doc_id bigint, text string, lang string, n bigint, phrase string, score string, part string"


def brute(rows, least, top):
    low = {c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", "".join(low.get(c, c) for c in text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        kept = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in kept.items():
            inside = any(len(q) > len(p) and 100 * b >= 80 * a
                         and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in kept.items())
            if not inside:
                score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_matches_sql(spark):
    df = E.queries()["op13_phrase_collocations"](spark, SF_SMALL)
    rel = duck(SF_SMALL).sql(E.oracle_sql()["op13_phrase_collocations"])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


@pytest.mark.parametrize("least,top", [(2, 2000), (3, 5)])
def test_small_threshold_matches_counting(spark, least, top, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT", 64)
    monkeypatch.setattr(C, "CHUNK_WORDS", 500)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang").limit(40)
    rows = [tuple(r) for r in docs.collect()]
    got = result(C.collocations(spark.createDataFrame(rows, "text string, lang string"),
                                least, top, smallest_summary=1))
    assert got == brute(rows, least, top) and got


def test_odd_tables(spark):
    long = "alpha beta gamma delta " * 3000
    texts = [(None, "en"), ("", None), ("A b a B; a b.\x0ba b", None), ("a b a b", "und"),
             ("é\x1c ü\xa0x é\x1c ü\xa0x", "de"), ("é\x1c ü\xa0x é\x1c ü\xa0x", "de"), (long, "en"), (long, "en"),
             ("w" * 100_000 + " " + "w" * 100_000, ""), ("\x00 \x7f \x00 \x7f", ""), (" \t ", None)]
    docs = spark.createDataFrame([(None, t, la, 1, "p", None, "q") for t, la in texts], SCHEMA)
    got = result(C.collocations(docs, least=2, smallest_summary=1))
    assert got == brute(texts, 2, 2000) and len(got) > 3
    assert C.collocations(docs.limit(0)).collect() == []
    assert C.collocations(docs.where("text = ''")).collect() == []


def test_words_that_a_polynomial_hash_confuses_stay_apart(spark):
    one, two = "a", "b"
    for _ in range(11):
        one, two = one + two, two + one
    texts = [(f"{one} x " * 2 + f"{two} x " * 3, "en")]
    got = result(C.collocations(spark.createDataFrame(texts, "text string, lang string"), 2, 50))
    assert got == brute(texts, 2, 50)


def test_summary_loses_no_frequent_class():
    rng = np.random.default_rng(3)
    stream = np.concatenate([np.repeat(np.arange(40, dtype=np.uint64), 30),
                             rng.integers(100, 50_000, 20_000).astype(np.uint64)])
    rng.shuffle(stream)
    summary = C.Summary(len(stream) // 30 + 1)
    for part in np.array_split(stream, 37):
        summary.merge(*C._counted(part))
    kept = set(summary.at_least(30).tolist())
    count = collections.Counter(stream.tolist())
    assert {c for c, n in count.items() if n >= 30} <= kept
    assert summary.lost * (summary.capacity + 1) <= len(stream) and len(summary.classes) <= summary.capacity


def test_packing_round_trip():
    values = np.array([0, 1, 255, 256, 2**40, 2**64 - 1], dtype=np.uint64)
    assert (C._unpack(C._pack(values)) == values).all()


def test_a_chunk_ships_each_place_once():
    words = C.Words()
    ids = words.ids("a b c d e. a b c d e. a b")
    chunk = C.Chunk(words, ["en"], ids, [0], [sum(map(len, ids))], C.Layout.of(1000))

    class Every:
        def passes(self, classes):
            return np.ones(len(classes), dtype=bool)

    rows = [r for b in C._phrases(chunk, Every()) for r in b.to_pylist()]
    assert sorted((r["phrase"], r["n"]) for r in rows if r["size"]) == [
        ("a b", 1), ("a b c d", 2), ("b", 1), ("b c d e", 2), ("c d e", 2), ("d e", 2), ("e", 2)]
    assert [r["n"] for r in rows if not r["size"]] == [12]


def shipped(texts, most):
    class Known:
        class value:
            @staticmethod
            def passes(classes):
                return np.ones(len(classes), dtype=bool)

    layout = C.Layout.of(1000)
    batch = pa.record_batch([pa.array(texts), pa.array(["en"] * len(texts))], ["text", "lang"])
    packed = list(C._ship_phrases(layout, Known, most)(iter([batch])))
    merged = collections.Counter()
    for b in C._sum_phrases(most)(iter(packed)):
        for r in b.to_pylist():
            merged[r["size"], r["phrase"]] += r["n"]
    return layout, packed, merged


def test_rows_shipped_do_not_grow_with_chunks_and_phrases(monkeypatch):
    monkeypatch.setattr(C, "CHUNK_WORDS", 50)
    texts = [f"w{i % 97} w{i % 89} w{i % 83} x{i}" for i in range(1000)]
    layout, packed, merged = shipped(texts, C.HELD_BYTES)
    assert sum(b.num_rows for b in packed) <= layout.parts
    want = collections.Counter({(0, ""): 4000})
    for w in map(str.split, texts):
        want.update((4 - k, " ".join(w[k:])) for k in range(4))
    assert merged == want
    for most in (1000, 20_000, 100_000):  # little room: the same counts in more rows
        assert shipped(texts, most)[2] == want


def test_little_room_matches_counting(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang").limit(40)
    rows = [tuple(r) for r in docs.collect()]
    some = spark.createDataFrame(rows, "text string, lang string")
    little, plenty = (sorted(map(tuple, C.frequent_phrases(some, 2, 1, held).collect()))
                      for held in (1000, C.HELD_BYTES))
    assert little == plenty and len(little) > 3
