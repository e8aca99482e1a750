"""Words that a polynomial hash modulo 2**64 cannot tell apart; links, repeats and URL words by brute force."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from possum.llm import exact_dedup, near_join, packing, quality, training_order, urls
from possum.llm.tokens import WordIds, vocabulary_path
from tests.conftest import SF_SMALL


def thue_morse():
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    return a, b


@pytest.fixture(scope="module")
def coder():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def ids_of(coder, text):
    return coder.encode(text, add_special_tokens=False).ids + [1]


def test_confusable_words_get_their_own_ids(spark, coder, scratch_dir):
    pair = thue_morse()
    docs = spark.createDataFrame(list(enumerate(pair)), "doc_id bigint, text string").coalesce(1)
    got = {r["doc_id"]: r["ids_crc32"] for r in packing.pack(docs).collect()}
    want = {i: zlib.crc32(np.array(ids_of(coder, t), "<u4").tobytes()) for i, t in enumerate(pair)}
    assert got == want and want[0] != want[1]
    path = f"{scratch_dir}/order"
    layout, _ = training_order.materialise_order(docs, path, sequence=64, per_shard=50)
    back = {r["slot"]: np.frombuffer(r["ids"], "<u2").tolist()
            for r in training_order.read_order(spark, path).collect()}
    place = training_order.slots(np.arange(layout.sequences), layout.sequences, layout.key)
    stream = [i for t in pair for i in ids_of(coder, t)]
    assert [i for s in place.tolist() for i in back[s]][:len(stream)] == stream
    found = near_join.near_copies(docs).collect()
    assert {(r["class_id"], r["n_copies"], r["n_links"]) for r in found} == {(0, 1, 0), (1, 1, 0)}
    assert near_join.keep_one(docs).count() == 2


def test_ids_do_not_depend_on_a_full_cache(coder):
    small = WordIds(vocabulary_path(), cache_entries=20)
    rng = random.Random(2)
    vocab = ["".join(rng.choice("abcdé.,'-µZ") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    texts = [rng.choice([" ", "\n", "\t \r"]).join(rng.choices(vocab, k=rng.randint(0, 60))) for _ in range(80)]
    for part in itertools.batched(texts + ["", " \n ", "x　y z"], 7):
        got = small.encode_batch(list(part))
        assert [g.tolist() + [1] for g in got] == [ids_of(coder, t) for t in part]


def test_marks_case_and_odd_characters_keep_the_tokenizers_ids(coder):
    rng = random.Random(5)
    plain = [*"abcdTHEZéÀßµª'.,!?-|<>0 1\n\t", *[" "] * 6, "'s", "a,", "b).", "!!", ", ", "<|endoftext|>", "<|ENDOFTEXT|>"]
    odd = ["\u0308", "T\u0308", "\u0130", "\u03a3", "\u03c2", "\u00f8,", "\ufb01", "\u212a", "\u4e2d", "\x85"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40)))
             for alphabet in (plain, plain + odd) for _ in range(1500)]
    for entries in (300_000, 40):
        words = WordIds(vocabulary_path(), cache_entries=entries)
        for part in itertools.batched(texts, 50):
            got = words.encode_batch(list(part))
            assert [g.tolist() + [1] for g in got] == [ids_of(coder, t) for t in part]


def test_case_and_a_mark_take_no_entry_of_their_own():
    words = WordIds(vocabulary_path())
    words.encode_batch(["Onerer, onerer. ONERER\nonerer; nd,", "naïve NaÏve, naïve"])
    assert sorted(words.known)[:-1] == sorted([b",", b".", b";", b"onerer", b"nd", "naïve".encode(), "naÏve".encode()])


def test_an_order_is_read_back_by_one_worker_per_task(spark):
    texts = ["a few words here"] * 9 + [None, ""]
    found = training_order.training_order(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    # What is left to do lists the documents; the records were read in one pass and stored.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert [r["n_ids"] for r in found.collect()] == [training_order.SEQUENCE]


def compared(rows, cross):
    sets = [set(near_join.shingles(r["text"]).tolist()) for r in rows]
    n = len(rows)
    link = {(i, j) for i in range(n) for j in range(n)
            if i != j and not (cross and rows[i]["block"] == rows[j]["block"])
            and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9}
    out = {}
    for i in range(n):
        group, todo = {i}, [i]
        while todo:
            x = todo.pop()
            new = {b for a, b in link if a == x} - group
            group |= new
            todo += new
        if len(group) > 1:
            first = [j for a, j in link if a == i
                     and not any(b < 5 and b in rows[j]["in_buckets"] for b in rows[i]["in_buckets"])]
            out[rows[i]["key"]] = (sum(rows[j]["copies"] for j in first), min(rows[j]["key"] for j in group))
    return out


@pytest.mark.parametrize("cross", [False, True])
@pytest.mark.parametrize("strip", [7, 512])
def test_bucket_comparison_is_exact(cross, strip, monkeypatch):
    monkeypatch.setattr(near_join, "STRIP", strip)
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(400)]
    bases = [rng.choices(vocab, k=100) for _ in range(4)]
    for n in (2, 3, 70):
        rows = []
        for k in range(n):
            words = list(rng.choice(bases)) if k % 4 else rng.choices(vocab, k=rng.randint(1, 90))
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append({"key": bytes([rng.randrange(256), k]), "bucket": 5, "block": k % 2 if cross else 0,
                         "in_buckets": [5] + [3] * (k % 5 == 0) + [9] * (k % 2), "copies": 1 + k % 3,
                         "text": " ".join(words)})
        got = {k: (links, first) for k, links, first in near_join.compare(rows, cross)}
        assert got == compared(rows, cross)


def test_family_over_many_blocks_counts_every_link(spark, monkeypatch):
    monkeypatch.setattr(near_join, "SMALL", 8)
    monkeypatch.setattr(near_join, "BLOCK", 16)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(90):
        words = list(base)
        words[rng.randrange(300)] = f"x{k}"
        rows.append((k, " ".join(words)))
    got = near_join.near_copies(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r["n_links"], r["class_id"]) for r in got} == {(89, 0)}


def test_repeats_are_found_wherever_they_lie():
    rng = random.Random(5)
    features = quality.Features()
    words = rng.choices(["stop", "pots", "spot", "x", "yy", "abba", "baab", "é", "longer-word"], k=4000)
    for sep in (" ", "\n\t"):
        data = np.frombuffer(sep.join(words).encode(), dtype=np.uint8)
        same = (features._shapes(data) & 1).tolist()
        assert same == [0] + [int(a == b) for a, b in zip(words, words[1:])]
    assert (features._shapes(np.frombuffer(b"word " * 4, np.uint8)) & 1).tolist() == [0, 1, 1, 1]


def test_quality_of_odd_rows_is_defined(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(3, 1, 0), (None, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame(
        [(i, "fine clear words here" if i % 2 else "zz!! zz!! zz!!", "s", 0.5, 1) for i in range(200)]
        + [(300, None, "s", 0.5, 1), (301, "", "s", 0.5, 1), (None, "fine clear words here", None, 0.5, 1),
           (7, "fine clear words here", "t", None, 1)],
        "doc_id bigint, text string, source string, score double, predicted int")
    got = quality.classify(docs, labels).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert len(got) == 204 and by[300][0]["score"] == by[301][0]["score"]
    assert by[None][0]["held_out"] and by[None][0]["score"] == by[7][0]["score"] == by[7][1]["score"]
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
               for r in got if r["doc_id"] is not None)


def best_cut(name, counts, total):
    """Every cut of ``name`` tried; unknown characters cost alike, and runs of them are one word."""
    unknown = -math.log(total) - math.log(10.0)
    best = (0.0, ())
    tails = {len(name): best}
    for at in reversed(range(len(name))):  # the best cut of each tail
        best = (unknown + tails[at + 1][0], (name[at], tails[at + 1][1]))
        for end in range(at + 1, len(name) + 1):
            if name[at:end] in counts:
                score = math.log(counts[name[at:end]] / total) + tails[end][0]
                if score > best[0]:
                    best = (score, (name[at:end], tails[end][1]))
        tails[at] = best
    parts, rest = [], best[1]
    while rest:
        parts.append(rest[0])
        rest = rest[1]
    out = []
    for p in parts:
        if out and p not in counts and out[-1][1]:
            out[-1] = (out[-1][0] + p, True)
        else:
            out.append((p, p not in counts))
    return [w for w, _ in out]


def test_urls_against_brute_force(spark):
    rng = random.Random(6)
    vocab = ["cheap", "pill", "pills", "net", "green", "tea", "park", "a", "an", "antiestablishmentarianism",
             "once"]
    html = [" ".join(rng.choices(vocab[:-1], k=20)) for _ in range(60)] + ["<b>once</b><style>hid den</style>"]
    hosts = [f"{rng.choice(vocab)}{rng.choice(vocab)}{rng.choice(['', '24', '7'])}.{rng.choice(['org', 'com', 'net'])}"
             for _ in html]
    rows = [(k, f"http://{h}/{rng.choice(['de', 'fr', 'es', 'en'])}/{rng.choice(vocab)}2x", page, "clash")
            for k, (h, page) in enumerate(zip(hosts, html))]
    rows += [(100, "http://cheappills24.net/de/x", "", None), (101, "http://once.net/", None, None),
             (102, "http://xqxqpark.net", "", None), (100, "http://cheappills24.net/de/x", "", None),
             (103, "http://" + "greentea" * 400 + ".net/", None, None), (104, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, verdict string")
    got = collections.defaultdict(list)
    for r in urls.judge(pages).collect():
        got[r["page_id"]].append(r)
    assert sum(map(len, got.values())) == len(rows)

    counts = collections.Counter()
    for _, _, page, _ in rows:
        visible = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ", page or "")
        counts.update(w for w in re.split("[^a-z]+", visible.lower()) if w)
    total = sum(counts.values())
    cut = {}

    def tokens(text):
        out = []
        for name in re.findall("[a-z]+|[0-9]+", text.lower()):
            if name.isdigit():
                out.append("#")
                continue
            if name not in cut:
                cut[name] = best_cut(name, counts, total)
            out += cut[name]
        return out

    def words(r):
        return [("h", w) for w in tokens(r["host"])] + [("p", w) for w in tokens(r["path"])]

    every = [r for got_rows in got.values() for r in got_rows]
    learned, docs = {"block": collections.Counter(), "allow": collections.Counter()}, collections.Counter()
    for r in every:
        if r["rule"]:
            learned[r["verdict"]].update(words(r))
            docs[r["verdict"]] += 1
    vocabulary = set(learned["block"]) | set(learned["allow"])
    sums = {v: sum(learned[v].values()) + len(vocabulary) + 1 for v in learned}
    for r in every:
        if r["rule"] is None:
            z = math.log((docs["block"] + 1) / (docs["allow"] + 1)) + sum(
                math.log((learned["block"][w] + 1) / sums["block"]) - math.log((learned["allow"][w] + 1) / sums["allow"])
                for w in words(r) if w in vocabulary)
            assert r["verdict"] == ("block" if z > 1e-9 else "allow")
            assert abs(r["p_block"] - 1 / (1 + math.exp(-z))) < 1e-6
            assert r["host_words"] == " ".join(sorted(tokens(r["host"])))
    assert got[100][0]["host_words"] == "# cheap net pills" and got[100][0] == got[100][1]
    assert got[101][0]["host_words"] == "net once" and got[102][0]["host_words"] == "net park xqxq"
    assert got[103][0]["host_words"] == " ".join(["green"] * 400 + ["net"] + ["tea"] * 400)
    assert got[104][0]["host"] == ""


def test_dedup_without_an_index_leaves_no_table(spark):
    before = {t.name for t in spark.catalog.listTables()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert exact_dedup.exact_dedup(docs, buckets=4).count() == docs.count()
    assert exact_dedup.keep_first(docs).count() < docs.count()
    assert {t.name for t in spark.catalog.listTables()} == before
