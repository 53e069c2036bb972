"""Ranked search, the quality classifier and phrase mining against brute force."""

import math
import os
import re
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from conformance.check import compare, connect
from isobar.llm import collocations, discriminant, lexical
from isobar.llm import text as X
from isobar.llm.oracle import ORACLE
from isobar.llm.queries import QUERIES
from isobar.llm.runs import runs

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 70} of the.sea" for i in range(9_000))
DOCS = [
    (1, "The sea, the SEA! of of", "en"), (2, None, "en"), (3, "", None), (4, " .,;\t\n", "en"), (5, LONG, "en"),
    (7, "sea of stones", "de"), (7, "sea of stones", "de"), (None, "stones of the sea", None), (None, "stones of the sea", None),
    (8, "caf\xe9 Stra\xdfe 中文 sea\x1cof", "und"), (9, "stones", "en"), (11, "the of " * 40, ""),
]
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(corpus_pipeline.__file__)


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns whose names the operators use themselves
    rows = [(i, t, l, 1, 2.0, "x", 3) for i, t, l in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score long, statistics double, phrase string, n int").repartition(3)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@given(st.lists(st.text(alphabet="ab \n.é中", max_size=12), max_size=8))
@settings(max_examples=60, deadline=None)
def test_runs_are_the_matches_of_the_pattern(texts):
    found = runs(*X.flat(pa.array(texts, pa.string())), lexical.SEPARATOR)
    words = found.vocabulary.to_pylist()
    got = [[words[c] for c in found.codes[a:b]] for a, b in zip(found.bounds[:-1], found.bounds[1:])]
    assert got == [re.findall(TERM, t) for t in texts]


# --- search -------------------------------------------------------------------------------


def ranked(docs, items, k):
    terms = [re.findall(TERM, low(t)) for _, t, *_ in docs]
    number, length = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(w for t in terms for w in set(t))
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(re.findall(TERM, low(t)))
    out = []
    for item, own in wanted.items():
        scored = []
        for (doc, *_), t in zip(docs, terms):
            tf, m = Counter(t), 50 + 50 * len(t) * number // length if length else 0
            weight = lambda w: math.floor(1000 * math.log((2 * number + 2) / (2 * df[w] + 1)))
            score = sum(weight(w) * (1_000_000_000 * tf[w] // (1000 * tf[w] + 20 * m)) for w in own if tf[w])
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, n + 1, d, -s) for n, (s, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


ITEMS = [(1, "The sea of"), (2, "stones OF the sea"), (3, None), (4, "nowhere"), (5, "of the sea stones"), (5, "caf\xe9"), (None, "seaß of the"), (6, "")]


@pytest.mark.parametrize("k, batch_bytes", [(3, 1 << 20), (50, 40)])
def test_search(spark, docs, k, batch_bytes, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 20)
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, doc_id int")
    got = lexical.search(docs, items, k, batch_bytes=batch_bytes)
    assert rows(got) == ranked(DOCS, ITEMS, k)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


def test_search_of_nothing(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(lexical.search(docs.limit(0), items)) == rows(lexical.search(docs, items.limit(0))) == []
    assert rows(lexical.search(docs.where("doc_id in (2, 3, 4)"), items)) == []


def _expanded(nodes, n_terms):
    """The terms of each node, and how often each is added."""
    out = {}
    for node, children in nodes:
        out[node] = sum((out[c] if c >= n_terms else Counter([c]) for c in children.tolist()), Counter())
    return out


@given(st.lists(st.sets(st.integers(0, 14), max_size=12), max_size=12))
@settings(max_examples=150, deadline=None)
def test_every_item_adds_each_of_its_terms_once(sets):
    nodes, tops = lexical.sharing([sorted(s) for s in sets], 15)
    terms = _expanded(nodes, 15)
    assert [terms[t] for t in tops] == [Counter(s) for s in sets]


def test_shared_sets_save_additions():
    rng = np.random.default_rng(0)
    common = list(range(30))
    sets = [sorted([*rng.choice(common, 20, replace=False).tolist(), *range(100 + 5 * i, 105 + 5 * i)]) for i in range(300)]
    nodes, tops = lexical.sharing(sets, 2000)
    terms = _expanded(nodes, 2000)
    assert all(terms[t] == Counter(s) for t, s in zip(tops, sets))
    assert sum(max(len(c) - 1, 0) for _, c in nodes) < 0.7 * sum(len(s) - 1 for s in sets)


def test_lengths_past_64_bits():
    n = np.array([3, 10**12], np.int64)
    assert lexical._lengths(n, 10**10, 10**15).tolist() == [50 + 50 * 3 * 10**10 // 10**15, 50 + 50 * 10**22 // 10**15]


# --- quality ------------------------------------------------------------------------------


def plain_statistics(text):
    """The statistics of one text, counted one by one."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = [c for w in words for c in w.encode()]
    letters = [c for c in seen if chr(c) in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    marks = [c for c in text.encode() if not (c >= 128 or chr(c).isalnum() or chr(c) in " \t\n\x0b\x0c\r.,;:?")]
    marked = [w for w in words if any(not (c.isalnum() or ord(c) > 127 or c in ".,;:?") for c in w)]
    triples = list(zip(words, words[1:], words[2:]))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    lengths = [len(w) for w in words]
    share = lambda a, b: a / max(b, 1)
    mean = share(sum(lengths), len(words))
    spread = max(share(sum(x * x for x in lengths), len(words)) - mean**2, 0) ** 0.5
    stops = set(discriminant.STOPPED)
    roots = [
        share(sum(chr(c).isupper() for c in letters), len(letters)), share(len(marks), len(seen)), share(len(marked), len(words)),
        share(sum(48 <= c <= 57 for c in seen), len(seen)), share(sum(chr(c) in ".,;:?" for c in seen), len(seen)),
        share(sum(w.strip(".,;:?!").lower() in stops for w in words), len(words)), share(len(set(words)), len(words)),
        share(sum(a == b for a, b in zip(words, words[1:])), len(words)), share(len(triples) - len(set(triples)), len(words)),
        share(len(lines) - len(set(lines)), len(lines)),
    ]
    wide = share(sum(c >= 128 for c in seen), len(seen)) ** 0.5
    return [math.log1p(len(words)), math.log1p(mean), math.log1p(spread), *(x**0.5 for x in roots), math.log1p(share(len(words), len(lines))), wide]


def test_statistics_are_what_they_say():
    texts = [t for _, t, _ in DOCS] + ["a a a b\na a a b\n\nc", "One!! two && 3,4 \xe9t\xe9\n", "x"]
    got = discriminant.statistics(pa.array(texts, pa.string())) / discriminant.GRID
    want = np.array([plain_statistics(t) for t in texts])
    assert np.abs(got - want).max() <= 0.51 / discriminant.GRID
    alone = np.concatenate([discriminant.statistics(pa.array([t], pa.string())) for t in texts])
    assert (alone == discriminant.statistics(pa.array(texts, pa.string()))).all()


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_scores_equal_a_plain_discriminant(spark):
    documents, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in documents.collect()}
    label = {r.doc_id: r.quality for r in labels.collect()}
    stats = {i: np.rint(np.array(plain_statistics(t)) * discriminant.GRID) / discriminant.GRID for i, t in texts.items()}
    taught = [i for i in texts if i in label and not held_out(i)]
    groups = [np.array([stats[i] for i in taught if label[i] == c]) for c in (0, 1)]
    spreads = [np.cov(g.T, bias=True) for g in groups]
    common = sum(s * len(g) for s, g in zip(spreads, groups)) / len(taught)
    logs = []
    for group, spread in zip(groups, spreads):
        a, b = discriminant.TOWARDS_COMMON, discriminant.TOWARDS_DIAGONAL
        shrunk = (1 - b) * ((1 - a) * spread + a * common) + b * np.diag(np.diag(common)) + discriminant.LEAST_SPREAD**2 * np.eye(len(spread))
        off = np.array(list(stats.values())) - group.mean(0)
        distance = np.einsum("ij,jk,ik->i", off, np.linalg.inv(shrunk), off)
        logs.append(math.log(len(group) / len(taught)) - 0.5 * np.linalg.slogdet(shrunk)[1] - 0.5 * distance)
    want = dict(zip(stats, 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))))
    got = QUERIES["op12_quality_classifier"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        assert abs(r.score - want[r.doc_id]) < 1e-6 and r.held_out == held_out(r.doc_id) and r.predicted == (r.score >= 0.3)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    found = QUERIES["op12_quality_classifier"](spark, d).join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 50 and np.mean([r.predicted == r.quality for r in found]) > 0.95


def test_quality_of_odd_rows(spark, docs):
    labels = [(1, 1), (1, 1), (5, 1), (7, 0), (9, 0), (9, 1), (11, 0), (None, 1), (3, None), (4, 7), (99, 1)]
    frame = spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, label int")
    got = discriminant.quality_scores(docs, frame).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((i for i, *_ in DOCS), key=repr)
    assert all(0 <= r.score <= 1 and not math.isnan(r.score) for r in got)
    assert all(r.held_out == held_out(r.doc_id) for r in got)
    model = discriminant.quality_scores(docs, frame.limit(0)).collect()
    assert {r.score for r in model} == {0.5} and {r.predicted for r in model} == {1}
    only = discriminant.quality_scores(docs, frame.where("doc_id = 1")).collect()
    assert {r.score for r in only} == {2 / 3 if not held_out(1) else 0.5}
    assert rows(discriminant.quality_scores(docs.limit(0), frame)) == []


# --- phrases ------------------------------------------------------------------------------


def best_phrases(docs, least, most, percent=80):
    counts, words = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            own = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(own)
            counts.update((lang, tuple(own[i : i + n])) for n in range(1, 5) for i in range(len(own) - n + 1))
    candidates = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    out = []
    for (lang, phrase), a in candidates.items():
        longer = [
            b for (other, p), b in candidates.items()
            if other == lang and len(p) > len(phrase) and any(p[i : i + len(phrase)] == phrase for i in range(len(p)))
        ]
        if any(100 * b >= percent * a for b in longer):
            continue
        cuts = [(counts[lang, phrase[:k]], counts[lang, phrase[k:]], k) for k in range(1, len(phrase))]
        score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for l, r, k in cuts)
        out.append((lang, -score, -a, " ".join(phrase).encode(), l, r))
    ranked_ = []
    for lang, group in groupby(sorted(out), key=lambda x: x[0]):
        ranked_ += [(lang, n + 1, p.decode(), -a, l, r, words[lang], -s) for n, (_, s, a, p, l, r) in enumerate(list(group)[:most])]
    return sorted(ranked_, key=repr)


MORE = [
    (20, "New York city. new york city, new york\nNEW YORK city new york", "en"), (21, "a b c d e a b c d e a b c d", "en"),
    (22, "x x x x x x x x x", None), (23, "x x\tx  x; éà éà éà z\x0bq q q", "und"), (24, "a b c d " * 9, "fr"),
]


@pytest.mark.parametrize("least, most", [(2, 2000), (3, 4), (30, 2000)])
def test_phrases(spark, least, most, monkeypatch):
    texts = DOCS + MORE
    df = spark.createDataFrame([(i, t, l, 1, 2) for i, t, l in texts], "doc_id long, text string, lang string, f int, k int").repartition(5)
    assert rows(collocations.collocations(df, least, most)) == best_phrases(texts, least, most)
    assert rows(collocations.collocations(df.limit(0))) == []


def test_many_buckets_and_blocks(spark, monkeypatch):
    # the workers cut the blocks, so their size comes in with the function; the bucket size is the driver's
    monkeypatch.setattr(collocations, "ENTRIES", 50)
    texts = DOCS + MORE
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(7)
    assert rows(collocations.collocations(df, 2)) == best_phrases(texts, 2, 2000)


def test_phrases_with_one_fingerprint_are_parted():
    langs, words = ["en"], [b"a", b"b", b"c"]
    codes = np.array([0, 1, 0, 2, 0, 1], np.uint8)
    block = collocations._Block(langs, X.pack(codes, np.array([6], np.uint8), np.array([0], np.uint8), *X.joined(words)))
    at, prints = block.grams(2)
    places, times = block.counted(at, np.zeros(len(at), np.uint64), 2)
    got = {(int(codes[p]), int(codes[p + 1])): int(n) for p, n in zip(places, times)}
    assert got == {(0, 1): 2, (1, 0): 1, (0, 2): 1, (2, 0): 1}
    places, times = block.counted(at, prints, 2)
    assert {(int(codes[p]), int(codes[p + 1])): int(n) for p, n in zip(places, times)} == got


def test_fingerprints_do_not_depend_on_the_place():
    codes = np.array([0, 1, 2, 0, 1, 2, 0], np.uint8)
    block = collocations._Block(["en"], X.pack(codes, np.array([7], np.uint8), np.array([0], np.uint8), *X.joined([b"x", b"y", b"z"])))
    for size in range(1, 5):
        at, prints = block.grams(size)
        seen = {}
        for p, f in zip(at.tolist(), prints.tolist()):
            assert seen.setdefault(tuple(codes[p : p + size].tolist()), f) == f
        assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("name", ["op11_ranked_search", "op13_collocations"])
def test_equal_sql_on_more_rows(spark, name):
    d = "/root/testdata/sf0.01"
    assert compare(QUERIES[name](spark, d), connect(d), ORACLE[name]) is None
