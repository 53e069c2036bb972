"""The text operators against brute force, with nulls, empty and long texts, ties and repeated rows."""

import base64
import hashlib
import os
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from conformance.check import compare, connect
from isobar.llm import bpe, licences, neardup, packed_ids, packing, pages, rules, substrings, tokens, topk
from isobar.llm.encode import tokenizer_file
from isobar.llm.oracle import ORACLE
from isobar.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 700}" for i in range(40_000))
PASSAGE = " ".join(f"passage{i}" for i in range(30))
TEXTS = [
    (1, "One two  three\nfour.\n"), (2, None), (3, ""), (4, " \t\n"), (5, LONG), (6, PASSAGE + " then more"),
    (7, "before " + PASSAGE), (7, "before " + PASSAGE), (None, "no id here, <|endoftext|> don't"),
    (8, "　caf\xe9 \xa0 na\xefve \U0001f600 a\x1cb"), (9, "One two  three\nfour.\n"), (10, "same " * 60),
]
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(corpus_pipeline.__file__)


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns whose names the operators use themselves
    rows = [(i, t, "x", 1, 2.0) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, task long, node double").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) is None


def test_token_counts(docs, empty):
    path = tokenizer_file("word_bpe_49k.json")
    encode = Tokenizer.from_file(path).encode
    want = [(i, len((t or "").encode()), n := len(encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in TEXTS]
    assert rows(tokens.token_counts(docs, path, block_bytes=200)) == sorted(want, key=repr)
    assert rows(tokens.token_counts(empty, path)) == []


def test_top_k_ties_and_unusable_vectors(spark):
    vectors = [(i, [float(i % 3), 0.25]) for i in range(60)] + [(50, [1.0, 1.0]), (100, None), (200, [float("nan"), 1.0]), (7, [1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(4)
    usable = [(n, i, np.floor(256 * np.array(v, float)).astype(int)) for n, (i, v) in enumerate(vectors) if v and np.isfinite(v).all()]
    want = []
    for n, i, v in usable:
        if i % 50 == 0:
            best = sorted((-int(v @ w), j) for m, j, w in usable if m != n and len(w) == len(v))[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert rows(topk.top_k(df, shard_rows=7, block_queries=2)) == sorted(want, key=repr)
    assert rows(topk.top_k(df.limit(0))) == []


def removed(texts, window):
    seen, out = {}, []
    for i, t in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = re.findall(WORD, t or "")
        gone = set()
        for s in range(len(words) - window + 1):
            first = seen.setdefault(tuple(words[s : s + window]), (i, s))
            if first != (i, s):
                gone.update(range(s, s + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_substrings(docs, empty):
    assert rows(substrings.removals(docs)) == removed(TEXTS, 20)
    assert rows(substrings.removals(empty)) == []
    cleaned = substrings.without_repeats(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(TEXTS)


def test_hash_collisions_do_not_merge_windows():
    codes = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3], np.int32)
    heads = np.array([0, 3, 6])
    exact = substrings._exact_keys(codes, heads, 3)
    assert exact[0] == exact[2] != exact[1]


def test_rules(docs, empty):
    got = {r.doc_id: r for r in rules.judged(docs).collect()}
    for i, t in TEXTS:
        words = re.findall(WORD, t or "")
        grams = list(zip(words, words[1:], words[2:]))
        times = Counter(grams)
        covered = {k + d for k, g in enumerate(grams) if times[g] > 1 for d in range(3)}
        assert (got[i].n_words, got[i].n_repeat_words) == (len(words), len(covered))
        assert got[i].base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
    assert not got[2].kept and rows(rules.judged(empty)) == []


def test_shouting_of_any_shape_is_rejected(spark):
    words = "the rain and the wind of that long day went over it".split()
    base = [f"{w}{i}x" if k % 3 else w for i in range(8) for k, w in enumerate(words)]
    texts = {
        "clean": " ".join(base), "titles": " ".join(w.title() for w in base), "shouted": " ".join(w.upper() for w in base),
        "one mark": " ".join(w + "!" for w in base), "some marks": " ".join(w + "!" * (i % 5 == 0) for i, w in enumerate(base)),
        "accents": " ".join(w.replace("a", "\xe4").upper() for w in base),
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    kept = {r.doc_id for r in rules.judged(df).where("kept").collect()}
    assert kept == {"clean", "titles", "some marks"}


def test_rules_keep_labelled_documents(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").join(rules.judged(spark.read.parquet(f"{SMALL}/documents.parquet")), "doc_id")
    assert labels.where("quality = 0 and kept").count() == 0
    assert labels.where("quality = 1 and not kept and not base_failed").count() == 0


def test_licences(spark, empty):
    assert licences.trained().held_out_accuracy > 0.95
    texts = ["Released under the MIT License.\nmore text", "His driving licence was lost.", None, "", "plain"]
    got = rows(licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "family"))
    assert got == [(0, "mit"), (1, "unknown"), (2, "none"), (3, "none"), (4, "none")]
    assert rows(licences.scan(empty)) == []


MIT_TEXT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
    "so, subject to the following conditions:"
)


def families(spark, texts):
    got = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [r.family for r in sorted(got, key=lambda r: r.doc_id)]


def test_licences_in_long_paragraphs_and_names_alone(spark):
    words = " ".join(f"w{i}" for i in range(300))
    texts = {
        MIT_TEXT: "mit",
        "We thank all of our readers; the whole text of this book is released under the MIT License and may be reused.": "mit",
        f"{words} Licensed under the Apache License, Version 2.0. {words}": "apache-2.0",
        "MIT License": "mit",
        "Licensed under CC BY-SA 4.0.": "unknown",
        "Licensed under the GNU General Public License, version 2.": "unknown",
        f"{words} a license {words}": "unknown",
    }
    assert families(spark, list(texts)) == list(texts.values())


def test_licences_in_other_languages_names_and_wrapped_lines(spark):
    texts = {
        "Veröffentlicht unter der MIT-Lizenz.": "mit",
        "Publicado bajo la licencia MIT.": "mit",
        "Publié sous licence CC BY 4.0.": "cc-by-4.0",
        "Distributed under GPLv3.": "gpl-3.0",
        "Apache-2.0": "apache-2.0",
        "one\n\nThis Source Code Form is\nsubject to the terms of the Mozilla\nPublic License, v. 2.0.\n\ntwo": "mpl-2.0",
        "This program is free software: you can\nredistribute it and/or modify it under the terms\nof the GNU General Public License as published by\n"
        "the Free Software Foundation, either version 3 of\nthe License, or (at your option) any later version.": "gpl-3.0",
        "Sie kam mit dem Hund unter der neuen Brücke an.": "none",
        "Die Lizenz des Senders lief ab.": "unknown",
    }
    assert families(spark, list(texts)) == list(texts.values())


def test_licence_cues_meet_every_triple():
    cues, phrases = licences._cues()
    for templates in licences._templates().values():
        for triple in (g for t in templates for g in licences._triples(licences._words(t))):
            assert triple in phrases or set(triple.split(" ")) & set(cues)


def plainly_judged(paragraph):
    """What the scan should say of one paragraph, by plain lists and numpy."""
    model, (cues, phrases) = licences.trained(), licences._cues()
    words = re.findall(r"[^\W_]+", paragraph.lower())
    cued = lambda ws: bool(set(ws) & set(cues)) or any(f" {p} " in f" {' '.join(ws)} " for p in phrases)
    if not cued(words) and not re.search(licences.MENTION, paragraph):
        return None
    step, judged = licences.WINDOW // 2, []
    for first in range(0, max(len(words) - step, 1), step):
        own = words[first : first + licences.WINDOW]
        if not cued(own):
            continue
        scores = np.array(model.bias) + np.round(model.weights, 6)[:, licences._features(own)].sum(1) / max(len(own), 1) ** 0.5
        e = np.exp((scores - scores.max()) / model.temperature)
        judged.append((int(e.argmax()), float(e.max() / e.sum())))
    triples = set(licences._triples(words))
    out = []
    for at, probability in judged:
        templates = [set(licences._triples(licences._words(t))) for t in list(licences._templates().values())[at - 1]] if at else []
        shared = at and (
            len(triples & set().union(*templates)) >= licences.SHARED * len(triples)
            or any(len(t & triples) >= licences.SHARED * len(t) for t in templates)
        )
        out.append((bool(shared and probability >= licences.LEAST), probability, model.families[at]))
    return max(out, default=(False, None, "unknown"))


def test_licence_scores_equal_numpy(spark):
    rng = np.random.default_rng(8)
    notices = [t for ts in licences._templates().values() for t in ts] + list(licences.UNKNOWN)
    texts = []
    for _ in range(250):
        parts = [notices[rng.integers(len(notices))] for _ in range(rng.integers(1, 3))]
        words = [w for p in parts for w in p.split() if rng.random() > 0.1]
        for _ in range(rng.integers(0, 40)):
            words.insert(int(rng.integers(0, len(words) + 1)), f"w{rng.integers(1000)}")
        texts.append(" ".join(words))
    got = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()
    for r in got:
        want = plainly_judged(texts[r.doc_id])
        assert (r.n_scored, r.n_confirmed) == (int(want is not None), int(want is not None and want[0]))
        assert r.family == ("none" if want is None else want[2] if want[0] else "unknown")
        assert r.probability is None or abs(r.probability - want[1]) < 1e-6
    assert sum(r.n_confirmed for r in got) > 60


def test_licence_recall_and_precision_on_documents(spark):
    # the notices that the documents hold, by their names; every other family or none is wrong
    names = {"mit": r"the MIT License", "apache-2.0": r"the Apache License, Version 2", "gpl-3.0": r"GNU General Public License, version 3"}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    want = {i: {f for f, n in names.items() if re.search(n, t)} for i, t in texts.items()}
    found = {r.doc_id: r.family for r in licences.scan(docs).collect()}
    named = [i for i, fs in want.items() if fs]
    assert len(named) > 10 and all(found[i] in want[i] for i in named)
    assert all(f not in names for i, f in found.items() if not want[i])


def test_licences_of_odd_rows(spark):
    rows_ = [(None, "MIT License", 1, "x"), (7, "MIT License", 1, "x"), (7, "plain", 1, "x"), (8, "w " * 60_000 + "\n\nMIT License", 1, "x"), (None, None, 1, "x")]
    df = spark.createDataFrame(rows_, "doc_id long, text string, family int, scored string")
    got = sorted(((r.doc_id, r.family) for r in licences.scan(df).collect()), key=repr)
    assert got == sorted([(None, "mit"), (7, "mit"), (7, "none"), (8, "mit"), (None, "none")], key=repr)


def similar(texts, size, percent):
    sets = {}
    for i, t in texts:
        words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(words[k : k + size]) for k in range(max(len(words) - size + 1, min(len(words), 1)))}
    part = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = part[a], part[b]
                part = {i: new if p == old else p for i, p in part.items()}
    least = {p: min(i for i in part if part[i] == p) for p in part.values()}
    return sorted((i, len(sets[i]), least[part[i]], i == least[part[i]]) for i in sets)


def test_near_duplicates_with_a_large_group(spark, empty):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    texts = [(i, t) for i, t in TEXTS if i not in (None, 5, 7)]
    for i in range(100, 180):  # near copies of one text that resemble each other less than the text
        words = list(base)
        for k in rng.choice(60, rng.integers(0, 5), replace=False):
            words[k] = f"x{rng.integers(1000)}"
        texts.append((i, " ".join(words)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert rows(neardup.near_duplicates(df, 2, 80)) == sorted(similar(texts, 2, 80), key=repr)
    assert rows(neardup.near_duplicates(empty)) == []


def test_near_dedup_keeps_one_row_of_each_group_whatever_its_ids(spark):
    def text(name, changed=None):
        return " ".join(f"{name}{i}" if i != changed else "other" for i in range(90))

    rows_ = [
        (1, text("a")), (None, text("a", 0)), (7, text("a", 89)), (7, text("c")), (None, text("u")), (None, text("v")),
        (None, text("b")), (None, text("b", 0)), (None, text("b", 89)), (None, text("b")), (8, text("d")), (8, text("d", 0)), (None, ""),
    ]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows_], "doc_id long, text string, extra int").repartition(3)
    got = [(r.doc_id, r.text.split(" ")[5:6]) for r in corpus_pipeline.near_dedup(spark, df, SMALL).collect()]
    want = [(1, ["a5"]), (7, ["c5"]), (None, ["u5"]), (None, ["v5"]), (None, ["b5"]), (8, ["d5"]), (None, [])]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_pruning_bound():
    least = neardup.least_matches(0.8, 1e-6)
    assert (np.diff(least) >= 0).all() and 0.6 * neardup.HASHES < least[-1] < 0.75 * neardup.HASHES


@pytest.mark.parametrize("bits", [1, 7, 15, 16, 17, 32])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001, dtype=np.uint32)
    packed = packed_ids.pack_ids(ids, bits)
    assert len(packed) == -(-1001 * bits // 8)
    assert (packed_ids.unpack_ids(packed, bits, 0, 1001) == ids).all() and (packed_ids.unpack_ids(packed, bits, 333, 41) == ids[333:374]).all()


def test_packed_ids(spark, docs, empty, tmp_path):
    path = tokenizer_file("byte_bpe_50k.json")
    encode, at, want = Tokenizer.from_file(path).encode, 0, []
    for i, t in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    packed_ids.write_ids(docs, str(tmp_path / "ids"), path, 50_257, 2, block_ids=20)
    assert rows(packed_ids.checksums(packed_ids.read_ids(spark, str(tmp_path / "ids")))) == sorted(want, key=repr)
    packed_ids.write_ids(empty, str(tmp_path / "none"), path, 50_257, 2)
    assert rows(packed_ids.read_ids(spark, str(tmp_path / "none"))) == []


def test_packed_ids_of_hot_and_missing_ids(spark, tmp_path):
    """A third of the rows share one id and a third have none: no shard holds most of either."""
    path = tokenizer_file("byte_bpe_50k.json")
    ids = [None] * 200 + [7] * 200 + list(range(200))
    texts = [(i, f"text number {n}") for n, i in enumerate(ids)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    packed_ids.write_ids(docs, str(tmp_path / "ids"), path, 50_257, 2, shards=16)
    found = packed_ids.read_ids(spark, str(tmp_path / "ids")).collect()
    tokenizer = Tokenizer.from_file(path)
    encoded = {i: sorted(tuple(tokenizer.encode(t, add_special_tokens=False).ids) + (2,) for j, t in texts if j == i) for i in ids}
    kept = {}
    for row in sorted(found, key=lambda r: r.start):
        kept.setdefault(row.doc_id, []).append(tuple(np.frombuffer(row.ids, "<u4").tolist()))
    assert list(kept) == [None, *range(200)] and {i: sorted(x) for i, x in kept.items()} == encoded
    found.sort(key=lambda r: r.start)
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    listed = spark.read.parquet(str(tmp_path / "ids")).selectExpr("shard", "explode(doc_ids) AS doc_id")
    assert max(r["count"] for r in listed.groupBy("shard").count().collect()) <= 100


def test_packing(docs, empty):
    path = tokenizer_file("word_bpe_49k.json")
    got = packing.pack_documents(docs, path, end_id=0, capacity=64).collect()
    encode = Tokenizer.from_file(path).encode
    want = []
    for i, t in TEXTS:
        ids = np.array([*encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(i, s // 64, s, len(ids[s : s + 64]), zlib.crc32(ids[s : s + 64].tobytes())) for s in range(0, len(ids), 64)]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 64
    assert rows(packing.pack_documents(empty, path, end_id=0)) == []


def packed(counts, capacity):
    """The number of sequences of a plan that is checked for holding each length as often as it occurs."""
    found, used = packing.plan(counts, capacity), np.zeros(capacity + 1, np.int64)
    for config, many in found:
        assert sum(length * times for length, times in config) <= capacity
        for length, times in config:
            used[length] += times * many
    assert (used == counts).all()
    return sum(many for _, many in found)


def bound(counts, capacity):
    # neither the tokens nor the pieces longer than half a sequence fit in fewer
    return max(-(-int((counts * np.arange(capacity + 1)).sum()) // capacity), int(counts[capacity // 2 + 1 :].sum()))


def test_packing_is_near_the_bound():
    counts = np.random.default_rng(1).integers(0, 40, 513)
    counts[0] = 0
    assert packed(counts, 512) <= bound(counts, 512) * 1.002 + 1


def test_packing_saves_sequences_where_best_fit_wastes_room():
    counts = np.zeros(513, np.int64)
    np.add.at(counts, np.random.default_rng(0).integers(125, 350, 50_000), 1)
    plain = sum(many for _, many in packing.best_fit(counts, 512))
    assert bound(counts, 512) <= packed(counts, 512) < plain


@pytest.mark.parametrize("counts", [{}, {7: 1}, {7: 1000}, {64: 3}, {33: 5, 31: 5}, {33: 9, 20: 4, 11: 30, 1: 3}])
def test_packing_of_few_lengths(counts):
    histogram = np.zeros(65, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    assert packed(histogram, 64) <= sum(many for _, many in packing.best_fit(histogram, 64))


@pytest.mark.parametrize("times", [1, 200])
def test_packing_of_documents_needs_no_more_sequences_than_best_fit(spark, times):
    path = tokenizer_file("word_bpe_49k.json")
    sizes = tokens.token_counts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), path).collect()
    histogram = np.zeros(2049, np.int64)
    for r in sizes:
        histogram[2048] += (r.n_tokens + 1) // 2048
        histogram[(r.n_tokens + 1) % 2048] += 1
    histogram[0] = 0
    histogram *= times
    plain = sum(many for _, many in packing.best_fit(histogram, 2048))
    assert bound(histogram, 2048) <= packed(histogram, 2048) <= plain


def test_the_program_uses_no_length_beyond_its_count():
    counts = np.random.default_rng(5).integers(0, 300, 257)
    counts[0] = 0
    used = np.zeros(257)
    for config, amount in packing.solve(counts, 256).items():
        assert sum(length * times for length, times in config) <= 256
        for length, times in config:
            used[length] += amount * times
    assert (used <= counts + 1e-6).all() and used.sum() > 0.5 * counts.sum()


def test_configurations_are_the_dearest():
    rng = np.random.default_rng(6)
    lengths, prices, most = np.array([3, 4, 7, 9, 10]), rng.random(5), np.array([1, 5, 2, 1, 3])
    chosen, total = packing.configurations(lengths, prices, most, 22)
    for i in range(5):
        options = [
            sum(prices[j] * t for j, t in enumerate(times)) + prices[i]
            for times in np.ndindex(*[min(most[j] - (j == i), 22) + 1 if j <= i else 1 for j in range(5)])
            if sum(lengths[j] * t for j, t in enumerate(times)) + lengths[i] <= 22
        ]
        assert total[i] == pytest.approx(max(options))
        assert sum(prices[j] * t for j, t in chosen[i].items()) == pytest.approx(total[i])
        assert all(t <= most[j] for j, t in chosen[i].items()) and sum(lengths[j] * t for j, t in chosen[i].items()) <= 22


def test_pages(spark):
    html = "<body><nav><a>x</a></nav><article><h1>T &amp; t</h1><p>one<br>two<p>three</article><div class='comments'><p>c</p></div><footer>f</footer>"
    df = spark.createDataFrame([(1, "u", html, 0), (2, "v", None, 0), (None, None, "", 0)], "page_id long, url string, html string, text int")
    got = {r.page_id: (r.text, r.n_chars) for r in pages.extract(df).collect()}
    assert got == {1: ("T & t\n\none two\n\nthree", 21), 2: ("", 0), None: ("", 0)}
    assert rows(pages.extract(df.limit(0))) == []


LINE = "A sentence of the page that goes on for a while, with many words in it. "


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<div id=wrap><h1>T</h1><div><p>{LINE * 4}</div><div><p>{LINE * 6}</div></div>", ["T", LINE * 4, LINE * 6]),
        (f"<nav><a>x</a></nav><div><h1>T</h1><p>by</p><div><p>{LINE}<p>{LINE * 2}</div></div><footer>f</footer>", ["T", "by", LINE, LINE * 2]),
        (f"<div><h1>T</h1><p>{LINE}</p><blockquote>{LINE * 9}</blockquote><p>end</p></div>", ["T", LINE, LINE * 9, "end"]),
        (f"<main><article><p>{LINE * 3}</article><article><p>{LINE * 2}</article></main>", [LINE * 3, LINE * 2]),
    ],
)
def test_regions_of_pages(html, want):
    assert pages.main_text(f"<body>{html}") == "\n\n".join(w.strip() for w in want)


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<div class=content-sidebar-wrap><article class=no-sidebar><div class=entry-header><h1>T</h1></div><p>{LINE}</article></div>", ["T", LINE]),
        (f"<div class=elementor-widget-container><p>{LINE}</p></div><div class=sidebar>s</div>", [LINE]),
        (f"<form><div><h1>T</h1><p>{LINE}</div><label>l</label></form>", ["T", LINE]),
        (f"<form><p>{LINE}</p><p>{LINE}</p></form><div class=footer>f</div>", [LINE, LINE]),
        (f"<article><p>{LINE}</p><div class=ad>x</article><article><p>rest {LINE}</article>", [LINE, f"rest {LINE}"]),
        (f"<article><p>{LINE}</p></article><div class=comments><p>{LINE * 5}</div><aside><article>{LINE * 3}</article></aside>", [LINE]),
        ("<div class=nav>" + "<li><a href=x>link name</a></li>" * 50 + "</div><p>short text of the page</p>", ["short text of the page"]),
        (f"<article><p>a <b>b<span class=ad>x</b>y</span> c</p><p>{LINE}</article>", ["a b", "c", LINE]),
    ],
)
def test_doubtful_elements_of_pages(html, want):
    assert pages.main_text(f"<html><head><title>x</title><body>{html}") == "\n\n".join(w.strip() for w in want)


@pytest.mark.parametrize(
    "html, want",
    [
        # inside an article
        (f"<article><h1>T</h1><p>{LINE}</p><div class=ad-slot>x</div><p>{LINE * 2}</p><div class=related-posts><a>r</a></div>"
         f"<section id=comments-area><p>{LINE}</p></section></article>", ["T", LINE, LINE * 2]),
        (f"<article><div class=entry-header><h2>T</h2></div><p>{LINE}</p><div class='post-share-buttons'>s</div><div class=adContainer>x</div></article>",
         ["T", LINE]),
        (f"<article><div class='text-block list'><p>{LINE}</p></div><div class=news-item>{LINE}</div><p class=no-ads>{LINE}</p></article>", [LINE, LINE, LINE]),
        # on a page without article
        (f"<div class=site-header>s</div><div class=cookie-banner>c</div><div id=wrap><h1>T</h1><p>{LINE * 5}</p><div class=share-buttons>s</div>"
         f"</div><div class=comment-section><p>{LINE}</p></div><div class=site-footer>f</div>", ["T", LINE * 5]),
        (f"<div class=content-sidebar-wrap><div class=widget-container><h1>T</h1><p>{LINE}</p></div><div class=mainSidebar>s</div></div>", ["T", LINE]),
        (f"<body class='has-sidebar no-nav'><div class=sidebar_container><h1>T</h1><p>{LINE}</p></div><div class='comments-wrapper'>c</div>", ["T", LINE]),
        (f"<div class=newsletter_signup>n</div><div><p>{LINE}</p><p>{LINE}</p></div><div class=top-bar>t</div>", [LINE, LINE]),
    ],
)
def test_names_of_elements(html, want):
    assert pages.main_text(f"<html><head><title>x</title><body>{html}") == "\n\n".join(w.strip() for w in want)


@pytest.mark.parametrize("page", ["<div>x" * 100_000, "<b>" * 50_000 + "<p>x" * 20_000, "<div class=ad>" * 50_000 + "x" + "</i>" * 50_000, "<li><p>x" * 50_000])
def test_deep_pages_take_no_longer_than_long_ones(page):
    started = time.monotonic()
    pages.main_text(page)
    assert time.monotonic() - started < 10


def test_repeated_pages(spark):
    rows_ = [(1, "u", f"<article><p>{LINE}</article>")] * 3 + [(None, None, None)] * 2
    got = pages.extract(spark.createDataFrame(rows_, "page_id long, url string, html string")).collect()
    assert sorted((r.n_chars for r in got)) == [0, 0] + [len(LINE.strip())] * 3


def test_byte_bpe(docs, empty):
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in TEXTS:
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert rows(bpe.encode_decode(docs, path, public_tokenizers.PATTERN)) == sorted(want, key=repr)
    many_rows = bpe.encode_decode(docs, path, public_tokenizers.PATTERN, block_bytes=2000, buckets=2, row_words=7)
    assert rows(many_rows) == sorted(want, key=repr)
    assert rows(bpe.encode_decode(empty, path, public_tokenizers.PATTERN)) == []


def test_long_words_are_merged_as_short_ones(spark):
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(4)
    letters = "".join(rng.choice(list("etaoinshrdlu"), 50_000))
    for word in ("a", "hello", "aaaaaaa" * 9, letters[:300], "é中" * 40):
        assert bpe.merge_long(word.encode(), ranks) == own.encode_ordinary(word)
    texts = [(1, letters), (2, f"short {letters[:20_000]} {'中文' * 3000} words " + letters[:256] + " " + letters[:257]), (3, "a" * 9000)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in bpe.encode_decode(df, path, public_tokenizers.PATTERN, buckets=2, row_words=3).collect()}
    for i, t in texts:
        ids = own.encode_ordinary(t)
        assert got[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in rules.judged(docs).where("kept").collect()}
    groups = similar([(i, texts[i]) for i in kept], 5, 80)
    first = {i for i, _, _, stays in groups if stays}
    cleaned = {i: (n, n - gone) for i, n, gone, _ in removed([(i, texts[i]) for i in first], 20)}
    frame = docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        frame = stage(spark, frame, SMALL)
        assert frame.columns == docs.columns
        frame.write.parquet(str(tmp_path / str(number)))
        frame = spark.read.parquet(str(tmp_path / str(number)))
    assert {r.doc_id: len(re.findall(WORD, r.text)) for r in frame.collect()} == {i: left for i, (_, left) in cleaned.items()}
    packed = corpus_pipeline.STAGES[3][1](spark, frame, SMALL)
    assert {r.doc_id for r in packed.collect()} == set(cleaned)


def test_pipeline_stages_bear_odd_rows_and_names(spark):
    good = " ".join(f"the w{i} of" for i in range(60))
    texts = [(1, good), (2, good + " more"), (None, None), (3, ""), (4, None), (None, good.replace("w", "v"))]
    df = spark.createDataFrame([(i, t, 1, 2, "x", 5) for i, t in texts], "doc_id long, text string, text_hash long, kept_id long, d string, n_chars long")
    left = {"quality_rules": 3, "near_dedup": 5, "substring_dedup": 6, "best_fit_packing": 6}
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, df, SMALL)
        assert got.count() == left[stage.__name__] and stage(spark, df.limit(0), SMALL).count() == 0
        assert stage is corpus_pipeline.best_fit_packing or got.columns == df.columns
