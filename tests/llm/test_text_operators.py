"""The text operators on awkward rows, against brute force and against their oracle SQL."""

import hashlib
import itertools
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from oracle import connect, difference
from pyspark.sql import functions as F

import sluice.llm.queries  # noqa: F401
from sluice.llm import contamination, encoding, language, minhash, scoring, sharding, substrings, vectors
from sluice.llm.common import components, word_hashes
from sluice.llm.contamination import MASKS, MISSES, WINDOW
from sluice.llm.language import grams, identify, ranked
from sluice.llm.licenses import license_scan
from sluice.llm.pieces import SPACE, Cutter, load_pieces, words_of
from sluice.llm.registry import ORACLE, QUERIES
from sluice.llm.token_counts import with_token_counts

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
#: Extra columns with names that the operators use themselves.
DOCS = "doc_id bigint, text string, lang string, key bigint, start int, n_words string"


def prose(seed, count, vocabulary=400):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(count))


def rows():
    passage = prose(1, 70)
    return [
        (None, passage + " nobody", "en", 1, 1, "x"),
        (1, None, "en", 1, 1, "x"),
        (2, "", None, 1, 1, "x"),
        (3, " \n\t ", "en", 1, 1, "x"),
        (4, prose(2, 30) + "\n" + passage + " " + prose(3, 20), "en", 1, 1, "x"),
        (5, prose(4, 10) + " " + passage + "\n" + prose(5, 200), "en", 1, 1, "x"),
        (6, passage, "en", 1, 1, "x"),
        (6, passage, "en", 1, 1, "x"),
        (7, prose(6, 5000), "fr", 1, 1, "x"),
        (8, prose(6, 5000) + " more", "fr", 1, 1, "x"),
        (9, "über straße 12 été", "de", 1, 1, "x"),
        (10, "the same word " * 300, "en", 1, 1, "x"),
        (11, "The Same word " * 200, "en", 1, 1, "x"),
        (12, "x" * 3000, "en", 1, 1, "x"),
        (13, "Released under the MIT License.\nCC BY NC; apache license, version 2", "en", 1, 1, "x"),
        (14, "one", "en", 1, 1, "x"),
        (15, "日本語 ▁ tab\tend", "en", 1, 1, "x"),
        (16, "12 34 !!", "en", 1, 1, "x"),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def reach(ids, links):
    label = {i: i for i in ids}
    for _ in ids:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) is None


def test_word_hashes_name_words():
    text = "a b  a\tcc\x0bb".encode()
    found = word_hashes(text)
    assert found[0] == found[2] and found[1] == found[4] and len(set(found.tolist())) == 3
    assert len(word_hashes(b"  ")) == 0


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (200, 200)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"), "chain")
    got = {r.id: r.component for r in found.collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_near_duplicates(docs, empty):
    found = [tuple(r) for r in minhash.near_duplicate_groups(docs, words=2).collect()]
    sets = {}
    for doc, text, *_ in rows():
        parts = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        pairs = set(zip(parts, parts[1:])) or {tuple(parts)} - {()}
        sets.setdefault(doc, []).append(pairs)
    ids = [i for i in sets if i is not None]
    links = [
        (a, b)
        for a, b in itertools.combinations(ids, 2)
        for x, y in itertools.product(sets[a], sets[b])
        if x and y and 100 * len(x & y) >= 80 * len(x | y)
    ]
    label = reach(ids, links)
    assert len(found) == len(rows())
    for doc, size, component, kept in found:
        assert size == len(sets[doc][0])
        assert component == (None if doc is None else label[doc])
        assert kept == (doc is None or doc == component)
    assert minhash.near_duplicate_groups(empty).count() == 0
    kept = minhash.one_per_group(docs, words=2)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {None} | set(label.values())


def test_noisy_copies_are_one_group(spark):
    pick, base = random.Random(5), prose(9, 120, 5000).split()
    texts = []
    for number in range(150):
        copy = list(base)
        for _ in range(pick.randrange(0, 9)):
            copy[pick.randrange(len(copy))] = f"n{pick.randrange(10**6)}"
        texts.append((number, " ".join(copy)))
    sets = {n: set(zip(t.split(), t.split()[1:])) for n, t in texts}
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    label = reach(sets, links)
    found = minhash.near_duplicate_groups(spark.createDataFrame(texts, "doc_id bigint, text string"), 2)
    assert {r.doc_id: r.component_id for r in found.collect()} == label


def test_noisy_cut_copies_match_brute_force(spark):
    # Copies of several lengths, with changes from a small vocabulary, around two texts.
    pick = random.Random(11)
    bases = [prose(3, 150, 4000).split(), prose(4, 60, 4000).split()]
    texts = []
    for number in range(240):
        copy = list(bases[number % 2])
        for _ in range(pick.randrange(0, 12)):
            copy[pick.randrange(len(copy))] = f"n{pick.randrange(30)}"
        copy = copy[pick.randrange(0, 12) : len(copy) - pick.randrange(0, 12)]
        texts.append((number, " ".join(copy)))
    sets = {n: set(zip(t.split(), t.split()[1:])) for n, t in texts}
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    label = reach(sets, links)
    assert len(set(label.values())) > 20
    found = minhash.near_duplicate_groups(spark.createDataFrame(texts, "doc_id bigint, text string"), 2)
    assert {r.doc_id: r.component_id for r in found.collect()} == label


@pytest.mark.parametrize("most", [500, 1])
def test_repeated_passages(docs, empty, most, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_PASSAGES", most)
    seen = {}
    for doc, text, *_ in rows():
        parts = words(text)
        for i in range(len(parts) - 49):
            key = tuple(parts[i : i + 50])
            if doc is not None:
                seen[key] = min(doc, seen.get(key, doc))
    expected = []
    for doc, text, *_ in rows():
        parts = words(text)
        gone = {
            i + n
            for i in range(len(parts) - 49)
            for n in range(50)
            if doc is not None and seen[tuple(parts[i : i + 50])] < doc
        }
        kept = [w for i, w in enumerate(parts) if i not in gone]
        digest = hashlib.sha256(" ".join(kept).encode()).hexdigest()
        expected.append((doc, len(parts), len(gone), digest, text if not gone else None))
    found = substrings.without_repeats(docs).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256, None if r.n_removed else r.text) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(hashlib.sha256(" ".join(words(r.text)).encode()).hexdigest() == r.kept_sha256 for r in found)
    assert found[0].start == 1 and found[0].lang is not False
    assert substrings.without_repeats(empty).count() == 0


@pytest.mark.parametrize("most", [500, 1])
def test_passages_repeated_inside_a_document(spark, most, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_PASSAGES", most)
    passage = prose(11, 90).split()
    twice = [*prose(12, 20).split(), *passage, *prose(13, 30).split(), *passage, *prose(14, 9).split()]
    texts = [
        (1, ["a"] * 60),
        (2, ["a"] * 2000),
        (3, ["b", "c"] * 40),
        (4, ["b", "c"] * 900),
        (5, [*prose(15, 8).split(), *passage[10:75], *prose(16, 8).split()]),
        (6, twice),
        # Another row of the id, with the passage in it.
        (6, [*prose(17, 12).split(), *passage]),
        (7, twice[5:]),
    ]
    seen, expected = {}, []
    for doc, parts in texts:
        for i in range(len(parts) - 49):
            seen.setdefault(tuple(parts[i : i + 50]), doc)
    for doc, parts in texts:
        gone = {
            i + n
            for i in range(len(parts) - 49)
            if seen[tuple(parts[i : i + 50])] < doc
            for n in range(50)
        }
        kept = " ".join(w for i, w in enumerate(parts) if i not in gone)
        expected.append((doc, len(parts), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    frame = spark.createDataFrame(
        [(doc, " ".join(parts)) for doc, parts in texts], "doc_id bigint, text string"
    )
    found = substrings.without_repeats(frame).drop("text").collect()
    assert sorted(tuple(r) for r in found) == sorted(expected)


def test_vectors(spark, monkeypatch):
    pick = np.random.default_rng(3)
    data = []
    for label in (1, 1, 2):
        centre = pick.normal(size=8)
        data += [((centre + pick.normal(size=8) * s).tolist(), label) for s in np.linspace(0, 0.5, 30)]
    data += [(data[0][0], 1)] * 40 + [(data[0][0], 2), (data[1][0], None)]
    data += [(None, 1), ([], 1), ([0.0] * 8, 1), ([1.0] * 7 + [float("nan")], 1),
             ([1.0] * 7 + [float("inf")], 1), ([1.0, None], 1), ([1.0, 2.0], 1)]
    table = [(i, v, l, "x") for i, (v, l) in enumerate(data)]
    frame = spark.createDataFrame(
        [*table, (None, data[0][0], 1, "x")],
        "vec_id bigint, embedding array<double>, label int, rep string",
    )
    links = []
    for (i, a, l, _), (j, b, m, _) in itertools.combinations(table, 2):
        if l is None or l != m or a is None or b is None or len(a) != len(b) or not a:
            continue
        if any(x is None or not math.isfinite(x) for x in [*a, *b]) or not any(a) or not any(b):
            continue
        if np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b)) >= 0.98:
            links.append((i, j))
    label = reach(range(len(table)), links)
    degree = Counter(i for pair in links for i in pair)
    for per_pivot, block in ((4096, 4096), (10, 7)):
        monkeypatch.setattr(vectors, "PER_PIVOT", per_pivot)
        monkeypatch.setattr(vectors, "BLOCK", block)
        got = vectors.near_duplicate_vectors(frame).collect()
        assert len(got) == len(table) + 1
        for r in got:
            if r.vec_id is not None:
                assert (r.n_links, r.component_id) == (degree[r.vec_id], label[r.vec_id])
    none = spark.createDataFrame([], frame.schema)
    assert vectors.near_duplicate_vectors(none).count() == 0


def test_languages(docs, empty, spark):
    found = {r.doc_id: r for r in identify(docs).collect()}
    assert {found[i].lang_pred for i in (1, 2, 3, 16)} == {"und"}
    assert all(0 <= r.score <= 1 for r in found.values())
    assert identify(empty).count() == 0
    codes, counts = grams("Ab, ab")
    text = {"".join(chr((c >> s) & 0x1FFFFF) for s in (42, 21, 0) if c >> s): n for c, n in zip(codes.tolist(), counts.tolist())}
    assert text == {"a": 2, "b": 2, " a": 2, "ab": 2, "b ": 2, " ab": 2, "ab ": 2}
    assert len(ranked(codes, counts)) == 7
    if os.path.isdir(SF_DIR):
        real = identify(spark.read.parquet(f"{SF_DIR}/documents.parquet")).where("held_out")
        right = real.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
        assert right > 0.95


def test_languages_are_whole(spark, monkeypatch):
    texts = ["Ab, ab", prose(5, 40), "x" * 50, "  \n ", "a  b c  ", "12 été 日本語 " * 9, ""]
    plain = [[part.tolist() for part in grams(text)] for text in texts]
    for piece in (1, 2, 3, 7):
        monkeypatch.setattr(language, "_PIECE", piece)
        assert [[part.tolist() for part in grams(text)] for text in texts] == plain
    monkeypatch.undo()
    many = spark.range(1005).selectExpr("id AS doc_id", "'some text' AS text", "concat('l', id) AS lang")
    assert len(language.fit_profiles(many)) == 1005
    # The rows with the smallest hashes, whatever groups they are picked from.
    frame = spark.range(400).selectExpr(
        "id AS doc_id", "concat(repeat(chr(97 + id % 26), 3), ' ', chr(65 + id % 23)) AS text", "'en' AS lang"
    )
    first = frame.orderBy(F.xxhash64("doc_id")).limit(5)
    few, want = language.fit_profiles(frame, 5), language.fit_profiles(first)
    assert few["en"].tolist() == want["en"].tolist()


def test_every_small_error_is_hit():
    for count in range(MISSES + 1):
        for wrong in itertools.combinations(range(WINDOW), count):
            assert any(
                not {start + place for place in mask} & set(wrong)
                for mask in MASKS
                for start in range(WINDOW - mask[-1])
            )


def test_contamination(docs, empty, spark, monkeypatch):
    changed = prose(1, 70).split()[20:50]
    changed[4], changed[17] = "other", "another"
    items = [(0, " ".join(changed)), (1, None), (2, ""), (3, "w1 w2"), (None, prose(6, 40)),
             (4, "über straße 12 été"), (5, "released under the mit license cc by")]
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id bigint, text string, words int")
    for most in (500_000, 0):
        monkeypatch.setattr(contamination, "BROADCAST_SEEDS", most)
        found = {r.doc_id: r for r in contamination.contamination(docs, benchmark).collect()}
        assert {i for i, r in found.items() if r.contaminated} == {None, 4, 5, 6, 7, 8, 13}
        assert found[4]["items"] == "0" and found[7]["items"] == "" and found[13]["items"] == "5"
        assert (found[6].first_word, found[6].last_word) == (20, 49)
    left = contamination.without_contaminated(docs, benchmark)
    assert left.count() == len(rows()) - 8 and left.columns == docs.columns
    assert contamination.contamination(empty, benchmark).count() == 0
    none = spark.createDataFrame([], benchmark.schema)
    assert contamination.contamination(docs, none).where("contaminated").count() == 0


def test_licenses(docs, empty):
    found = {r.doc_id: r for r in license_scan(docs).collect()}
    assert (found[13].base_labels, found[13].labels) == ("apache-2,cc-by-nc,mit",) * 2
    assert (found[13].n_base, found[13].first_word, found[13].last_word) == (3, 1, 8)
    assert found[1].n_words == 0 and found[1].labels == "" and found[1].score == 0
    assert license_scan(empty).count() == 0


def test_wrapped_license_notices(spark):
    notices = {
        "mit": "/* Permission is hereby granted, free of charge, to any person obtaining\n"
        " * a copy of this software and associated documentation files (the\n"
        ' * "Software"), to deal in the Software without restriction */',
        "gpl": "# This program is free software: you can redistribute it and/or modify\n"
        "# it under the terms of the GNU General Public License as published by",
        "bsd": "Redistribution and use in source and binary forms, with or without\n"
        "modification, are permitted provided that the following conditions\nare met:",
        "apache-2": "you may not use this file except in compliance with the License.\n"
        "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/",
    }
    texts = [(label, f"{prose(1, 90)}\n{notice}\n{prose(2, 90)}") for label, notice in notices.items()]
    texts.append(("gpl", "This work is licensed under the GNU General Public License, version 3."))
    # The words of a template that stand far apart are no notice.
    scattered = "released under the mit license".replace(" ", "\n" + prose(3, 20) + "\n")
    texts.append(("", scattered))
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id bigint, text string")
    found = {r.doc_id: r.labels for r in license_scan(frame).collect()}
    assert found == {i: label for i, (label, _) in enumerate(texts)}


def test_tokens_match_the_tokenizer(docs, empty, monkeypatch):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    pieces = load_pieces()
    model = proto.ModelProto()
    with open("/opt/tokenizers/piece_bpe_32k.model", "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        if piece.piece in pieces.scores:
            piece.score = pieces.scores[piece.piece]
    tokenizer = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    counts = sorted(((r.doc_id, r.text, r.n_tokens) for r in with_token_counts(docs).collect()), key=repr)
    for frequent, block in ((1000, 256), (3, 4)):
        # A small block makes almost every word a long one.
        monkeypatch.setattr(encoding, "_BLOCK", block)
        encoded = encoding.encode_texts(docs, frequent=frequent)
        got = encoding.decode_ids(encoded).collect()
        for r in got:
            if r.text is None:
                assert r.ids is None and r.decoded is None
            elif len(r.text) < 3000:
                # Longer sums leave the range where the tokenizer's single precision is exact.
                assert list(r.ids) == tokenizer.encode(r.text), r.text
            assert r.round_trip
            assert r.decoded == (r.text and r.text.replace("▁", " "))
        assert sorted(((r.doc_id, r.text, len(r.ids or [])) for r in got), key=repr) == counts
    assert encoding.encode_texts(empty).count() == 0 and with_token_counts(empty).count() == 0
    assert words_of(None) == words_of("") == []


def test_a_lost_character_is_reported(spark):
    texts = [(0, "a b"), (1, "a\u2581b"), (2, ""), (3, None), (4, " \u2581"), (5, "日本 語")]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = encoding.decode_ids(encoding.encode_texts(frame)).collect()
    assert {r.doc_id: r.exact for r in got} == {i: "\u2581" not in (t or "") for i, t in texts}
    assert all(r.round_trip and r.exact == ((r.decoded or "") == (r.text or "")) for r in got)


def test_no_piece_crosses_a_cut():
    pieces = load_pieces()
    cutter, longest = Cutter(pieces), pieces.longest
    assert cutter.parts(None) == cutter.parts("") == []
    for text in (r[1] for r in rows() if r[1]):
        spaced = SPACE + text.replace(" ", SPACE)
        parts = cutter.parts(text)
        assert "".join(parts) == spaced and all(parts)
        for start in itertools.accumulate(map(len, parts[:-1])):
            around = range(max(0, start - longest), start)
            assert not any(
                spaced[a:b] in pieces.scores
                for a in around
                for b in range(start + 1, min(len(spaced), a + longest) + 1)
            )


def test_scores(docs, empty, monkeypatch):
    texts = [(d, [*words((t or "").lower()), ""]) for d, t, *_ in rows()]

    def held(doc):
        import zlib

        return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2

    train = Counter(w for d, t in texts if not held(d) for w in t)
    total, distinct = sum(train.values()), len(train)
    found = sorted((tuple(r) for r in scoring.language_scores(docs).collect()), key=repr)
    small = sorted((tuple(r) for r in scoring.language_scores(docs, share=0.01).collect()), key=repr)
    for got in (found, small):
        assert len(got) == len(texts)
        expected = sorted(
            (
                repr((d, held(d), len(t), sum(train[w] > 0 for w in t), total)),
                sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in t),
            )
            for d, t in texts
        )
        for (want, base), row in zip(expected, sorted(got, key=lambda r: (repr(r[:5]), r[5]))):
            assert repr(tuple(row[:5])) == want and row[5] == pytest.approx(base)
            assert row[6] < 0
    assert scoring.language_scores(empty).count() == 0


def test_scores_keep_rare_grams_of_a_large_corpus(spark):
    import zlib

    # 3.3 million tokens: an n-gram that occurs twice makes up less than 1e-6 of them.
    texts = [(i, "x y " * 50_000) for i in range(33)]
    texts += [(100 + i, f"{prose(21, 30)} x y {prose(22 + i, 20)}") for i in range(60)]
    texts += [(200, None), (201, "unseen words here"), (202, "only twice"), (203, "only twice")]
    tokens = {i: [w.encode() for w in words(t)] + [b""] for i, t in texts}
    train = [i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for i in train for w in tokens[i])
    listed = sorted(counts.items())
    known = {w: n for n, (w, _) in enumerate(listed)}
    ids = [np.array([len(known), *(known[w] for w in tokens[i])]) for i in train]
    orders = []
    for _ in range(2):
        keys, n = np.unique(
            np.concatenate([scoring._text_keys(i, orders) for i in ids]), return_counts=True
        )
        orders.append(scoring.Grams(keys[n >= 2], n[n >= 2]))
    total = sum(counts.values())
    automaton = scoring.Automaton(listed, orders, len(train), total, len(known))
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r for r in scoring.language_scores(frame).collect()}
    assert set(found) == set(tokens)
    for doc, parts in tokens.items():
        missing = automaton.unseen * sum(w not in known for w in parts)
        path = automaton.traverse([known.get(w, -1) for w in parts])
        assert found[doc].train_tokens == total
        assert found[doc].score == pytest.approx(path + missing)


def test_probabilities_add_up_in_every_state():
    rng = random.Random(4)
    texts = [[rng.randrange(6) for _ in range(rng.randrange(1, 12))] for _ in range(200)]
    words_ = [(b"", 200), *((f"w{i}".encode(), sum(t.count(i) for t in texts)) for i in range(6))]
    ids = [np.array([7, *(i + 1 for i in t), 0]) for t in texts]
    orders = []
    for _ in range(2):
        keys, n = np.unique(
            np.concatenate([scoring._text_keys(i, orders) for i in ids]), return_counts=True
        )
        orders.append(scoring.Grams(keys[n >= 2], n[n >= 2]))
    total = sum(n for _, n in words_)
    automaton = scoring.Automaton(words_, orders, 200, total, 7)
    mass = 1 / (total + 8)
    for state in range(len(automaton.failure)):
        seen = sum(10 ** automaton.lookup(state, w) for w in range(7))
        path, unseen = state, mass
        while path > 0:
            unseen *= 10 ** automaton.backoff[path]
            path = automaton.failure[path]
        if state != 1:  # nothing follows the end
            assert seen + unseen == pytest.approx(1)


def test_shards(docs, empty, spark):
    for limit in (500, 20_000, 10**9):
        got = sharding.with_shards(docs, ["doc_id"], ["text"], "text", limit).collect()
        sizes = Counter()
        for r in got:
            sizes[r.shard] += len((r.text or "").encode())
        assert len(got) == len(rows()) and set(docs.columns) <= set(got[0].asDict())
        names = sorted(sizes)
        assert not any(b.startswith(a) for a, b in itertools.combinations(names, 2))
        for r in got:
            assert r.shard_bytes == sizes[r.shard] and r.oversized == (sizes[r.shard] > limit)
            if r.oversized:
                texts = {x.text for x in got if x.shard == r.shard}
                assert len(r.shard) == sharding.BITS and len(texts) == 1
    hot = spark.range(500).selectExpr("1 AS k", "concat('text ', id) AS text")
    split = sharding.with_shards(hot, ["k"], ["text"], "text", 400).collect()
    assert max(r.shard_bytes for r in split) <= 400
    assert sharding.with_shards(empty, ["doc_id"], ["text"], "text").count() == 0
