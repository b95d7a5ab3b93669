"""Columns with the operators' own names, notices against the oracle SQL, profiles by brute force."""

import random
import re
import zlib
from collections import Counter

import duckdb
from oracle import difference

import sluice.llm.queries  # noqa: F401
from sluice.llm import contamination, encoding, minhash, sharding, substrings
from sluice.llm.language import SIZE, UNKNOWN, identify
from sluice.llm.licenses import license_scan
from sluice.llm.registry import ORACLE


def prose(seed, count, vocabulary=400):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(count))


def test_columns_with_working_names_are_kept(spark):
    names = ["_bits", "_size", "_used", "_rare", "_key", "_packed", "_doc", "_gone", "_own0", "_OWN1"]
    passage = prose(1, 70)
    texts = [passage, prose(2, 80) + " " + passage, prose(3, 90), None, "", passage]
    frame = spark.createDataFrame(
        [(n, text, *(f"{name}{n}" for name in names)) for n, text in enumerate(texts)],
        "doc_id bigint, text string, " + ", ".join(f"{name} string" for name in names),
    )
    items = spark.createDataFrame([(0, prose(3, 90))], "item_id bigint, text string")
    results = {
        "sharding": sharding.with_shards(frame, ["doc_id"], ["text"], "text", limit=200),
        "groups": minhash.one_per_group(frame),
        "passages": substrings.without_repeats(frame),
        "contamination": contamination.without_contaminated(frame, items),
        "encoding": encoding.encode_texts(frame),
    }
    left = {"groups": {0, 1, 2, 3, 4}, "contamination": {0, 1, 3, 4, 5}}
    for label, result in results.items():
        assert set(names) <= set(result.columns), label
        found = result.collect()
        assert {r.doc_id for r in found} == left.get(label, set(range(6))), label
        for row in found:
            assert all(row[name] == f"{name}{row.doc_id}" for name in names), label


def test_license_sql_states_notices_over_several_lines(spark):
    notices = [
        "/* Permission is hereby granted, free of charge, to any person obtaining\n"
        " * a copy of this software and associated documentation files (the\n"
        ' * "Software"), to deal in the Software without restriction */',
        "# This program is free software: you can redistribute it and/or modify\n"
        "# it under the terms of the GNU General Public License as published by",
        "Redistribution and use in source and binary forms, with or without\n"
        "modification, are permitted provided that the following conditions\nare met:",
        "released under the mit license".replace(" ", "\n" + prose(3, 20) + "\n"),
        "Released under the\nMIT License",
    ]
    texts = [f"{prose(1, 90)}\n{notice}\n{prose(2, 90)}" for notice in notices] + ["", None, "the"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    connection = duckdb.connect()
    documents = frame.toPandas()  # noqa: F841
    connection.execute("CREATE TABLE documents AS SELECT * FROM documents")
    found = license_scan(frame)
    assert difference(found, connection, ORACLE["op8_license_scan"]) is None
    assert {r.doc_id for r in found.collect() if r.labels} == {0, 1, 2, 4}


def plain_grams(text):
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    letters = re.sub(" +", " ", f" {letters} ")
    if letters == " ":
        return Counter()
    found = Counter(c for c in letters if c != " ")
    found.update(letters[n : n + 2] for n in range(len(letters) - 1))
    found.update(letters[n : n + 3] for n in range(len(letters) - 2) if letters[n + 1] != " ")
    return found


def plain_ranks(counts):
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:SIZE]


def test_languages_match_brute_force(spark):
    pick = random.Random(4)
    letters = {"aa": "abcdefg", "bb": "bcdefghi", "cc": "äöüabc", "dd": "abcdefg"}
    rows = [(None, "abc bcd", "aa"), (900, None, "aa"), (901, "", "bb"), (902, "12 !!", None)]
    for n in range(60):
        lang = sorted(letters)[n % 4]
        text = " ".join(
            "".join(pick.choice(letters[lang]) for _ in range(pick.randrange(1, 6)))
            for _ in range(pick.randrange(1, 40))
        )
        rows.append((n, text + pick.choice(["", "\n", " 7x", ". Ä"]), lang if n % 9 else None))
    rows += rows[10:14]
    totals = {}
    for doc, text, lang in rows:
        if lang is not None and text is not None and (doc is None or zlib.crc32(b"%d" % doc) % 4 != 2):
            totals.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {lang: {g: n for n, g in enumerate(plain_ranks(c))} for lang, c in totals.items()}
    expected = []
    for doc, text, _ in rows:
        own, best = plain_ranks(plain_grams(text)), (UNKNOWN, 0.0)
        if own:
            apart = {
                lang: sum(abs(ranks[g] - n) if g in ranks else SIZE for n, g in enumerate(own))
                for lang, ranks in profiles.items()
                if ranks
            }
            lang = min(sorted(apart), key=apart.__getitem__)
            best = (lang, round(1 - apart[lang] / (SIZE * len(own)), 9))
        expected.append((doc, doc is not None and zlib.crc32(b"%d" % doc) % 4 == 2, *best))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = [
        (r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in identify(frame).collect()
    ]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
