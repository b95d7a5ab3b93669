"""Scan of texts for license notices: fixed phrases, and an exact set-similarity join.

Words are runs of letters, digits and non-ASCII characters after lower-casing A-Z. A phrase counts
wherever its words stand one after the other. Beyond the phrases, every text block is compared with
every template as a set of words: a template's label is given where the block contains at least
``CONTAINMENT`` of the template's distinct words. Blocks are the lines and, as notices are usually
wrapped, the runs of words over line ends that are ``SLACK`` times as long as the template. Every
run that begins with a template word is taken; others hold no more template words than one of these.

The join is exact. Template words are ordered by the number of blocks that contain them, rarest
first. To hold ``need`` of a template's words, a block must hold one of its first
``size - need + 1``, and that word must be among the block's own first ``words - need + 1`` template
words: both prefixes are joined on the word, too short blocks are left out (length filter), and a
pair goes on only if the words after the two positions could still reach ``need`` (positional
filter). Survivors are verified on their whole sets.

Null and empty texts have no words, no labels and score 0. Repeated rows get the same result.
``score`` is 1 for a text with a phrase, else the largest containment that reached the threshold,
else 0. Other columns are left out; the result has one row per input row.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import mapped, staged, text_bytes

#: The phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Opening words of the notices that the licenses ask for.
TEMPLATES = (
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files to deal in the software without restriction",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    (
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy "
        "of the license at apache org",
    ),
    ("gpl", "licensed under the gnu general public license version"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial license"),
    ("cc-by-nc", "content licensed under cc by nc"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
)
CONTAINMENT = 0.9
#: Words of a run for each word of the template: room for comment marks and changed words.
SLACK = 1.25

_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_TABLE = bytes(
    low if low in _KEEP else 0x20 for low in (bytes([b]).lower()[0] for b in range(256))
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _vocabulary(templates) -> list[str]:
    return sorted({word for _, text in templates for word in text.split()})


def word_order(texts: DataFrame, templates) -> list[str]:
    """Template words, rarest first by the number of blocks (lines) that contain them."""
    vocabulary = {word.encode() for word in _vocabulary(templates)}

    def rows(batch: pa.RecordBatch):
        seen: Counter = Counter()
        for text in text_bytes(batch["text"]):
            for line in (text or b"").split(b"\n"):
                seen.update(vocabulary.intersection(words_of(line)))
        yield {"word": [w.decode() for w in seen], "n": list(seen.values())}

    counts = mapped(texts.select("text"), rows, "word string, n bigint")
    # At most one row for each word of the templates.
    found = {r["word"]: r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return sorted(_vocabulary(templates), key=lambda w: (found.get(w, 0), w))


def _index(templates, order: list[str], containment: float) -> list[tuple]:
    """(word, template, label, position, size, need, words, run) of every prefix word."""
    rank = {word: place for place, word in enumerate(order)}
    rows = []
    for number, (label, text) in enumerate(templates):
        words = sorted(set(text.split()), key=rank.__getitem__)
        need = math.ceil(containment * len(words) - 1e-9)
        run = math.ceil(SLACK * len(text.split()))
        for position, word in enumerate(words[: len(words) - need + 1]):
            rows.append((word, number, label, position, len(words), need, words, run))
    return rows


def _runs(words: list[bytes], vocabulary: set[bytes], width: int, least: int):
    """Sets of at least ``least`` template words of the runs that begin with one."""
    places = [place for place, word in enumerate(words) if word in vocabulary]
    counts: Counter = Counter()
    end, fresh = 0, False
    for first, place in enumerate(places):
        while end < len(places) and places[end] < place + width:
            counts[words[places[end]]] += 1
            end, fresh = end + 1, True
        # A run without a new word is a part of the one before it.
        if fresh and len(counts) >= least:
            yield frozenset(counts)
        fresh = False
        counts[words[place]] -= 1
        if not counts[words[place]]:
            del counts[words[place]]


def _scan(order: list[str], index: list[tuple]):
    """Word counts, phrase places, and the template words of blocks that hold a prefix word."""
    rank = {word.encode(): place for place, word in enumerate(order)}
    vocabulary, prefixes = set(rank), {row[0].encode() for row in index}
    shortest = min((row[5] for row in index), default=1)
    needs: dict[int, int] = {}
    for row in index:
        needs[row[7]] = min(row[5], needs.get(row[7], row[5]))
    phrases = [(phrase.encode().split(), label) for phrase, label in PHRASES.items()]

    def places(words: list[bytes]):
        known = set(words)
        for phrase, label in phrases:
            if known.issuperset(phrase):
                for start in range(len(words) - len(phrase) + 1):
                    if words[start : start + len(phrase)] == phrase:
                        yield start, label

    def rows(batch: pa.RecordBatch):
        out: dict = {n: [] for n in ("n_words", "n_base", "first_word", "last_word", "base", "blocks")}
        for text in text_bytes(batch["text"]):
            words = words_of(text or b"")
            found = list(places(words))
            blocks = []
            if not prefixes.isdisjoint(words):
                for line in text.split(b"\n"):
                    held = vocabulary.intersection(words_of(line))
                    if len(held) >= shortest and not prefixes.isdisjoint(held):
                        blocks.append((0, held))
                whole = vocabulary.intersection(words)
                for width, least in needs.items():
                    if len(whole) >= least and b"\n" in text:
                        runs = set(_runs(words, vocabulary, width, least))
                        blocks += [(width, run) for run in runs if not prefixes.isdisjoint(run)]
            out["n_words"].append(len(words))
            out["n_base"].append(len(found))
            out["first_word"].append(min((f[0] for f in found), default=None))
            out["last_word"].append(max((f[0] for f in found), default=None))
            out["base"].append(sorted({f[1] for f in found}))
            out["blocks"].append(
                [
                    {"run": run, "words": [w.decode() for w in sorted(held, key=rank.__getitem__)]}
                    for run, held in blocks
                ]
            )
        yield {"doc_id": batch["doc_id"], "key": batch["key"], **out}

    return rows


def license_scan(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT):
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    order = word_order(texts, templates)
    index = _index(templates, order, containment)
    scanned = staged(
        mapped(
            texts,
            _scan(order, index),
            f"doc_id {dict(docs.dtypes)['doc_id']}, key bigint, n_words bigint, n_base bigint, "
            "first_word bigint, last_word bigint, base array<string>, "
            "blocks array<struct<run:int,words:array<string>>>",
        ),
        "licenses",
    )
    prefixes = spark.createDataFrame(
        index,
        "word string, template int, label string, at int, size int, need int, "
        "template_words array<string>, width int",
    )
    blocks = scanned.where(F.size("blocks") > 0).select(
        "doc_id", "key", F.inline("blocks")
    ).distinct()
    joined = (
        blocks.select("*", F.posexplode("words").alias("place", "word"))
        # The index has at most one row for each word of the given templates.
        .join(F.broadcast(prefixes), "word")
        # Lines are compared with every template, runs with templates of their length.
        .where("run IN (0, width)")
        .where(F.size("words") >= F.col("need"))
        .where(F.col("place") <= F.size("words") - F.col("need"))
        .where(
            F.least(F.size("words") - F.col("place"), F.col("size") - F.col("at")) >= F.col("need")
        )
    )
    both = F.size(F.array_intersect("words", "template_words"))
    verified = joined.withColumn("both", both).where("both >= need")
    labelled = verified.groupBy("doc_id", "key").agg(
        F.collect_set("label").alias("more"), F.max(F.col("both") / F.col("size")).alias("best")
    )
    return (
        scanned.alias("s")
        .join(labelled.alias("l"), F.expr("s.doc_id <=> l.doc_id AND s.key = l.key"), "left")
        .select(
            "s.doc_id", "n_words", "n_base", "first_word", "last_word",
            F.array_join("base", ",").alias("base_labels"),
            F.array_join(
                F.array_sort(
                    F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))
                ),
                ",",
            ).alias("labels"),
            F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        )
    )
