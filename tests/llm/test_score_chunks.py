"""Language scores do not depend on chunks and ranges, and need little disk."""

import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from sluice.llm import scoring
from sluice.session import shared_dir


def prose(seed, count, vocabulary):
    pick = random.Random(seed)
    return " ".join(f"w{int(vocabulary ** pick.random())}" for _ in range(count))


def size(folder):
    return sum(os.path.getsize(f"{d}/{n}") for d, _, names in os.walk(folder) for n in names)


def expected(texts, order):
    """Scores by the automaton in one process."""
    tokens = [[*(t or "").lower().encode().split(), b""] for _, t in texts]
    train = [n for n, (d, _) in enumerate(texts) if zlib.crc32(str(d).encode()) % 7 != 2]
    counts = Counter(w for n in train for w in tokens[n])
    listed = sorted(counts.items())
    known = {w: n for n, (w, _) in enumerate(listed)}
    ids = [np.array([len(known), *(known[w] for w in tokens[n])]) for n in train]
    orders = []
    for _ in range(order - 1):
        keys, n = np.unique(
            np.concatenate([scoring._text_keys(i, orders) for i in ids]), return_counts=True
        )
        orders.append(scoring.Grams(keys[n >= 2], n[n >= 2]))
    automaton = scoring.Automaton(listed, orders, len(train), sum(counts.values()), len(known))
    return {
        d: automaton.traverse([known.get(w, -1) for w in t])
        + automaton.unseen * sum(w not in known for w in t)
        for (d, _), t in zip(texts, tokens)
    }


@pytest.mark.parametrize("order", (2, 3, 4))
def test_scores_in_small_chunks(spark, monkeypatch, order):
    texts = [(n, prose(n % 50, 60 + n, 90)) for n in range(120)]
    texts += [(200, None), (201, ""), (202, " \n "), (203, "Unseen WORDS here"), (204, "x" * 5000)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    wanted = expected(texts, order)
    for chunk, row, part in ((14 << 20, 1 << 20, 12 << 20), (4000, 900, 2500), (1, 1, 700)):
        for name, value in (("CHUNK", chunk), ("ROW", row), ("PART", part)):
            monkeypatch.setattr(scoring, name, value)
        found = scoring.language_scores(frame, order=order).collect()
        assert len(found) == len(texts)
        for r in found:
            assert r.score == pytest.approx(wanted[r.doc_id]), (r.doc_id, chunk)


def test_score_tables_are_smaller_than_the_texts(spark):
    texts = [(n, prose(n, 3000, 20_000)) for n in range(150)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(2)
    folder = shared_dir(spark).removeprefix("file:")
    before = size(folder)
    assert scoring.language_scores(frame).count() == len(texts)
    # One row for each n-gram of a chunk, with the names of its parts, took several times the texts.
    assert size(folder) - before < sum(len(t) for _, t in texts)
