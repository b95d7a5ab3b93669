"""The last step of the search for near duplicates: rows meet in blocks, not as pairs."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import minhash


def _family(count: int) -> list[str]:
    """Copies of one text with words replaced from a short list, so few shingles are a row's own."""
    rand = random.Random(5)
    template = [f"w{n}" for n in range(60)]
    texts = []
    for _ in range(count):
        words = list(template)
        for place in rand.sample(range(60), rand.choice([2, 4, 5, 6])):
            words[place] = f"e{rand.randrange(4)}"
        texts.append(" ".join(words))
    return texts


def _brute(sets: dict[int, frozenset]) -> dict[int, int]:
    label = {i: i for i in sets}
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
            low, high = sorted((label[a], label[b]))
            label = {i: low if v == high else v for i, v in label.items()}
    return label


@pytest.mark.parametrize("block", [16, 512])
def test_components_equal_all_pairs_and_no_pairs_are_sent(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    sent = []
    linked = minhash._Candidates.linked

    def counted(self, pairs):
        sent.append(pairs.distinct().count())
        return linked(self, pairs)

    monkeypatch.setattr(minhash._Candidates, "linked", counted)
    texts = _family(160)
    words = [text.split() for text in texts]
    sets = {n: frozenset(zip(w, w[1:])) for n, w in enumerate(words)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = minhash.near_duplicate_groups(docs, words=2, percent=80).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == _brute(sets)
    assert 10 < len({r["component_id"] for r in found}) < 150
    # Pairs are sent for centres and pivots only; what is left meets in blocks.
    assert len(sent) == 2


def test_common_values_of_pairs(monkeypatch):
    monkeypatch.setattr(minhash, "_SLICE", 64)
    monkeypatch.setattr(minhash, "_PAIRS", 7)
    rand = np.random.default_rng(3)
    rows = [rand.choice(400, rand.integers(0, 120), replace=False) for _ in range(30)]
    left, right = np.array(list(combinations(range(30), 2))).T
    lengths = np.array([len(row) for row in rows])
    found = minhash._common(np.concatenate(rows), lengths, left, right)
    assert found.tolist() == [
        len(np.intersect1d(rows[a], rows[b])) for a, b in zip(left, right)
    ]


def test_a_block_returns_the_links_its_components_need():
    """Four equal rows of four components, all in one band: three links, not six or twelve."""
    both = [(n, out) for out in (True, False) for n in range(4)]
    group = pa.table(
        {
            "doc_id": [n for n, _ in both], "part": [n for n, _ in both], "outside": [o for _, o in both],
            "size": [5] * 8, "shared": [5] * 8, "bands": [[1, 10 + n] for n, _ in both],
            "shingles": [[1, 2, 3, 4, 5]] * 8,
        }
    )
    assert minhash._block_links(80)(group).num_rows == 3
