"""Language identification by rank-order profiles of character n-grams.

A text is lower-cased, everything but letters becomes a space, and n-grams of one to three
characters are counted inside words and over word borders. The ``SIZE`` most frequent n-grams, ties
by code points, are its profile. A language's profile is that of its training texts together. The
distance of a text to a language adds up, over the text's n-grams, how far apart the two ranks are,
or ``SIZE`` where the language lacks the n-gram; the nearest language wins, ties by name.

Profiles are fitted on at most ``FIT_ROWS`` labelled texts of a language, those with the smallest
hashes of their ids, and for all languages; prediction reads whole texts of all rows. Null texts and texts without a letter are ``und`` with score 0, as is every
text if nothing was learned. Repeated rows are predicted alike; a null lang is never learned from.
Other columns pass through, those with a name of an added column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import bucket, mapped, staged

SIZE = 300
FIT_ROWS = 2000
#: A language's rows are picked from in so many groups, from step to step in fewer.
_GROUPS = (64, 8, 1)
UNKNOWN = "und"
_PIECE = 1 << 20
_BITS = 21
_SPACE = np.int64(32)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(
            np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        )
    return _LETTERS[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, as packed code points in order, and their counts."""
    found, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if not text:
        return found, counts
    text = text.lower()
    # The last two characters of a piece begin the n-grams that end in the next one.
    before = np.array([_SPACE])
    for start in range(0, len(text), _PIECE):
        piece = text[start : start + _PIECE]
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = codes.astype(np.int64)
        codes[~_letters()[codes]] = _SPACE
        if start + _PIECE >= len(text):
            codes = np.append(codes, _SPACE)
        codes = np.concatenate([before, codes])
        blank = codes == _SPACE
        codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))]
        old = len(before)
        if len(codes) == old:
            continue
        blank = codes == _SPACE
        pairs = (codes[:-1] << _BITS) | codes[1:]
        triples = (pairs[:-1] << _BITS) | codes[2:]
        triples[blank[1:-1]] = -1
        triples = triples[max(0, old - 2) :]
        every = np.concatenate([codes[old:][~blank[old:]], pairs[old - 1 :], triples[triples >= 0]])
        before = codes[-2:]
        one, n = np.unique(every, return_counts=True)
        if len(found):
            both = np.concatenate([found, one])
            found, place = np.unique(both, return_inverse=True)
            counts = np.bincount(place, weights=np.concatenate([counts, n])).astype(np.int64)
        else:
            found, counts = one, n
    return found, counts


def ranked(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams in order of rank."""
    return found[np.argsort(-counts, kind="stable")[:SIZE]]


def fit_profiles(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> dict[str, np.ndarray]:
    """A ranked profile for each language of ``labelled(doc_id, text, lang)``."""
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    picked = known.select("doc_id", F.xxhash64("text").alias("key"), "lang").withColumn(
        "hash", F.xxhash64("doc_id", "key")
    )
    for groups in _GROUPS:
        # What is not among the first of its group is not among the first of the language.
        order = Window.partitionBy("lang", F.pmod("hash", F.lit(groups))).orderBy(
            F.xxhash64("doc_id"), "doc_id", "key"
        )
        picked = picked.withColumn("place", F.row_number().over(order)).where(
            F.col("place") <= fit_rows
        )
    picked = staged(picked.select("doc_id", "key", "lang").distinct(), "fit")
    chosen = known.select("doc_id", "text", "lang", F.xxhash64("text").alias("key"))
    sample = chosen.alias("t").join(
        picked.alias("p"),
        F.expr("t.doc_id <=> p.doc_id AND t.key = p.key AND t.lang = p.lang"),
        "left_semi",
    )

    def rows(batch: pa.RecordBatch):
        langs, out, counts = [], [], []
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            found, n = grams(text)
            langs.extend([lang] * len(found))
            out.append(found)
            counts.append(n)
        empty = np.zeros(0, dtype=np.int64)
        yield {
            "lang": langs,
            "gram": np.concatenate([empty, *out]),
            "n": np.concatenate([empty, *counts]),
        }

    totals = (
        mapped(sample.select("lang", "text"), rows, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranks = (
        totals.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= SIZE)
        .orderBy("lang", "place")
        .collect()
    )
    profiles: dict[str, list[int]] = {}
    for row in ranks:
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return {lang: np.array(listed, dtype=np.int64) for lang, listed in profiles.items()}


def nearest(text: str | None, profiles: dict[str, tuple]) -> tuple[str, float]:
    """The language with the smallest out-of-place distance, and its closeness from 0 to 1."""
    own = ranked(*grams(text))
    if not len(own) or not profiles:
        return UNKNOWN, 0.0
    places = np.arange(len(own))
    best, least = UNKNOWN, None
    for lang, (codes, ranks) in profiles.items():
        at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        apart = np.where(codes[at] == own, np.abs(ranks[at] - places), SIZE)
        distance = int(apart.sum())
        if least is None or distance < least:
            best, least = lang, distance
    return best, 1.0 - least / (SIZE * len(own))


def with_language(docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """``docs`` with lang_pred and score."""
    prepared = {}
    for lang in sorted(profiles):
        order = np.argsort(profiles[lang])
        prepared[lang] = (profiles[lang][order], order)
    kept = docs.drop("lang_pred", "score")
    names = kept.columns
    types = ", ".join([*(f"`{n}` {t}" for n, t in kept.dtypes), "lang_pred string, score double"])

    def rows(batch: pa.RecordBatch):
        found = [nearest(text, prepared) for text in batch["text"].to_pylist()]
        yield {
            **{name: batch[name] for name in names},
            "lang_pred": [f[0] for f in found],
            "score": [f[1] for f in found],
        }

    return mapped(kept, rows, types)


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` with held_out, lang_pred and score, learned from the rows not held out."""
    marked = docs.withColumn("held_out", bucket("doc_id", 4) == 2)
    return with_language(marked, fit_profiles(marked.where("NOT held_out")))
