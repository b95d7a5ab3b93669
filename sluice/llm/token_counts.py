"""Token counts of texts by a Viterbi search that keeps only scores and counts.

Within a word (see ``pieces``) an Aho-Corasick automaton of the vocabulary enumerates, for every end
position, all pieces that end there, longest first. The search carries for each position the best
score and the number of pieces of the path that has it. Ties go, as in the tokenizer, to the path
that reached the position first, which is the one whose last piece starts earliest. A character
without a piece of its own counts one token for each of its bytes.

Null and empty texts have no tokens. Words are cut exactly, so a text costs time in proportion to its
length and memory for one word at a time; counts of words are kept in a table that is emptied when
it has ``REMEMBERED`` entries. Other columns pass through; one named ``n_tokens`` is replaced.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.common import mapped
from sluice.llm.pieces import MODEL, Pieces, load_pieces, words_of

REMEMBERED = 300_000


class Counter:
    def __init__(self, pieces: Pieces):
        self.unknown = pieces.unknown
        self.single = {p for p in pieces.scores if len(p) == 1}
        self.known: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()

    def word(self, word: str) -> int:
        best = [0.0] + [float("-inf")] * len(word)
        count = [0] * (len(word) + 1)
        done = 0

        def fill(upto: int) -> None:
            # Characters without a piece; every position up to ``upto`` gets its final value.
            nonlocal done
            while done < upto:
                if word[done] not in self.single:
                    score = best[done] + self.unknown
                    if score > best[done + 1]:
                        best[done + 1] = score
                        count[done + 1] = count[done] + len(word[done].encode("utf-8", "replace"))
                done += 1

        for last, (size, score) in self.automaton.iter(word):
            fill(last)
            start, end = last + 1 - size, last + 1
            score += best[start]
            if score > best[end]:
                best[end], count[end] = score, count[start] + 1
        fill(len(word))
        return count[-1]

    def text(self, text: str | None) -> int:
        total = 0
        known = self.known
        for word in words_of(text):
            tokens = known.get(word)
            if tokens is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                tokens = known[word] = self.word(word)
            total += tokens
        return total


def with_token_counts(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``docs`` with ``n_tokens``, the number of tokens of ``text``."""
    # As large as the vocabulary file.
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model))
    kept = docs.drop("n_tokens")
    names = kept.columns
    held: list[Counter] = []

    def rows(batch: pa.RecordBatch):
        if not held:
            held.append(Counter(shared.value))
        counts = [held[0].text(text) for text in batch["text"].to_pylist()]
        yield {**{name: batch[name] for name in names}, "n_tokens": counts}

    types = ", ".join([*(f"`{n}` {t}" for n, t in kept.dtypes), "n_tokens bigint"])
    return mapped(kept, rows, types)
