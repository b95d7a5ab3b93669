"""Language-model scores of texts by a weighted backoff automaton.

Words are runs of bytes other than space and 0x09-0x0D after lower-casing A-Z; every text ends with
one more token. The n-grams of the training texts are smoothed by absolute discounting, with add-one
unigrams below them, and become the states of an automaton: a kept n-gram below the highest order is
a state, its continuations are weighted arcs, and a failure arc with the backoff weight leads to the
state of its longest shorter suffix. A text is scored in one traversal from left to right that
carries the state and adds up log10 weights.

Word counts cover all training texts and all words. N-grams are kept from ``LEAST`` occurrences, at
every size of the corpus, so no model of a bounded size could be broadcast. It is a set of tables
instead. The weight of a traversal is a sum over the n-grams of the text: a word adds its unigram
weight and its backoff; a longer kept n-gram adds what its arc weighs more than the arc of the next
shorter one and the backoff that it spares, and its own backoff. So each n-gram has one value, and
every chunk of texts gets the values of its different n-grams. ``Automaton`` is the same model in one
process. N-grams are named by 64-bit hashes.

Chunks meet the tables by ranges of names. A chunk of ``CHUNK`` bytes sends its sorted names with their
occurrences to the ranges, as differences, which costs about 6 bytes an n-gram; a range adds up and
replies to each chunk in the order of its names, so that replies need no names. Longer n-grams are
sent once the shorter ones are counted, and only where both of these are kept. For backoff weights,
contexts go the same way by their numbers within the range; one of the chunks with an n-gram adds it to
its context. Shuffle files are deleted as soon as a table is written.

Null and empty texts consist of the end token. Null ids belong to the training texts. Repeated rows
are learned from and scored one by one. Without training tokens every probability is one. Other
columns are left out; the result has one row per input row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sluice.llm.common import (
    bucket,
    flat,
    mixed,
    staged,
    text_bytes,
    word_hashes,
    words_between,
)

ORDER = 3
#: Occurrences from which an n-gram is kept, whatever the size of the corpus.
LEAST = 2
#: Bytes of text in one chunk, which one task holds with its n-grams; ``_ROW_BYTES`` more for each row.
CHUNK = 14 << 20
_ROW_BYTES = 16
#: Bytes of text in one row of the table of chunks, so that no row is large.
ROW = 1 << 20
#: Bytes of text for which there is one range of names.
PART = 12 << 20
DISCOUNT = 0.5
#: No word is empty, so the end token can be; texts begin in the state of ``BEGIN``.
END = b""
_WORD_BITS = 32
_END_HASH, _BEGIN_HASH = np.uint64(1), np.uint64(2)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Columns that travel as differences.
_RISING = ("names", "ranks")
_NO_RANKS = np.zeros(0, dtype=np.uint32)


def tokens_of(text: bytes | None) -> list[bytes]:
    return [*(text or b"").lower().split(), END]


@dataclass
class Grams:
    """Kept n-grams of one order: sorted keys (state of the context, word) and their counts."""

    keys: np.ndarray
    counts: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


def _text_keys(ids: np.ndarray, orders: list[Grams]) -> np.ndarray:
    """Keys of the text's n-grams one order above the highest of ``orders``.

    ``ids`` are word ids behind the id of the beginning; -1 is a word without one.
    """
    ends = ids
    for grams in [*orders, None]:
        before, word = ends[:-1], ids[len(ids) - len(ends) + 1 :]
        keys = np.where((before >= 0) & (word >= 0), (before << _WORD_BITS) | word, -1)
        if grams is None:
            return keys[keys >= 0]
        ends = grams.find(keys)
        ends[keys < 0] = -1
    raise AssertionError


class Automaton:
    """States 0 (nothing known), then words and the beginning, then longer n-grams."""

    def __init__(self, words: list[tuple[bytes, int]], orders: list[Grams], texts: int,
                 total: int, distinct: int):
        self.ids = {word: number for number, (word, _) in enumerate(words)}
        self.begin = len(words)
        mass = total + distinct + 1
        self.unseen = math.log10(1 / mass)
        self.unigram = [math.log10((count + 1) / mass) for _, count in words]
        state_counts = [0, *(count for _, count in words), texts]
        self.failure = [-1] + [0] * (len(words) + 1)
        self.arcs: dict[int, int] = {}
        self.weights: list[float] = []
        self.targets: list[int] = []
        self.backoff = [0.0]
        first = 1
        for grams in orders:
            # The states of this order's contexts are numbered from ``first``.
            self._add(grams, first, state_counts, last=grams is orders[-1])
            first = len(state_counts) - len(grams.keys)
        self.backoff += [0.0] * (len(state_counts) - len(self.backoff))

    def _add(self, grams: Grams, first: int, state_counts: list[int], last: bool) -> None:
        fresh = len(state_counts)
        taken: dict[int, list[float]] = {}
        mask = (1 << _WORD_BITS) - 1
        for place, (key, count) in enumerate(zip(grams.keys.tolist(), grams.counts.tolist())):
            context, word = first + (key >> _WORD_BITS), key & mask
            probability = (count - DISCOUNT) / state_counts[context]
            lower = self.lookup(self.failure[context], word)
            sums = taken.setdefault(context, [0.0, 0.0])
            sums[0] += probability
            sums[1] += 10.0**lower
            self.arcs[(context << _WORD_BITS) | word] = len(self.weights)
            self.weights.append(math.log10(probability))
            shorter = self._after(self.failure[context], word)
            if last:
                self.targets.append(shorter)
            else:
                self.targets.append(fresh + place)
                self.failure.append(shorter)
        if not last:
            state_counts.extend(grams.counts.tolist())
        self.backoff += [0.0] * (fresh - len(self.backoff))
        for context, (own, lower) in taken.items():
            self.backoff[context] = math.log10(max(1 - own, 1e-12) / max(1 - lower, 1e-12))

    def _after(self, state: int, word: int) -> int:
        """The state behind ``word``: that of the longest kept n-gram that ends with it."""
        while state > 0:
            arc = self.arcs.get((state << _WORD_BITS) | word)
            if arc is not None:
                return self.targets[arc]
            state = self.failure[state]
        return 1 + word

    def lookup(self, state: int, word: int) -> float:
        """log10 probability of a known word in a state."""
        weight = 0.0
        while state > 0:
            arc = self.arcs.get((state << _WORD_BITS) | word)
            if arc is not None:
                return weight + self.weights[arc]
            weight += self.backoff[state]
            state = self.failure[state]
        return weight + self.unigram[word]

    def traverse(self, ids: list[int]) -> float:
        """log10 weight of a text, without the unigram weights of words that have no id (-1)."""
        arcs, weights, targets = self.arcs, self.weights, self.targets
        failure, backoff, unigram = self.failure, self.backoff, self.unigram
        state, total = 1 + self.begin, 0.0
        for word in ids:
            while state:
                if word >= 0:
                    arc = arcs.get((state << _WORD_BITS) | word)
                    if arc is not None:
                        total += weights[arc]
                        state = targets[arc]
                        break
                total += backoff[state]
                state = failure[state]
            else:
                if word >= 0:
                    total += unigram[word]
                    state = 1 + word
        return total


def _joined(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The names of n-grams from those of their first and their last words but one."""
    return mixed(before * _FACTOR + after)


def _pressed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, first the lowest byte of each; high bytes of zero cost nothing."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpressed(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


def _steps(values: np.ndarray) -> np.ndarray:
    """Rising numbers as their differences, which ``cumsum`` undoes."""
    return np.diff(values, prepend=values.dtype.type(0))


def _chunked(kind: pa.DataType):
    """Rows of texts as rows of ``ROW`` bytes, with the texts in one, and their chunks."""
    schema = pa.schema(
        [("chunk", pa.int64()), ("doc_id", pa.list_(kind)), ("held_out", pa.list_(pa.bool_())),
         ("sizes", pa.list_(pa.int32())), ("n_bytes", pa.int64()), ("body", pa.binary())]
    )

    def row(number: int, parts: list[pa.RecordBatch], texts: list[bytes]) -> pa.RecordBatch:
        def one(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        # Every text ends with a byte that no word has.
        body = b"\n".join([*texts, b""])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                *(one(pa.concat_arrays([p[n] for p in parts])) for n in ("doc_id", "held_out")),
                one(pa.array(map(len, texts), pa.int32())),
                pa.array([len(body)], pa.int64()),
                pa.array([zstandard.ZstdCompressor(level=3).compress(body)], pa.binary()),
            ],
            schema=schema,
        )

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        parts, texts, size, chunk_size = [], [], 0, 0
        for batch in batches:
            start = 0
            for place, text in enumerate(text_bytes(batch["text"]), 1):
                texts.append((text or b"").lower())
                size += len(texts[-1]) + _ROW_BYTES
                if size >= ROW:
                    yield row(number, [*parts, batch.slice(start, place - start)], texts)
                    chunk_size += size
                    start, parts, texts, size = place, [], [], 0
                    if chunk_size >= CHUNK:
                        number, chunk_size = number + 1, 0
            parts.append(batch.slice(start))
        if texts:
            yield row(number, parts, texts)

    return run


@dataclass
class Level:
    """The different n-grams of one order in a chunk; places are those of the n-grams' first words."""

    names: np.ndarray
    #: Where each n-gram occurs first, and the n-gram at every place of the chunk (-1: none).
    first: np.ndarray
    at: np.ndarray


@dataclass
class Known:
    """What a chunk knows of its n-grams of one order."""

    #: Occurrences, 0 for n-grams that are not kept.
    counts: np.ndarray
    #: Whether it is kept, with one more item for places without an n-gram (-1).
    kept: np.ndarray
    #: Whether the chunk is the one that adds the n-gram up.
    own: np.ndarray
    #: Its probability, and that of the next shorter n-gram.
    p: np.ndarray
    lower: np.ndarray | None = None


def _replied(replies: pa.Table, level: int, column: str, kind) -> list[np.ndarray]:
    """A chunk's replies of one level, by range of names."""
    own = replies.filter(pc.field("level") == level).select(["part", column])
    return [_unpressed(r[column], kind) for r in sorted(own.to_pylist(), key=lambda r: r["part"])]


@dataclass
class Model:
    """What a chunk has to know of the whole corpus, besides the replies to it."""

    #: All training tokens, and one more than them and the distinct ones.
    total: int
    mass: int
    #: Occurrences from which an n-gram is kept.
    least: float
    #: The highest order that ranges have counted.
    counted: int

    def known(self, number: int, levels: list[Level], below: list[Known], replies: pa.Table) -> Known:
        c = flat(_replied(replies, number, "body", np.int64), np.int64)
        own, c = c % 2 == 1, c // 2
        if number == 1:
            return Known(c, np.append(c > 0, False), own, (c + 1) / self.mass)
        c[c < self.least] = 0
        level, shorter, context = levels[-1], levels[-2], below[-1]
        before, after = shorter.at[level.first], shorter.at[level.first + 1]
        # Whatever is kept has contexts that occur as often at least.
        p = np.maximum(c - DISCOUNT, 0) / np.maximum(context.counts[before], 1)
        return Known(c, np.append(c > 0, False), own & (c > 0), p, context.p[after])


def _listed(chunk: pa.Table, column: str) -> pa.Array:
    """The values of a chunk's lists, one for each text."""
    return pa.concat_arrays([part.flatten() for part in chunk[column].chunks])


def _levels(chunk: pa.Table, order: int, model: Model | None = None, replies: pa.Table | None = None):
    """The n-grams of a chunk by order, what is known of them, and the text of every place.

    Texts are words between the beginning and the end. From three words on, only n-grams are looked
    up whose first and last words but one are kept; no other can occur often enough.
    """
    body = b"".join(map(zstandard.ZstdDecompressor().decompress, chunk["body"].to_pylist()))
    edges = np.append(0, np.cumsum(_listed(chunk, "sizes").to_numpy().astype(np.int64) + 1))
    lengths = words_between(body, edges) + 2
    ends = np.cumsum(lengths)
    names = np.empty(ends[-1], dtype=np.uint64)
    inner = np.ones(len(names), dtype=bool)
    inner[ends - 1] = inner[ends - lengths] = False
    names[inner] = word_hashes(body)
    names[ends - 1], names[ends - lengths] = _END_HASH, _BEGIN_HASH
    del body, inner
    text_of = np.repeat(np.arange(len(ends), dtype=np.int32), lengths)
    ends = ends.astype(np.int32)
    levels, known = [], []
    for number in range(1, order + 1):
        if number > 1:
            names = _joined(names[:-1], names[1:])
        own = np.arange(len(names), dtype=np.int32)
        own = own[own <= ends[text_of[: len(own)]] - number]
        if number > 2:
            kept = known[-1].kept[levels[-1].at]
            own = own[kept[own] & kept[own + 1]]
        own = own[np.argsort(names[own])]
        ordered = names[own]
        new = np.ones(len(own), dtype=bool)
        new[1:] = ordered[1:] != ordered[:-1]
        at = np.full(len(text_of), -1, dtype=np.int32)
        at[own] = np.cumsum(new, dtype=np.int32) - 1
        levels.append(Level(ordered[new], own[new], at))
        if model and len(known) < model.counted:
            known.append(model.known(number, levels, known, replies))
    return levels, known, text_of


def _parts(names: np.ndarray, parts: int) -> list[tuple[int, slice]]:
    """The ranges of names that have any of the ascending ones, and which."""
    part = ((names >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    edges = np.searchsorted(part, np.arange(parts + 1))
    return [(n, slice(a, b)) for n, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if a < b]


def _dealt(ordered: np.ndarray, parts: int, chunk: int, level: int, **columns: np.ndarray) -> dict:
    """One row a range of the ascending names, with its part of each column."""
    spans = _parts(ordered, parts)
    return {
        "part": [n for n, _ in spans],
        "level": [level] * len(spans),
        "chunk": [chunk] * len(spans),
        "size": [s.stop - s.start for _, s in spans],
        **{n: [_pressed(_steps(v[s]) if n in _RISING else v[s]) for _, s in spans]
           for n, v in columns.items()},
    }


_ASKED = pa.schema(
    [("part", pa.int64()), ("level", pa.int32()), ("chunk", pa.int64()), ("size", pa.int64()),
     ("names", pa.binary()), ("n", pa.binary())]
)


def _asked_of(chunk: pa.Table, level: Level, number: int, text_of: np.ndarray, parts: int) -> pa.Table:
    """The different n-grams of a chunk and their occurrences in training texts."""
    learned = ~_listed(chunk, "held_out").to_numpy(zero_copy_only=False).astype(bool)[text_of]
    own = level.at[learned & (level.at >= 0)]
    n = np.bincount(own, minlength=len(level.names)).astype(np.int32)
    number_of = chunk["chunk"][0].as_py()
    columns = _dealt(level.names, parts, number_of, number, names=level.names, n=n)
    return pa.table(columns, schema=_ASKED)


def _asked_first(order: int, parts: int):
    def rows(chunk: pa.Table) -> pa.Table:
        levels, _, text_of = _levels(chunk, min(order, 2))
        return pa.concat_tables(
            _asked_of(chunk, level, n, text_of, parts) for n, level in enumerate(levels, 1)
        )

    return rows


def _asked_next(model: Model, parts: int):
    def rows(replies: pa.Table, chunk: pa.Table) -> pa.Table:
        number = model.counted + 1
        levels, _, text_of = _levels(chunk, number, model, replies)
        return _asked_of(chunk, levels[-1], number, text_of, parts)

    return rows


def _counted(least: int, order: int):
    """Replies to the chunks: twice the occurrences of each n-gram and one more for one of its
    chunks, and the numbers of the kept ones, rising."""

    def rows(blocks: pa.Table) -> pa.Table:
        sizes, level = blocks["size"].to_pylist(), blocks["level"][0].as_py()
        edges = np.cumsum([0, *sizes])
        names = np.empty(edges[-1], dtype=np.uint64)
        n = np.empty(edges[-1], dtype=np.int32)
        for start, end, own, counts in zip(
            edges[:-1], edges[1:], blocks["names"].to_pylist(), blocks["n"].to_pylist()
        ):
            np.cumsum(_unpressed(own, np.uint64), out=names[start:end])
            n[start:end] = _unpressed(counts, np.int32)
        by_name = np.argsort(names)
        names = names[by_name]
        new = np.ones(len(names), dtype=bool)
        new[1:] = names[1:] != names[:-1]
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(n[by_name], starts, dtype=np.int64)
        word = (sums > 0) & (level == 1) & (names[starts] != _BEGIN_HASH)
        del names, n
        place = np.empty(len(by_name), dtype=np.int32)
        place[by_name] = np.cumsum(new, dtype=np.int32) - 1
        owner = np.zeros(len(by_name), dtype=bool)
        owner[by_name[starts]] = True
        del by_name, new
        kept = sums >= (least if level > 1 else 1)
        sums[~kept] = 0
        number = np.cumsum(kept, dtype=np.uint32)
        body, ranks = [], []
        for start, end in zip(edges[:-1], edges[1:]):
            own = place[start:end]
            body.append(_pressed(2 * sums[own] + owner[start:end]))
            ranks.append(_pressed(_steps(number[own[kept[own]]]) if level < order else _NO_RANKS))
        rest = [0] * (len(sizes) - 1)
        return pa.table(
            {
                **{n: blocks[n] for n in ("chunk", "level", "part")},
                "body": pa.array(body, pa.binary()),
                "ranks": pa.array(ranks, pa.binary()),
                "total": pa.array([int(sums[word].sum()), *rest], pa.int64()),
                "distinct": pa.array([int(word.sum()), *rest], pa.int64()),
            }
        )

    return rows


def _backed_off(blocks: pa.Table) -> pa.Table:
    """Replies to the chunks: the backoff weight of each n-gram."""
    ranks = [np.cumsum(_unpressed(r, np.uint32), dtype=np.int64) for r in blocks["ranks"].to_pylist()]
    rests = []
    for column in ("p", "lower"):
        sums = np.zeros(max(int(r[-1]) for r in ranks) + 1)
        for own, data in zip(ranks, blocks[column].to_pylist()):
            # A chunk names no n-gram twice.
            sums[own] += _unpressed(data, np.float64)
        rests.append(np.maximum(1 - sums, 1e-12))
    values = np.log10(rests[0] / rests[1])
    return pa.table(
        {
            **{n: blocks[n] for n in ("chunk", "level", "part")},
            "body": pa.array([_pressed(values[own]) for own in ranks], pa.binary()),
        }
    )


def _contexts(model: Model, order: int, parts: int, least: int):
    """Per chunk its kept n-grams below the highest order, with the probabilities of the
    continuations that the chunk adds up."""
    schema = pa.schema(
        [("part", pa.int64()), ("level", pa.int32()), ("chunk", pa.int64()), ("size", pa.int64()),
         ("ranks", pa.binary()), ("p", pa.binary()), ("lower", pa.binary())]
    )

    def rows(counts: pa.Table, chunk: pa.Table) -> pa.Table:
        levels, known, _ = _levels(chunk, order, model, counts)
        out = []
        for number, (level, own) in enumerate(zip(levels[:-1], known), 1):
            longer, adds = levels[number], known[number].own
            before, kept = level.at[longer.first[adds]], own.kept[:-1]
            p, lower = (
                np.bincount(before, weights=values[adds], minlength=len(kept))[kept]
                for values in (known[number].p, known[number].lower)
            )
            # Ranges number what they keep themselves, before any further bound.
            all_kept = flat(_replied(counts, number, "body", np.int64), np.int64) // 2
            all_kept = all_kept >= (least if number > 1 else 1)
            steps = _replied(counts, number, "ranks", np.uint32)
            ranks = flat([np.cumsum(r, dtype=np.uint32) for r in steps], np.uint32)[kept[all_kept]]
            columns = _dealt(
                level.names[kept], parts, chunk["chunk"][0].as_py(), number,
                ranks=ranks, p=p, lower=lower,
            )
            out.append(pa.table(columns, schema=schema))
        return pa.concat_tables(out)

    return rows


def _scored(model: Model, order: int):
    def rows(replies: pa.Table, chunk: pa.Table) -> pa.Table:
        ids = _listed(chunk, "doc_id")
        backoffs = replies.filter(pc.field("kind") == 1)
        levels, known, text_of = _levels(
            chunk, order, model, replies.filter(pc.field("kind") == 0)
        )

        def by_text(where: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
            return np.bincount(text_of[where], weights, minlength=len(ids))

        score, spared = np.zeros(len(ids)), None
        for number, (level, own) in enumerate(zip(levels, known), 1):
            kept = own.kept[:-1]
            backoff, value = np.zeros(len(kept)), np.zeros(len(kept))
            if number < order:
                backoff[kept] = flat(_replied(backoffs, number, "body", np.float64), np.float64)
            places = own.kept[level.at]
            value[kept] = np.log10(own.p[kept])
            if number == 1:
                value[level.names == _BEGIN_HASH] = 0
                seen = places & (level.at != np.searchsorted(level.names, _BEGIN_HASH))
                n_tokens, n_known = by_text(level.at >= 0) - 1, by_text(seen)
                missing = (n_tokens - n_known) * math.log10(1 / model.mass)
                base = by_text(seen, value[level.at[seen]]) + missing
            else:
                before = levels[number - 2].at[level.first]
                value[kept] -= np.log10(own.lower[kept]) + spared[before[kept]]
            score += by_text(places, (value + backoff)[level.at[places]])
            spared = backoff
        return pa.table(
            {
                "doc_id": ids,
                "held_out": _listed(chunk, "held_out"),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "train_tokens": pa.array([model.total] * len(ids), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(score + missing, pa.float64()),
            }
        )

    return rows


def language_scores(
    docs: DataFrame, order: int = ORDER, share: float = 0.0, held: int = 7, least: int = LEAST
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``share`` is a further bound of kept n-grams, as a share of the training tokens.
    """
    rows = docs.select("doc_id", "text", (bucket("doc_id", held) == 2).alias("held_out"))
    kind = rows.schema["doc_id"].dataType
    # The number of a chunk is fixed by the table that is written.
    texts = staged(
        rows.mapInArrow(
            _chunked(to_arrow_type(kind)),
            f"chunk bigint, doc_id array<{kind.simpleString()}>, held_out array<boolean>, "
            "sizes array<int>, n_bytes bigint, body binary",
        ),
        "texts",
    )
    parts = max(1, math.ceil((texts.agg(F.sum("n_bytes")).first()[0] or 0) / PART))
    by_chunk = texts.select("chunk", "held_out", "sizes", "body").groupBy("chunk")
    block = "part bigint, level int, chunk bigint, size bigint, "
    question, reply = block + "names binary, n binary", "chunk bigint, level int, part bigint, body binary"

    def counted(asked: DataFrame) -> DataFrame:
        return staged(
            asked.groupBy("part", "level").applyInArrow(
                _counted(least, order), f"{reply}, ranks binary, total bigint, distinct bigint"
            ),
            "counts",
            free=True,
        )

    counts = counted(by_chunk.applyInArrow(_asked_first(order, parts), question))
    sizes = counts.where("level = 1").agg(
        *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("total", "distinct"))
    ).first()
    total = sizes["total"]
    model = Model(total, total + sizes["distinct"] + 1, max(least, share * total), min(order, 2))
    counts = counts.drop("total", "distinct")
    while model.counted < order:
        asked = counts.groupBy("chunk").cogroup(by_chunk).applyInArrow(_asked_next(model, parts), question)
        counts = counts.union(counted(asked).drop("total", "distinct"))
        model = replace(model, counted=model.counted + 1)
    replies = counts.withColumn("kind", F.lit(0))
    if order > 1:
        contexts = (
            counts.groupBy("chunk")
            .cogroup(by_chunk)
            .applyInArrow(
                _contexts(model, order, parts, least), f"{block}ranks binary, p binary, lower binary"
            )
        )
        backoffs = staged(
            contexts.groupBy("part", "level").applyInArrow(_backed_off, reply), "backoffs", free=True
        )
        nothing = F.lit(_pressed(_NO_RANKS)).alias("ranks")
        replies = replies.union(backoffs.select("*", nothing, F.lit(1).alias("kind")))
    return (
        replies.groupBy("chunk")
        .cogroup(texts.drop("n_bytes").groupBy("chunk"))
        .applyInArrow(
            _scored(model, order),
            f"doc_id {kind.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, "
            "train_tokens bigint, base_score double, score double",
        )
    )
