"""Removal of passages that repeat across documents, by suffix automata.

A window is ``width`` consecutive words (runs of bytes other than space and 0x09-0x0D). A word goes
if some window that covers it also starts in a document with a smaller id; windows are judged on the
input.

The reference text is the corpus itself, so neither it nor an automaton of it has a bounded size to
broadcast. It is sharded by content instead: a window's minimiser, the smallest hash of the word
runs of length ``GRAM`` inside it, is the same in every copy of the window. Neighbouring windows
with one minimiser form a passage, and all passages with one minimiser form a reference shard;
equal windows always meet in the same shard. Shards with one document end there. Equal passages
are collapsed onto the smallest id that has them: under larger ids they go whole. For what is left,
a task builds a suffix automaton of each shard, in the order of the ids: one text of every passage
is streamed through the automaton of the smaller ids for its matching statistics, the length of the
longest earlier match ending at each word, and matches of at least ``width`` words mark its windows.
The marks hold at every place where the smallest id has the passage. Words are compared as they are.

A shard with more than ``SHARD_PASSAGES`` different passages (a text that stands in very many
different surroundings) would not fit one task. Its windows are grouped by a 128-bit digest instead,
which partial aggregation spreads over all tasks and gives the same answer.

Null, empty and blank texts have no words and stay as they are. Documents with a null id stay whole
and are no reference for others. Rows that repeat an id are judged each by its own text, and are no
reference for each other. Other columns pass through; input columns with a name of an added column
are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import (
    as_signed,
    flat,
    mapped,
    run_hashes,
    sliding_min,
    spans_hash,
    staged,
    text_bytes,
    unused,
    word_hashes,
)

WIDTH = 50
#: Words of the runs whose smallest hash names a window's shard; at most the width.
GRAM = 20
#: Windows of one passage; longer stretches with one minimiser are cut, inside the same shard.
LONGEST = 256
SHARD_PASSAGES = 500
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self):
        self.arcs: list[dict] = [{}]
        self.suffix = [-1]
        self.longest = [0]

    def _state(self, longest: int, suffix: int, arcs: dict) -> int:
        self.arcs.append(arcs)
        self.suffix.append(suffix)
        self.longest.append(longest)
        return len(self.arcs) - 1

    def _split(self, state: int, word: bytes) -> int:
        """The state reached by ``word`` whose longest sequence is one word longer than here."""
        target = self.arcs[state][word]
        size = self.longest[state] + 1
        if self.longest[target] == size:
            return target
        copy = self._state(size, self.suffix[target], dict(self.arcs[target]))
        self.suffix[target] = copy
        while state >= 0 and self.arcs[state].get(word) == target:
            self.arcs[state][word] = copy
            state = self.suffix[state]
        return copy

    def add(self, words: list[bytes]) -> None:
        state = 0
        for word in words:
            if word in self.arcs[state]:
                state = self._split(state, word)
                continue
            fresh = self._state(self.longest[state] + 1, 0, {})
            while state >= 0 and word not in self.arcs[state]:
                self.arcs[state][word] = fresh
                state = self.suffix[state]
            if state >= 0:
                self.suffix[fresh] = self._split(state, word)
            state = fresh

    def matches(self, words: list[bytes]) -> Iterator[int]:
        """For each word the length of the longest known sequence that ends there."""
        state = size = 0
        for word in words:
            while state and word not in self.arcs[state]:
                state = self.suffix[state]
                size = self.longest[state]
            if word in self.arcs[state]:
                state = self.arcs[state][word]
                size += 1
            yield size


def passages(hashes: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(minimiser, content hash, first window, number of windows) of a document's passages."""
    gram = min(GRAM, width)
    least = sliding_min(run_hashes(hashes, gram), width - gram + 1)
    if not len(least):
        none = np.zeros(0, dtype=np.int64)
        return least, least, none, none
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    ends = np.append(starts[1:], len(least))
    if (ends - starts).max() > LONGEST:
        cut = [np.arange(a, b, LONGEST) for a, b in zip(starts, ends)]
        starts = np.concatenate(cut)
        ends = np.append(starts[1:], len(least))
    return least[starts], spans_hash(hashes, starts, ends + width - 1), starts, ends - starts


def _passage_rows(width: int):
    def rows(batch: pa.RecordBatch):
        docs, keys, found = [], [], []
        names = zip(batch["doc_id"].to_pylist(), batch["key"].to_pylist())
        for (doc, key), text in zip(names, text_bytes(batch["text"])):
            if doc is None or not text:
                continue
            one = passages(word_hashes(text), width)
            docs.append(np.full(len(one[0]), doc, dtype=np.int64))
            keys.append(np.full(len(one[0]), key, dtype=np.int64))
            found.append(one)
        shard, content, start, count = zip(*found) if found else ((), (), (), ())
        yield {
            "shard": as_signed(flat(list(shard), np.uint64)),
            "content": as_signed(flat(list(content), np.uint64)),
            "doc_id": flat(docs, np.int64),
            "key": flat(keys, np.int64),
            "start": flat(list(start), np.int64).astype(np.int32),
            "windows": flat(list(count), np.int64).astype(np.int32),
        }

    return rows


def _passage_words(width: int):
    """The words of the passages listed for a document, joined by a space."""

    def rows(batch: pa.RecordBatch):
        out = {n: [] for n in ("shard", "large", "content", "doc_id", "words")}
        for doc, listed, text in zip(
            batch["doc_id"].to_pylist(),
            batch["listed"].to_pylist(),
            text_bytes(batch["text"]),
        ):
            words = text.split()
            for item in listed:
                start, end = item["start"], item["start"] + item["windows"] + width - 1
                out["shard"].append(item["shard"])
                out["large"].append(item["large"])
                out["content"].append(item["content"])
                out["doc_id"].append(doc)
                out["words"].append(b" ".join(words[start:end]))
        yield out

    return rows


def _runs(marked: list[int]) -> Iterator[tuple[int, int]]:
    """(first, count) of the stretches of consecutive numbers."""
    places = np.asarray(marked)
    for part in np.split(places, np.flatnonzero(np.diff(places) != 1) + 1):
        yield int(part[0]), len(part)


def _matched(width: int):
    """Repeated windows of the passages of whole shards, sorted by shard and document."""

    def run(batches):
        shard, doc, automaton, waiting = None, None, None, []
        for batch in batches:
            out = {"content": [], "doc_id": [], "offset": [], "windows": []}
            columns = [batch[n].to_pylist() for n in ("shard", "content", "doc_id", "words")]
            for new_shard, content, new_doc, text in zip(*columns):
                if new_shard != shard:
                    shard, doc, automaton, waiting = new_shard, new_doc, Automaton(), []
                elif new_doc != doc:
                    # Only now, as a document is no reference for itself.
                    for words in waiting:
                        automaton.add(words)
                    doc, waiting = new_doc, []
                words = text.split(b" ")
                ends = [i for i, n in enumerate(automaton.matches(words)) if n >= width]
                waiting.append(words)
                if ends:
                    for first, count in _runs(ends):
                        out["content"].append(content)
                        out["doc_id"].append(doc)
                        out["offset"].append(first - width + 1)
                        out["windows"].append(count)
            yield pa.RecordBatch.from_pydict(
                out, schema=pa.schema([("content", pa.int64()), ("doc_id", pa.int64()),
                                       ("offset", pa.int32()), ("windows", pa.int32())])
            )

    return run


def _digests(width: int):
    def rows(batch: pa.RecordBatch):
        out = {"digest": [], "content": [], "doc_id": [], "offset": []}
        columns = [batch[n].to_pylist() for n in ("content", "doc_id", "words")]
        for content, doc, text in zip(*columns):
            words = text.split(b" ")
            for place in range(len(words) - width + 1):
                window = b" ".join(words[place : place + width])
                out["digest"].append(hashlib.blake2b(window, digest_size=16).digest())
                out["content"].append(content)
                out["doc_id"].append(doc)
                out["offset"].append(place)
        yield out

    return rows


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, key, start, windows): stretches of windows that a smaller id has as well.

    ``key`` is the hash of the row's text, ``start`` the word at which the first window begins.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("key"), "text"
    ).where("doc_id IS NOT NULL AND text IS NOT NULL")
    place = "doc_id bigint, key bigint, start int, windows int"
    every = mapped(texts, _passage_rows(width), f"shard bigint, content bigint, {place}")
    shared = (
        every.groupBy("shard")
        .agg(
            F.min("doc_id").alias("low"),
            F.max("doc_id").alias("high"),
            (F.min("content") == F.max("content")).alias("alike"),
        )
        .where("low < high")
        .select("shard", "alike")
    )
    candidates = staged(every.join(shared, "shard"), "passages")
    contents = staged(
        candidates.groupBy("content").agg(
            F.min(F.struct("doc_id", "key", "start")).alias("first"),
            F.max("doc_id").alias("last"),
            F.min("shard").alias("shard"),
            F.min("windows").alias("windows"),
            F.min("alike").alias("alike"),
        ),
        "contents",
    )
    copied = contents.where("first.doc_id < last").select(
        "content", F.col("first.doc_id").alias("first")
    )
    whole = candidates.join(copied, "content").where("first < doc_id")
    # Passages that may share windows with different passages of their shard.
    different = contents.where("NOT alike").select("shard", "content", "first.*", "windows")
    sizes = different.groupBy("shard").agg((F.count("*") > SHARD_PASSAGES).alias("large"))
    listed = (
        different.join(sizes, "shard")
        .groupBy("doc_id", "key")
        .agg(F.collect_list(F.struct("shard", "large", "content", "start", "windows")).alias("listed"))
    )
    fetched = staged(
        mapped(
            # Rows that repeat an id and a text would only repeat the same passages.
            texts.join(listed, ["doc_id", "key"]),
            _passage_words(width),
            "shard bigint, large boolean, content bigint, doc_id bigint, words binary",
        ),
        "passage-words",
    )
    matched = (
        fetched.where("NOT large")
        .repartition("shard")
        .sortWithinPartitions("shard", "doc_id")
        .mapInArrow(_matched(width), "content bigint, doc_id bigint, offset int, windows int")
    )
    digests = mapped(
        fetched.where("large"),
        _digests(width),
        "digest binary, content bigint, doc_id bigint, offset int",
    )
    earliest = digests.groupBy("digest").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    )
    windows = (
        digests.join(earliest.where("low < high"), "digest")
        .where("low < doc_id")
        .select("content", "doc_id", "offset")
        .distinct()
    )
    # At most LONGEST rows of one passage; neighbours have one number and become one mark.
    number = F.col("offset") - F.row_number().over(
        Window.partitionBy("content", "doc_id").orderBy("offset")
    )
    runs = (
        windows.withColumn("run", number)
        .groupBy("content", "doc_id", "run")
        .agg(F.min("offset").alias("offset"), F.count("*").cast("int").alias("windows"))
    )
    offsets = ["content", "doc_id", "offset", "windows"]
    marks = (
        matched.select(*offsets)
        .union(runs.select(*offsets))
        .groupBy("content", "doc_id")
        .agg(F.collect_set(F.struct("offset", "windows")).alias("marks"))
    )
    # A document can have a passage several times, as can rows that share an id.
    repeated = (
        candidates.select("content", "doc_id", "key", "start")
        .join(marks, ["content", "doc_id"])
        .select("doc_id", "key", "start", F.inline("marks"))
        .withColumn("start", F.col("start") + F.col("offset"))
    )
    columns = ["doc_id", "key", "start", "windows"]
    return whole.select(*columns).union(repeated.select(*columns))


def _cut(text: bytes, spans: list[dict], width: int) -> tuple[bytes, list[bytes], int]:
    """The text without the covered words, its kept words, and the number of words before."""
    places = [m.span() for m in _WORD.finditer(text)]
    edges = np.zeros(len(places) + 1, dtype=np.int64)
    for span in spans:
        edges[span["start"]] += 1
        edges[span["start"] + span["windows"] + width - 1] -= 1
    covered = np.cumsum(edges[:-1]) > 0
    kept, parts, position, gap = [], [], 0, False
    for (start, end), gone in zip(places, covered.tolist()):
        if gone and not gap:
            parts.append(text[position:start])
        elif not gone:
            kept.append(text[start:end])
            position = start if gap else position
        gap = gone
    if not gap:
        parts.append(text[position:])
    return b"".join(parts), kept, len(places)


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``; adds n_words, n_removed, kept_sha256.

    ``n_words`` counts the input's words and ``kept_sha256`` is the hash of the kept words joined by
    one space. Texts without a repeated passage are returned unchanged.
    """
    added = ["n_words", "n_removed", "kept_sha256"]
    rows = docs.drop(*added)
    kept = rows.columns
    doc, key, marks = unused(kept, 3)
    spans = (
        repeated_windows(docs, width)
        .groupBy(F.col("doc_id").alias(doc), F.col("key").alias(key))
        .agg(F.collect_list(F.struct("start", "windows")).alias(marks))
    )
    found = rows.join(
        spans,
        (rows["doc_id"].cast("bigint") == spans[doc]) & (F.xxhash64(rows["text"]) == spans[key]),
        "left",
    ).drop(doc, key)

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts, words, removed, digests = [], [], [], []
                for text, spans in zip(text_bytes(batch["text"]), batch[marks].to_pylist()):
                    if spans:
                        new, left, total = _cut(text, spans, width)
                    else:
                        new, left = text, (text or b"").split()
                        total = len(left)
                    texts.append(new)
                    words.append(total)
                    removed.append(total - len(left))
                    digests.append(hashlib.sha256(b" ".join(left)).hexdigest())
                columns = {
                    name: pa.array(texts, type=pa.binary()).cast(pa.string())
                    if name == "text"
                    else batch[name]
                    for name in kept
                }
                columns["n_words"] = pa.array(words, type=pa.int64())
                columns["n_removed"] = pa.array(removed, type=pa.int64())
                columns["kept_sha256"] = pa.array(digests, type=pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    fields = [f"`{n}` {t}" for n, t in rows.dtypes]
    schema = ", ".join([*fields, "n_words bigint", "n_removed bigint", "kept_sha256 string"])
    return found.mapInArrow(run, schema)
