"""SentencePiece encoding and decoding by a relational lattice.

The distinct words of all texts are a table; a word is a part of a text that no piece crosses (see
``pieces.Cutter``). Every word is exploded into its substrings of bounded length, which an equi-join with the piece table turns into the edges of the
word's lattice; a character without a piece gets an edge of its own. Edges are grouped by word and
folded with the higher-order function ``aggregate``: a Viterbi search from left to right that carries
the best score and path of every position. Words of more than ``_BLOCK`` characters carry only the
scores of the last few positions and each position's best last piece, and walk back. Ties go to the piece that starts earliest, as in the tokenizer. Grouping needs no further shuffle,
because the words are already partitioned by word.

Texts are put together from the encoded words. The ``FREQUENT`` most frequent words, a bounded
number, are broadcast; for the rest each text's rare words are joined with the encoded words and come
back to it. A rare word is at most every ``FREQUENT``-th of all words, so the join has no hot key.
Texts travel to their rare words compressed, words with their ids as bytes; the shuffle files of each
step are deleted once its table is written. All words are encoded by the lattice.

Null and empty texts have no ids. A literal U+2581 decodes to a space, as in the tokenizer; that is
no fault of the encoding, so ``round_trip`` allows for it, but ``exact`` is false there. Other
columns pass through; those with a name of an added column are replaced. Repeated rows are encoded
alike. Words of any length are handled; every edge of a word's lattice carries the word while edges
are grouped, so one word of many ten thousand characters needs gigabytes of its task's memory.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import counted, freed, mapped, staged, text_bytes, unused
from sluice.llm.pieces import MODEL, SPACE, Cutter, Pieces, load_pieces

FREQUENT = 200_000
#: Characters of distinct words that one task encodes; their edges are sorted in its memory.
TASK_CHARACTERS = 300_000
#: Back pointers are collected in blocks of this size, so a long word is not copied at each step; up
#: to this length whole paths are carried instead.
_BLOCK = 256


def piece_table(spark, pieces: Pieces) -> DataFrame:
    rows = [(p, pieces.scores[p], i) for p, i in pieces.ids.items()]
    return spark.createDataFrame(rows, "piece string, score double, id int")


def _appended(cur: Column, done: Column, item: Column) -> tuple[Column, Column]:
    """A list kept as full blocks and a current block, with one more item."""
    full = F.size(cur) >= _BLOCK
    return (
        F.when(full, F.array(item)).otherwise(F.concat(cur, F.array(item))),
        F.when(full, F.concat(done, F.array(cur))).otherwise(done),
    )


def _best_path(edges: Column) -> Column:
    """The ids on the best path of a short word."""
    path = "struct<best:double,ids:array<int>>"
    start = F.struct(
        F.lit(0).alias("end"),
        F.lit(0.0).cast("double").alias("best"),
        F.array().cast("array<int>").alias("ids"),
        F.array().cast(f"array<{path}>").alias("closed"),
    )

    def step(state: Column, edge: Column) -> Column:
        # Positions before the current one are closed; an edge starts at one of them or here.
        before = F.get(state["closed"], edge["start"])
        score = before["best"] + edge["score"]
        one_more = F.array(edge["id"])
        # A later edge of the same position: better only if strictly higher.
        better = F.struct(
            state["end"].alias("end"),
            score.alias("best"),
            F.concat(before["ids"], one_more).alias("ids"),
            state["closed"].alias("closed"),
        )
        here = edge["start"] == state["end"]
        reached = F.struct(state["best"].alias("best"), state["ids"].alias("ids"))
        opened = F.struct(
            edge["end"].alias("end"),
            (F.when(here, state["best"]).otherwise(before["best"]) + edge["score"]).alias("best"),
            F.concat(F.when(here, state["ids"]).otherwise(before["ids"]), one_more).alias("ids"),
            F.concat(state["closed"], F.array(reached)).alias("closed"),
        )
        same = F.when(score > state["best"], better).otherwise(state)
        return F.when(edge["end"] == state["end"], same).otherwise(opened)

    return F.aggregate(edges, start, step, lambda s: s["ids"])


def _best_pieces(edges: Column, window: int) -> Column:
    """For every position the length and id of the last piece of its best path."""
    pointer = "struct<len:int,id:int>"
    start = F.struct(
        F.lit(0).alias("end"),
        F.lit(0.0).cast("double").alias("best"),
        F.lit(None).cast(pointer).alias("last"),
        F.array().cast("array<double>").alias("before"),
        F.array().cast(f"array<{pointer}>").alias("cur"),
        F.array().cast(f"array<array<{pointer}>>").alias("done"),
    )

    def step(state: Column, edge: Column) -> Column:
        size = edge["end"] - edge["start"]
        last = F.struct(size.alias("len"), edge["id"].alias("id"))
        # A later edge of the same position: better only if strictly higher.
        score = F.get(state["before"], size - 1) + edge["score"]
        better = score > state["best"]
        same = F.struct(
            state["end"].alias("end"),
            F.when(better, score).otherwise(state["best"]).alias("best"),
            F.when(better, last).otherwise(state["last"]).alias("last"),
            state["before"].alias("before"),
            state["cur"].alias("cur"),
            state["done"].alias("done"),
        )
        # The first edge of the next position closes the one before.
        before = F.slice(F.concat(F.array(state["best"]), state["before"]), 1, window)
        cur, done = _appended(state["cur"], state["done"], state["last"])
        first = state["end"] == 0
        opened = F.struct(
            edge["end"].alias("end"),
            (F.get(before, size - 1) + edge["score"]).alias("best"),
            last.alias("last"),
            before.alias("before"),
            F.when(first, state["cur"]).otherwise(cur).alias("cur"),
            F.when(first, state["done"]).otherwise(done).alias("done"),
        )
        return F.when(edge["end"] == state["end"], same).otherwise(opened)

    return F.aggregate(
        edges,
        start,
        step,
        lambda s: F.concat(F.flatten(s["done"]), s["cur"], F.array(s["last"])),
    )


def _walked_back(pointers: Column) -> Column:
    """The ids on the best path, from the pointers of all positions."""
    start = F.struct(
        F.lit(0).alias("skip"),
        F.array().cast("array<int>").alias("cur"),
        F.array().cast("array<array<int>>").alias("done"),
    )

    def step(state: Column, pointer: Column) -> Column:
        cur, done = _appended(state["cur"], state["done"], pointer["id"])
        passed = F.struct(
            (state["skip"] - 1).alias("skip"), state["cur"].alias("cur"), state["done"].alias("done")
        )
        taken = F.struct((pointer["len"] - 1).alias("skip"), cur.alias("cur"), done.alias("done"))
        return F.when(state["skip"] > 0, passed).otherwise(taken)

    return F.aggregate(
        F.reverse(pointers),
        start,
        step,
        lambda s: F.reverse(F.concat(F.flatten(s["done"]), s["cur"])),
    )


def _utf8(code: Column) -> Column:
    """The UTF-8 bytes of a code point."""

    def tail(shift: int) -> Column:
        return F.shiftright(code, shift).bitwiseAND(0x3F).bitwiseOR(0x80)

    return (
        F.when(code < 0x80, F.array(code))
        .when(code < 0x800, F.array(F.shiftright(code, 6).bitwiseOR(0xC0), tail(0)))
        .when(code < 0x10000, F.array(F.shiftright(code, 12).bitwiseOR(0xE0), tail(6), tail(0)))
        .otherwise(F.array(F.shiftright(code, 18).bitwiseOR(0xF0), tail(12), tail(6), tail(0)))
    )


def encode_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``words`` with their ids; words are distinct and should be partitioned by word."""
    named = words.columns
    table = piece_table(words.sparkSession, pieces)
    window = pieces.longest
    substrings = (
        words.withColumn("start", F.explode(F.sequence(F.lit(0), F.length("word") - 1)))
        .withColumn(
            "len",
            F.explode(F.sequence(F.lit(1), F.least(F.lit(window), F.length("word") - F.col("start")))),
        )
        .withColumn("piece", F.expr("substring(word, start + 1, len)"))
    )
    # The table is as large as the vocabulary file.
    edges = substrings.join(F.broadcast(table), "piece", "left").where("id IS NOT NULL OR len = 1")
    # A character without a piece is noted as its code point, below zero.
    edges = edges.select(
        *named,
        F.struct(
            (F.col("start") + F.col("len")).alias("end"),
            "start",
            F.coalesce("score", F.lit(pieces.unknown)).alias("score"),
            F.coalesce("id", -F.ascii("piece") - 1).alias("id"),
        ).alias("edge"),
    )
    # Sorting by a hash first is cheaper than by text; the rows stay where they are.
    lattice = (
        edges.groupBy(F.xxhash64("word").alias("_hash"), *named)
        .agg(F.array_sort(F.collect_list("edge")).alias("edges"))
        .select(*named, "edges")
    )
    short = F.length("word") <= _BLOCK
    walked = _walked_back(_best_pieces(F.col("edges"), window))
    found = lattice.select(
        *named, F.when(short, _best_path(F.col("edges"))).otherwise(walked).alias("ids")
    )
    first = pieces.byte_ids[0]
    if pieces.byte_ids != tuple(range(first, first + 256)):
        raise ValueError("byte pieces are not in order")
    spelled = F.flatten(
        F.transform(
            "ids",
            lambda i: F.when(i >= 0, F.array(i)).otherwise(
                F.transform(_utf8(-i - 1), lambda b: b + first)
            ),
        )
    )
    return found.select(
        *named, F.when(F.exists("ids", lambda i: i < 0), spelled).otherwise(F.col("ids")).alias("ids")
    )


def decode_ids(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``: the text of its column ``ids``, null for null."""
    # As large as the vocabulary file.
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(model).bytes_of())
    kept = encoded.drop("decoded")
    names = kept.columns

    def rows(batch: pa.RecordBatch):
        texts = [
            None if ids is None else _decoded(ids, shared.value) for ids in batch["ids"].to_pylist()
        ]
        yield {**{n: batch[n] for n in names}, "decoded": texts}

    types = ", ".join([*(f"`{n}` {t}" for n, t in kept.dtypes), "decoded string"])
    return mapped(kept, rows, types)


def _decoded(ids: list[int], spelled: dict[int, bytes]) -> str:
    return b"".join(map(spelled.__getitem__, ids)).decode("utf-8", "replace")[1:]


def encode_texts(docs: DataFrame, model: str = MODEL, frequent: int = FREQUENT) -> DataFrame:
    """``docs`` with ``ids array<int>``, ``round_trip`` and ``exact``.

    ``exact``: whether the ids decode to the text; ``round_trip``: to the text with a space for each
    literal U+2581.
    """
    spark = docs.sparkSession
    pieces = load_pieces(model)
    # As large as the vocabulary file, like the pieces' bytes below.
    cutter = spark.sparkContext.broadcast(Cutter(pieces))
    # Ids of words travel as numbers of this kind.
    small_ids = max(*pieces.ids.values(), *pieces.byte_ids) < 1 << 16
    kind = np.dtype(np.uint16 if small_ids else np.int32)

    def count_words(seen, batch: pa.RecordBatch) -> None:
        for text in batch["text"].to_pylist():
            seen.update(cutter.value.parts(text))

    counts = (
        counted(docs.select("text"), count_words, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    counts = staged(counts, "distinct-words", free=True)
    characters = counts.agg(F.sum(F.length("word"))).first()[0] or 0
    tasks = max(1, ceil(characters / TASK_CHARACTERS))
    found = encode_words(counts.repartition(tasks, "word"), pieces)
    packed_words = mapped(
        found.select("word", "n", "ids"), _with_bytes(kind), "word string, n bigint, ids binary"
    )
    encoded = staged(packed_words, "encoded-words", free=True)
    # The bound is the number of words; the order is total, so a rerun takes the same ones.
    with freed(spark):
        top = encoded.orderBy(F.desc("n"), "word").limit(frequent).select("word", "ids").toArrow()
    known = spark.sparkContext.broadcast(
        dict(zip(top["word"].to_pylist(), top["ids"].to_pylist()))
    )
    kept = docs.drop("ids", "round_trip", "exact")
    names = [n for n in kept.columns if n != "text"]
    key, rare_words, small_text = unused([*kept.columns, "word", "ids"], 3)
    texts = docs.select("text", F.xxhash64("text").alias(key)).where("text IS NOT NULL")

    def missing(batch: pa.RecordBatch):
        keys, words, frequent = [], [], known.value
        for name, text in zip(batch[key].to_pylist(), batch["text"].to_pylist()):
            rare = [w for w in set(cutter.value.parts(text)) if w not in frequent]
            keys.extend([name] * len(rare))
            words.extend(rare)
        yield {key: keys, "word": words}

    # Copies of a text ask for the same words; they are united where the word is, before they travel.
    # A reply is the word's length in bytes, the word and its ids.
    replies = staged(
        mapped(texts, missing, f"{key} bigint, word string")
        .join(encoded.select("word", "ids"), "word")
        .groupBy(key)
        .agg(F.collect_set(F.concat(_length_bytes(F.col("word")), "ids")).alias(rare_words)),
        "rare-words",
        free=True,
    )

    def packed(batch: pa.RecordBatch):
        press = zstandard.ZstdCompressor(level=1)
        small = [None if t is None else press.compress(t) for t in text_bytes(batch["text"])]
        yield {**{n: batch[n] for n in names}, key: batch[key], small_text: small}

    plain = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes if n != "text")
    travelling = mapped(
        kept.withColumn(key, F.xxhash64("text")),
        packed,
        f"{plain}{', ' if plain else ''}{key} bigint, {small_text} binary",
    )
    joined = travelling.join(replies, key, "left").drop(key)
    spelled = spark.sparkContext.broadcast(pieces.bytes_of())

    def assembled(batch: pa.RecordBatch):
        unpack = zstandard.ZstdDecompressor()
        texts, out, fine, exact = [], [], [], []
        lists = batch[rare_words]
        rare = lists.flatten().to_pylist()
        end = 0
        for small, listed in zip(
            batch[small_text].to_pylist(), pc.list_value_length(lists).to_pylist()
        ):
            text = None if small is None else unpack.decompress(small).decode("utf-8")
            start, end = end, end + (listed or 0)
            own = dict(map(_reply, rare[start:end]))
            table = known.value
            joined = b"".join([table.get(w) or own[w] for w in cutter.value.parts(text)])
            texts.append(text)
            out.append(joined)
            ids = np.frombuffer(joined, dtype=kind).tolist()
            decoded = _decoded(ids, spelled.value) if text else text
            fine.append(not text or decoded == text.replace(SPACE, " "))
            exact.append(decoded == text)
        edges = np.cumsum([0, *(len(b) // kind.itemsize for b in out)], dtype=np.int32)
        ids = pa.ListArray.from_arrays(
            pa.array(edges),
            pa.array(np.frombuffer(b"".join(out), dtype=kind).astype(np.int32)),
            mask=pa.array([t is None for t in texts], pa.bool_()),
        )
        added = {"text": texts, "ids": ids, "round_trip": fine, "exact": exact}
        yield {**{n: batch[n] for n in names}, **added}

    added = "ids array<int>, round_trip boolean, exact boolean"
    types = ", ".join([*(f"`{n}` {t}" for n, t in kept.dtypes), added])
    return mapped(joined, assembled, types)


def _length_bytes(word: Column) -> Column:
    """A word's bytes behind their number as four bytes."""
    return F.concat(F.unhex(F.lpad(F.hex(F.octet_length(word)), 8, "0")), word.cast("binary"))


def _reply(packed: bytes) -> tuple[str, bytes]:
    end = 4 + int.from_bytes(packed[:4], "big")
    return packed[4:end].decode("utf-8"), packed[end:]


def _with_bytes(kind: np.dtype):
    """Encoded words with their ids as bytes."""

    def rows(batch: pa.RecordBatch):
        ids = batch["ids"]
        lengths = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int32)
        edges = np.cumsum([0, *(lengths * kind.itemsize)], dtype=np.int32)
        values = ids.flatten().to_numpy().astype(kind).tobytes()
        small = pa.BinaryArray.from_buffers(
            pa.binary(), len(ids), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(values)]
        )
        yield {"word": batch["word"], "n": batch["n"], "ids": small}

    return rows
