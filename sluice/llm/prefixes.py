"""The prefix trie of conversations, built as a burst trie.

A conversation is the sequence of its turns; a turn's id is a 128-bit SHA-256 prefix of its role and
text, so texts are read once and never shuffled. Equal conversations are one sequence with a count,
its smallest conv_id and the digest of all its conv_ids; the ids of one sequence are sorted over many
tasks and streamed into the digest as packed chunks.

A container holds the suffixes of all sequences below one trie head, at first all of them below the
root. A container of more than ``LIMIT`` sequences bursts: the turns that all its sequences share
become a chain of nodes at once, and the rest falls apart by the next turn id. That costs one round
for each branching level, not for each turn. Every container that is left is sorted and swept into
its nodes in one task; the heads above get their counts by sums over the containers below.

Turns are ordered by ``turn``, nulls first, and by their ids among equal ones; repeated rows stay.
Null role and text are empty. Rows without a conv_id belong to no conversation. Code points are those
of the text. An empty table has no nodes, not even a root. Other input columns are ignored. The ids of
one conversation's turns (24 bytes a turn) are held as one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import staged

#: Different sequences that a container may hold.
LIMIT = 64
#: Ids that are joined into one chunk of text, and nodes put out at once.
CHUNK = 50_000
BATCH = 10_000
NOTHING = hashlib.sha256(b"").hexdigest()

NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
#: A container's top also says below which heads it lies.
SWEPT = f"{NODE}, top boolean, path array<string>"
_KINDS = {"bigint": pa.int64(), "string": pa.string()}
_ARROW_NODE = pa.schema([(name, _KINDS[kind]) for name, kind in map(str.split, NODE.split(", "))])
_ARROW_SWEPT = _ARROW_NODE.append(pa.field("top", pa.bool_())).append(
    pa.field("path", pa.list_(pa.string()))
)


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq): the ordered turns of every conversation as (tid, chars)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct(
        "turn",
        F.unhex(F.substring(name, 1, 32)).alias("tid"),
        F.length(text).alias("chars"),
    )
    # Each map task sends one list for each conversation that it has seen.
    return (
        conversations.where("conv_id IS NOT NULL")
        .select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .selectExpr("conv_id", "transform(turns, t -> struct(t.tid, t.chars)) AS seq")
    )


def shared_starts(found: DataFrame) -> DataFrame:
    """Every conversation with the first turns of the first one of its hundred in front.

    Of ``h = crc32(conv_id) % 6`` turns: they replace its own first h, and the rest of its own follow.
    """
    taken = F.crc32(F.col("conv_id").cast("string")) % 6
    own = found.select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % 100).alias("base"),
        taken.cast("int").alias("h"),
        "seq",
    )
    starts = found.where("conv_id % 100 = 0").selectExpr("conv_id AS base", "slice(seq, 1, 5) AS start")
    return own.join(starts, "base", "left").selectExpr(
        "conv_id",
        "concat(CASE WHEN start IS NULL THEN slice(seq, 1, 0) ELSE slice(start, 1, h) END, "
        "slice(seq, h + 1, greatest(size(seq) - h, 0))) AS seq",
    )


# -- equal sequences -----------------------------------------------------------------------------


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (name, conv_id) as one row of joined ids for each name, or for each CHUNK of them."""
    schema = pa.schema(
        [("name", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())]
    )
    open_name, ids, done = None, [], []
    for batch in batches:
        for name, conv in zip(batch["name"].to_pylist(), batch["conv_id"].to_pylist()):
            if name != open_name or len(ids) >= CHUNK:
                if ids:
                    done.append((open_name, ids[0], len(ids), ",".join(map(str, ids))))
                open_name, ids = name, []
            ids.append(conv)
        yield _batch(done, schema)
        done = []
    if ids:
        yield _batch([(open_name, ids[0], len(ids), ",".join(map(str, ids)))], schema)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks as one row for each name: smallest id, count, digest of the joined ids."""
    schema = pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])
    open_name, first, count, state, done = None, 0, 0, None, []
    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("name", "first", "n", "ids"))
        for name, low, n, ids in zip(*columns):
            if name != open_name:
                if state is not None:
                    done.append((first, count, state.hexdigest()))
                open_name, first, count, state = name, low, 0, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
            count += n
        yield _batch(done, schema)
        done = []
    if state is not None:
        yield _batch([(first, count, state.hexdigest())], schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def distinct_sequences(found: DataFrame) -> DataFrame:
    """(conv_id, n, ends, seq): each different sequence by its smallest conv_id."""
    joined = F.expr("array_join(transform(seq, t -> hex(t.tid)), '')")
    name = F.unhex(F.substring(F.sha2(joined, 256), 1, 32))
    names = staged(found.select(name.alias("name"), "conv_id"), "sequence-names")
    chunks = (
        names.repartitionByRange("name", "conv_id")
        .sortWithinPartitions("name", "conv_id")
        .mapInArrow(_packed, "name binary, first bigint, n bigint, ids string")
    )
    digests = (
        chunks.repartition("name")
        .sortWithinPartitions("name", "first")
        .mapInArrow(_digested, "conv_id bigint, n bigint, ends string")
    )
    return digests.join(found, "conv_id").select("conv_id", "n", "ends", "seq")


# -- bursting ------------------------------------------------------------------------------------

#: What names a container: the head above it and the next turn id.
_CONTAINER = ["head", "next"]


def _head(conv: str, depth: str) -> Column:
    """A node's name: its smallest member and its depth."""
    return F.concat_ws(":", F.col(conv), F.col(depth))


def _burst(level: DataFrame, limit: int) -> DataFrame:
    """The containers of ``level`` that are too large, each with the chain that its rows share."""
    totals = level.groupBy(*_CONTAINER).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("total"), F.min("conv_id").alias("low_conv")
    )
    large = staged(totals.where(F.col("rows") > limit), "large-containers")
    # The smallest and the largest sequence of a container agree exactly where all do.
    ends = level.join(large, _CONTAINER, "left_semi").groupBy(*_CONTAINER).agg(
        F.min("seq").alias("lo"),
        F.max("seq").alias("hi"),
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.first("path").alias("path"),
    )
    differs = "array_position(zip_with(lo, hi, (a, b) -> a <=> b), false)"
    return (
        large.join(ends, _CONTAINER)
        .withColumn("last", F.expr(f"CAST({differs} - 1 AS BIGINT)"))
        .withColumn(
            "chars",
            F.expr(
                "transform(slice(lo, greatest(CAST(depth AS INT), 1), "
                "CAST(last - greatest(depth, 1) + 1 AS INT)), t -> t.chars)"
            ),
        )
        .select(
            *_CONTAINER, "depth", "last", "total", "low_conv", "parent", "path", "chars",
            _head("low_conv", "last").alias("name"),
        )
    )


def _below(level: DataFrame, bursts: DataFrame) -> DataFrame:
    """The rows of burst containers in the containers one branching further down; null ``next`` at the end."""
    known = bursts.select(*_CONTAINER, "name", "low_conv", "last")
    return level.join(known, _CONTAINER).select(
        F.col("name").alias("head"),
        F.expr("try_element_at(seq, CAST(last + 1 AS INT)).tid").alias("next"),
        F.col("low_conv").alias("parent"),
        (F.col("last") + 1).alias("depth"),
        F.array_append("path", F.col("name")).alias("path"),
        "conv_id", "n", "ends", "seq",
    )


# -- sweeping ------------------------------------------------------------------------------------


class _Node:
    __slots__ = ("children", "conv", "ends", "leaves", "n", "saved", "turn", "waiting")

    def __init__(self, turn: dict | None):
        self.turn, self.conv, self.n, self.ends = turn, None, 0, NOTHING
        self.children = self.leaves = self.saved = 0
        self.waiting: list[tuple] = []

    def add(self, conv: int, n: int) -> None:
        self.n += n
        self.conv = conv if self.conv is None else min(conv, self.conv)


def _closed(path: list[_Node], top: int, parent: int | None, heads: list[str]) -> list[tuple]:
    """Closes the last node of ``path``; the rows that are complete with it."""
    node, depth = path.pop(), top + len(path)
    node.saved += (node.n - 1) * (node.turn["chars"] if node.turn else 0)
    node.leaves += node.children == 0
    done = [(c, d, node.conv, *rest) for c, d, *rest in node.waiting]
    row = (node.conv, depth, node.n, node.children, node.leaves, node.saved, node.ends)
    if path:
        above = path[-1]
        above.add(node.conv, node.n)
        above.children += 1
        above.leaves += node.leaves
        above.saved += node.saved
        above.waiting.append((*row, False, []))
    else:
        done.append((row[0], row[1], parent, *row[2:], True, heads))
    return done


def _sweep(rows: list[dict]) -> list[tuple]:
    """The nodes of one container from its sorted rows."""
    top, parent, heads = rows[0]["depth"], rows[0]["parent"], rows[0]["path"]
    path, before, done = [], None, []
    for row in rows:
        seq, same = row["seq"], top
        if before is not None:
            most = min(len(seq), len(before))
            while same < most and seq[same]["tid"] == before[same]["tid"]:
                same += 1
            while len(path) > same - top + 1:
                done += _closed(path, top, parent, heads)
        for depth in range(top + len(path), len(seq) + 1):
            path.append(_Node(seq[depth - 1] if depth else None))
        path[-1].add(row["conv_id"], row["n"])
        path[-1].ends = row["ends"]
        before = seq
    while path:
        done += _closed(path, top, parent, heads)
    return done


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the containers of one partition, whose rows follow each other in order."""
    schema = _ARROW_SWEPT
    container, rows, done = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and (row["head"], row["next"]) != container:
                done += _sweep(rows)
                rows = []
                if len(done) >= BATCH:
                    yield _batch(done, schema)
                    done = []
            container = (row["head"], row["next"])
            rows.append(row)
    if rows:
        done += _sweep(rows)
    yield _batch(done, schema)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of every burst container's chain."""
    schema = _ARROW_NODE
    for batch in batches:
        for row in batch.to_pylist():
            depths = np.arange(row["depth"], row["last"] + 1)
            chars = np.asarray(row["chars"], dtype=np.int64)
            if row["depth"] == 0:
                chars = np.append(np.int64(0), chars)
            own = (row["total"] - 1) * chars
            saved = np.cumsum(own[::-1])[::-1] + row["saved"]
            count = len(depths)
            for at in range(0, count, BATCH):
                part = slice(at, min(at + BATCH, count))
                size, last = part.stop - part.start, part.stop == count
                above = [row["low_conv"]] * size
                if at == 0:
                    above[0] = row["parent"]
                children, ends = [1] * size, [NOTHING] * size
                if last:
                    children[-1] = row["children"]
                    ends[-1] = row["ends"] or NOTHING
                columns = [
                    [row["low_conv"]] * size, depths[part], above, [row["total"]] * size,
                    children, [row["leaves"]] * size, saved[part], ends,
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )


def _all(frames: Iterable[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def prefix_trie(found: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes (``NODE``) of the trie of ``found(conv_id, seq)``; a conv_id is there once."""
    level = staged(
        distinct_sequences(found).select(
            F.lit("").alias("head"),
            F.lit(None).cast("binary").alias("next"),
            F.lit(None).cast("bigint").alias("parent"),
            F.lit(0).cast("bigint").alias("depth"),
            F.array().cast("array<string>").alias("path"),
            "conv_id", "n", "ends", "seq",
        ),
        "container",
    )
    levels, bursts, ended = [], [], []
    while True:
        # A null turn id would not meet itself in a join; only the root's container has one.
        level = level.withColumn("next", F.coalesce("next", F.lit(b"")))
        large = staged(_burst(level, limit), "bursts")
        levels.append(level.join(large, _CONTAINER, "left_anti"))
        if large.isEmpty():
            break
        below = staged(_below(level, large), "container")
        bursts.append(large)
        ended.append(below.where("next IS NULL").select(F.col("head").alias("name"), "ends"))
        level = below.where("next IS NOT NULL")
    swept = staged(
        _all(levels)
        .repartition(*_CONTAINER)
        .sortWithinPartitions(*_CONTAINER, "seq")
        .mapInArrow(_swept, SWEPT),
        "nodes",
    )
    nodes = swept.select(*(c.split()[0] for c in NODE.split(", ")))
    if not bursts:
        return nodes
    burst = _all(bursts)
    own = "(total - 1) * aggregate(chars, 0L, (sum, c) -> sum + c)"
    parts = swept.where("top").select("path", F.col("n_leaves").alias("l"), F.col("saved_tokens").alias("s"))
    parts = parts.union(burst.selectExpr("path", "0L", own)).where("size(path) > 0")
    children = parts.groupBy(F.element_at("path", -1).alias("name")).agg(
        F.count(F.lit(1)).alias("children")
    )
    totals = (
        parts.select(F.explode("path").alias("name"), "l", "s")
        .groupBy("name")
        .agg(F.sum("l").alias("leaves"), F.sum("s").alias("saved"))
    )
    heads = burst.join(children, "name").join(totals, "name").join(_all(ended), "name", "left")
    return nodes.union(heads.mapInArrow(_chained, NODE))


def conversation_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The prefix trie of the conversations with shared starts: one row for each node."""
    rebuilt = staged(shared_starts(sequences(conversations)), "conversations")
    return prefix_trie(rebuilt, limit)
