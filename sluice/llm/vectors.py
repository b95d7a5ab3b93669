"""Near duplicates of embeddings by an exact metric range join.

Vectors of one label are scaled to length one, where a cosine of at least ``c`` is a distance of
at most ``r = sqrt(2 - 2c)``. Pivots, taken from the vectors, partition them: a vector is owned by
its nearest pivot's cell. By the triangle inequality a partner of a vector owned by pivot p can be
owned by pivot q only if ``d(x, q) - d(x, p) <= 2r``; and x can only reach cell q if it is within r
of that cell's radius, the largest distance of a vector it owns to its pivot. Where both hold, the
vector is replicated into the cell. A cell holds all it needs, so cells are joined independently:
in each, blocks of owned vectors meet the cell's vectors, ordered by their distance to the pivot,
and a block passes over those whose distance differs by more than r from all of its own.

A label gets pivots in proportion to its vectors; one that is small, or a small share of all, is a
single cell without a pivot, so the pivots that pass through the driver are at most ``ALL_PIVOTS``.
Equal vectors are collapsed before and counted by multiplicity. Cells are cut into blocks of owned
vectors of bounded size, so neither a frequent label nor a crowded cell lands in one task. A task
returns, instead of all links, each vector's number of links and a spanning set of its component.

Vectors that are null, zero, or hold null or non-finite components, and those without a label, link
with nothing. Vectors of different lengths are never compared. Rows with a null id are returned with
no component and count as partners nowhere; rows repeating an id share its component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import components, staged

COSINE = 0.98
#: Distinct vectors of a label for each pivot, the most pivots of a label, and of all labels.
PER_PIVOT = 4096
MAX_PIVOTS = 64
ALL_PIVOTS = 4096
#: Owned vectors in one block of a cell, and vectors that meet a block at a time.
BLOCK = 4096
STREAM = 2048
#: The prefilter works in single arithmetic steps of double precision; its slack covers rounding.
SLACK = 1e-9


def _usable(rows: DataFrame) -> DataFrame:
    """Rows that can link, with their vector as doubles."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    return (
        rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
        .where(finite & F.exists(vector, lambda x: x != 0))
        # 0.0 and -0.0 are the same component.
        .select("vec_id", "label", F.transform(vector, lambda x: x + F.lit(0.0)).alias("vector"))
        .withColumn("dim", F.size("vector"))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """The list column as rows; all lists of a group have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaling by the largest component first keeps very small and very large ones finite.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (vectors @ pivots.T)))


def _grouped(batch: pa.RecordBatch):
    """(key, row numbers) of the (label, dim) groups in a batch."""
    labels = batch["label"].to_pylist()
    dims = batch["dim"].to_pylist()
    found: dict = {}
    for place, key in enumerate(zip(labels, dims)):
        found.setdefault(key, []).append(place)
    return found.items()


def _spread(pivots: dict, radius: dict, reach: float):
    """Owner and replica rows of each vector; without radii only the owners and distances."""

    def run(batches):
        for batch in batches:
            for key, places in _grouped(batch):
                part = batch.take(pa.array(places))
                if key in pivots:
                    far = _distances(_unit(_matrix(part["vector"])), pivots[key])
                else:
                    far = np.zeros((len(places), 1))
                own = far.argmin(axis=1)
                near = far[np.arange(len(own)), own]
                if radius is None:
                    rows, cells = np.arange(len(own)), own
                else:
                    limit = np.array([radius.get((*key, c), 0.0) for c in range(far.shape[1])])
                    wanted = (far - near[:, None] <= 2 * reach + SLACK) & (
                        far <= limit + reach + SLACK
                    )
                    wanted[np.arange(len(own)), own] = True
                    rows, cells = np.nonzero(wanted)
                columns = {
                    "label": part["label"].take(pa.array(rows)),
                    "dim": part["dim"].take(pa.array(rows)),
                    "cell": pa.array(cells, type=pa.int32()),
                    "owned": pa.array(cells == own[rows]),
                    "far": pa.array(far[rows, cells]),
                    "rep": part["rep"].take(pa.array(rows)),
                }
                if radius is not None:
                    columns["copies"] = part["copies"].take(pa.array(rows))
                    columns["vector"] = part["vector"].take(pa.array(rows))
                yield pa.RecordBatch.from_pydict(columns)

    return run


class _Block:
    """Owned vectors of one block, met by the cell's vectors in turn."""

    def __init__(self, cosine: float, reach: float):
        self.cosine, self.reach = cosine, reach
        self.parts: list = []
        self.vectors = None

    def add(self, vectors, reps, far):
        self.parts.append((vectors, reps, far))

    def close(self):
        self.vectors, self.reps, self.far = (np.concatenate(x) for x in zip(*self.parts))
        self.links = np.zeros(len(self.reps), dtype=np.int64)
        self.edges: list = []

    def meet(self, vectors, reps, far, copies):
        low, high = far.min() - self.reach - SLACK, far.max() + self.reach + SLACK
        mine = np.flatnonzero((self.far >= low) & (self.far <= high))
        if not len(mine):
            return
        for start in range(0, len(reps), STREAM):
            part = slice(start, start + STREAM)
            close = self.vectors[mine] @ vectors[part].T >= self.cosine
            close &= self.reps[mine][:, None] != reps[part][None, :]
            if not close.any():
                continue
            self.links[mine] += close @ copies[part]
            self._span(close, self.reps[mine], reps[part])

    def _span(self, close, mine, others):
        """Edges that connect what ``close`` connects, at most one for each row and column."""
        rows, columns = np.flatnonzero(close.any(axis=1)), np.flatnonzero(close.any(axis=0))
        close, mine, others = close[np.ix_(rows, columns)], mine[rows], others[columns]
        mark_rows, mark_columns = mine.copy(), others.copy()
        top = np.iinfo(np.int64).max
        while True:
            before = mark_rows, mark_columns
            found = np.where(close, mark_columns[None, :], top).min(axis=1)
            mark_rows = np.minimum(mark_rows, found)
            found = np.where(close, mark_rows[:, None], top).min(axis=0)
            mark_columns = np.minimum(mark_columns, found)
            if np.array_equal(before[0], mark_rows) and np.array_equal(before[1], mark_columns):
                break
        self.edges.append((mine, mark_rows))
        self.edges.append((others, mark_columns))


def _joined(cosine: float, reach: float):
    """Partitions hold whole blocks, owned vectors before the cell's vectors."""

    def done(block):
        if block is None or block.vectors is None:
            return
        linked = np.flatnonzero(block.links)
        if not len(linked):
            return
        yield pa.RecordBatch.from_pydict(
            {
                "a": pa.array(block.reps[linked]),
                "b": pa.array(block.reps[linked]),
                "links": pa.array(block.links[linked]),
            }
        )
        a = np.concatenate([e[0] for e in block.edges])
        b = np.concatenate([e[1] for e in block.edges])
        pairs = np.unique(np.stack([a, b])[:, a != b], axis=1)
        zeros = np.zeros(pairs.shape[1], dtype=np.int64)
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array(pairs[0]), "b": pa.array(pairs[1]), "links": pa.array(zeros)}
        )

    def run(batches):
        block, current = None, None
        for batch in batches:
            keys = list(zip(*(batch[c].to_pylist() for c in ("label", "dim", "cell", "block"))))
            sides = batch["side"].to_numpy(zero_copy_only=False)
            starts = [
                i
                for i in range(len(keys))
                if i == 0 or keys[i] != keys[i - 1] or sides[i] != sides[i - 1]
            ]
            for start, end in zip(starts, [*starts[1:], len(keys)]):
                if keys[start] != current:
                    yield from done(block)
                    block, current = _Block(cosine, reach), keys[start]
                part = batch.slice(start, end - start)
                vectors = _unit(_matrix(part["vector"]))
                reps = part["rep"].to_numpy(zero_copy_only=False)
                far = part["far"].to_numpy(zero_copy_only=False)
                if sides[start] == 0:
                    block.add(vectors, reps, far)
                    continue
                if block.vectors is None:
                    block.close()
                block.meet(vectors, reps, far, part["copies"].to_numpy(zero_copy_only=False))
        yield from done(block)

    return run


def near_duplicate_vectors(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per row of ``rows(vec_id, label, embedding)``: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows at a cosine of at least ``cosine``; ``component_id`` is the
    smallest id reachable over such links and ``kept`` marks the row that has it.
    """
    reach = float(np.sqrt(2.0 - 2.0 * cosine))
    usable = _usable(rows)
    key = F.xxhash64("vector")
    once = staged(
        usable.groupBy("label", "dim", key.alias("key"), "vector").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies")
        ),
        "vectors",
    )
    # Pivots are the vectors with the smallest hashes.
    sizes = once.groupBy("label", "dim").agg(F.count("*").alias("n"))
    total = F.lit(max(1, once.count()))
    wanted = F.least(
        F.lit(MAX_PIVOTS),
        F.ceil(F.col("n") / PER_PIVOT),
        F.floor(F.col("n") / total * ALL_PIVOTS),
    )
    order = Window.partitionBy("label", "dim").orderBy("key", "rep")
    picked = (
        once.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= MAX_PIVOTS)
        .join(sizes.withColumn("wanted", wanted).where("wanted > 1"), ["label", "dim"])
        .where("place <= wanted")
        .select("label", "dim", "place", "vector")
        .orderBy("label", "dim", "place")
        .collect()
    )
    pivots: dict = {}
    for row in picked:
        pivots.setdefault((row["label"], row["dim"]), []).append(row["vector"])
    pivots = {k: _unit(np.array(v, dtype=np.float64)) for k, v in pivots.items()}
    label = dict(rows.dtypes)["label"]
    schema = f"label {label}, dim int, cell int, owned boolean, far double, rep bigint"
    cells = (
        once.mapInArrow(_spread(pivots, None, reach), schema)
        .groupBy("label", "dim", "cell")
        .agg(F.max("far").alias("radius"), F.count("*").alias("n"))
    )
    cells = staged(cells, "cells")
    radius = {
        (r["label"], r["dim"], r["cell"]): r["radius"] for r in cells.where("radius > 0").collect()
    }
    spread = staged(
        once.mapInArrow(
            _spread(pivots, radius, reach), schema + ", copies bigint, vector array<double>"
        ),
        "spread",
    )
    blocks = cells.select(
        "label", "dim", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    )
    placed = spread.join(blocks, ["label", "dim", "cell"])
    owned = placed.where("owned").select(
        "*", F.pmod(F.xxhash64("rep"), "blocks").cast("int").alias("block"), F.lit(0).alias("side")
    )
    every = placed.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(1).alias("side"),
    )
    keys = ["label", "dim", "cell", "block"]
    met = (
        owned.union(every)
        .repartition(*keys)
        .sortWithinPartitions(*keys, "side", "far", "rep")
        .mapInArrow(_joined(cosine, reach), "a bigint, b bigint, links bigint")
    )
    met = staged(met, "met")
    groups = components(met.where("links = 0").select("a", "b"), "components")
    links = met.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    per_vector = (
        once.join(links, "rep", "left")
        .join(groups.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "label", "dim", "key", "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    found = usable.withColumn("key", key).join(per_vector, ["label", "dim", "key", "vector"])
    linked = found.select("vec_id", "n_links", "component_id")
    # Rows that cannot link stand alone.
    ok = usable.select(F.col("vec_id").alias("_ok")).distinct()
    alone = rows.join(ok, F.col("vec_id") == F.col("_ok"), "left_anti").select(
        F.col("vec_id").cast("bigint"), F.lit(0).cast("bigint").alias("n_links"),
        F.col("vec_id").cast("bigint").alias("component_id"),
    )
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.expr("vec_id = component_id"), F.lit(True))
    )
