"""Hard negatives by a vertical scan of columnar dimensions with shrinking candidates.

Rows and anchors meet in blocks of bounded size. Inside a block the vectors lie dimension by
dimension. An anchor reads dimensions in the order of its own components, largest magnitude first;
from each column's smallest and largest value follows what the dimensions not yet read can still
add. A candidate stays only while its possible scores reach the best ones or meet a window, so few
are read to the end, where their scores are exact integers.

Two scans: the first finds the ``POSITIVES`` best rows of an anchor's own label (only blocks of that
label), the second the ``NEGATIVES`` best rows of other labels in the window below each of them.

Rows with a null label, vector or vec_id, or with a null or non-finite component (or one whose
256-fold no double holds), take no part. Rows that share a vec_id are one row, the smallest by label
and components. Only vectors of equal length are compared; empty vectors score 0. Equal scores are
ordered by vec_id. An anchor without another row of its label, or whose windows are empty, has no row
in the result; so has an empty table. Scores beyond a long are given as the nearest long, and are
compared exactly up to 38 digits. Input columns other than the three are ignored.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.llm.common import staged

ANCHORS = 50
POSITIVES = 5
NEGATIVES = 3
#: A window: from LOWEST to HIGHEST per cent of the positive's score.
LOWEST, HIGHEST = 50, 95
#: Rows and anchors of a block, and dimensions read between two prunings.
ROWS = 2048
ANCHOR_ROWS = 4096
STEP = 8
_EXACT = 1 << 53
#: Scores between the two scans are exact up to this many digits.
_DIGITS = 38
_SCORE = pa.decimal128(_DIGITS, 0)


def quantized(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and whole components v of the rows that take part, one row for each vec_id."""
    scaled = "256D * CAST(x AS DOUBLE)"
    whole = (
        f"transform(embedding, x -> CASE WHEN abs({scaled}) < 4503599627370496D "
        f"THEN CAST(floor({scaled}) AS DOUBLE) ELSE {scaled} END)"
    )
    usable = (
        "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND NOT exists(embedding, "
        f"x -> x IS NULL OR isnan(x) OR abs({scaled}) = double('infinity'))"
    )
    moved = "CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END"
    rows = embeddings.where(usable).selectExpr(
        "CAST(vec_id AS BIGINT) AS vec_id",
        f"struct(CAST({moved} AS BIGINT) AS label, {whole} AS v) AS row",
    )
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


class Block:
    """The vectors of one block by dimension, with the extremes of each."""

    def __init__(self, rows: pa.Table):
        self.ids = rows["vec_id"].to_numpy()
        self.labels = rows["label"].to_numpy()
        self.columns = np.ascontiguousarray(_matrix(rows).T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        self.most = float(np.abs(self.columns).max(initial=0))

    def scan(self, anchor: np.ndarray, first: np.ndarray, stays: Callable):
        """Positions of the rows of ``first`` that stay to the end, and their exact scores."""
        columns, low, high = self.columns, self.low, self.high
        if self.most * float(np.abs(anchor).max(initial=0)) * max(1, len(anchor)) >= _EXACT:
            anchor, columns, low, high = (_unbounded(x) for x in (anchor, columns, low, high))
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * low, anchor * high])[:, order]
        # What the dimensions from a place in the order on can add, at least and at most.
        least = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        most = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        alive, scores = first, np.zeros(len(first), dtype=anchor.dtype)
        for at in range(0, len(order), STEP):
            dims = order[at : at + STEP]
            read = columns[dims] if len(alive) == columns.shape[1] else columns[dims][:, alive]
            scores = scores + anchor[dims] @ read
            rest = min(at + STEP, len(order))
            kept = stays(scores + least[rest], scores + most[rest])
            alive, scores = alive[kept], scores[kept]
            if not len(alive):
                break
        return alive, scores


def _matrix(rows: pa.Table) -> np.ndarray:
    lists = rows["v"].combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)


def _unbounded(values: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python integers, for products that doubles cannot hold."""
    return np.array([int(x) for x in values.ravel()], dtype=object).reshape(values.shape)


def _best(ids: np.ndarray, scores: np.ndarray, count: int) -> list[tuple[int, int]]:
    if len(ids) > 4 * count and scores.dtype != object:
        kept = scores >= np.partition(scores, -count)[-count]
        ids, scores = ids[kept], scores[kept]
    ranked = sorted(zip(scores.tolist(), ids.tolist()), key=lambda x: (-x[0], x[1]))
    return [(i, int(s)) for s, i in ranked[:count]]


def _reaches(count: int) -> Callable:
    """Keeps what can still be among the ``count`` best."""

    def stays(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        if len(least) <= count:
            return np.ones(len(least), dtype=bool)
        if least.dtype == object:
            return (most >= sorted(least)[-count]).astype(bool)
        return most >= np.partition(least, -count)[-count]

    return stays


def _meets(windows: Iterable[tuple[int, int]], count: int) -> Callable:
    """Keeps what can still be among the ``count`` best inside one of ``windows``."""
    windows = {(low, high) for low, high in windows if low <= high}

    def stays(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(least), dtype=bool)
        for low, high in windows:
            inside = least[((least >= low) & (most <= high)).astype(bool)]
            # So many surely lie in the window: the worst of the best bounds what can enter.
            if len(inside) >= count:
                low = max(low, sorted(inside)[-count])
            kept |= ((most >= low) & (least <= high)).astype(bool)
        return kept

    return stays


def window_of(positive_score: int) -> tuple[int, int]:
    """The whole scores n with LOWEST * p <= 100 * n <= HIGHEST * p; empty if the first is larger."""
    return -(-LOWEST * positive_score // 100), HIGHEST * positive_score // 100


def _positives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    found: list[tuple] = []
    if anchors.num_rows and rows.num_rows:
        block = Block(rows)
        for anchor, vector in zip(anchors["vec_id"].to_pylist(), _matrix(anchors)):
            others = np.flatnonzero(block.ids != anchor)
            kept, scores = block.scan(vector, others, _reaches(POSITIVES))
            best = _best(block.ids[kept], scores, POSITIVES)
            found += [(anchor, i, s) for i, s in best]
    return _table(found, ("anchor_id", "positive_id", "positive_score"))


def _negatives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    found: list[tuple] = []
    if anchors.num_rows and rows.num_rows:
        block = Block(rows)
        wanted = zip(
            anchors["vec_id"].to_pylist(),
            anchors["label"].to_pylist(),
            anchors["positives"].to_pylist(),
            _matrix(anchors),
        )
        for anchor, label, positives, vector in wanted:
            windows = {p["positive_id"]: window_of(int(p["positive_score"])) for p in positives}
            others = np.flatnonzero(block.labels != label)
            kept, scores = block.scan(vector, others, _meets(windows.values(), NEGATIVES))
            for p in positives:
                low, high = windows[p["positive_id"]]
                inside = ((scores >= low) & (scores <= high)).astype(bool)
                best = _best(block.ids[kept][inside], scores[inside], NEGATIVES)
                found += [(anchor, p["positive_id"], p["positive_score"], i, s) for i, s in best]
    names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
    return _table(found, names)


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = {}
    most = 10**_DIGITS - 1
    for name, column in zip(names, zip(*rows) if rows else ([] for _ in names)):
        if name.endswith("score"):
            whole = (decimal.Decimal(min(max(int(x), -most), most)) for x in column)
            columns[name] = pa.array(whole, _SCORE)
        else:
            columns[name] = pa.array(column, pa.int64())
    return pa.table(columns)


def _as_long(column: str) -> Column:
    """The nearest long."""
    low, high = (F.lit(decimal.Decimal(x)) for x in (-(1 << 63), (1 << 63) - 1))
    return F.least(F.greatest(F.col(column), low), high).cast("bigint").alias(column)


def _meet(asks: DataFrame, meets: DataFrame, key: list[str], scan: Callable, schema: str) -> DataFrame:
    """``scan(anchors, rows)`` of every pair of blocks with equal ``key``."""
    # Both sides come from one table: the renaming gives one of them attributes of its own.
    renamed = asks.toDF(*asks.columns)
    return renamed.groupBy(*key).cogroup(meets.groupBy(*key)).applyInArrow(scan, schema)


def _blocks(count: str, size: int) -> str:
    return f"greatest(1, CAST(ceil({count} / {size}) AS INT))"


def _each(count: str, name: str):
    return F.explode(F.expr(f"sequence(0, {count} - 1)")).alias(name)


def positives(rows: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, positive_score): the best other rows of each anchor's label."""
    anchor = F.col("vec_id") % ANCHORS == 0
    sizes = rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(anchor, 1)).alias("m")
    )
    sizes = sizes.where("m > 0").selectExpr(
        "label", f"{_blocks('n', ROWS)} AS bs", f"{_blocks('m', ANCHOR_ROWS)} AS as"
    )
    sized = rows.join(sizes, "label").withColumn("dim", F.size("v"))
    key = ["label", "dim", "a", "b"]
    # Every block of a label's rows meets every block of its anchors.
    meets = sized.select(
        "*", _each("as", "a"), F.expr("pmod(xxhash64(vec_id), bs)").cast("int").alias("b")
    ).select(*key, "vec_id", "v")
    asks = sized.where(anchor).select(
        "*", _each("bs", "b"), F.expr("pmod(xxhash64(vec_id), as)").cast("int").alias("a")
    ).select(*key, "vec_id", "v")
    schema = f"anchor_id bigint, positive_id bigint, positive_score decimal({_DIGITS}, 0)"
    found = _meet(asks, meets, key, _positives, schema)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= POSITIVES)


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = staged(quantized(embeddings), "vectors")
    found = staged(positives(rows).drop("place"), "positives")
    # Below a negative score the window is empty.
    listed = found.where("positive_score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    )
    asking = staged(rows.join(listed, "vec_id"), "asking")
    bs = max(1, math.ceil(rows.count() / ROWS))
    as_ = max(1, math.ceil(asking.count() / ANCHOR_ROWS))
    key = ["dim", "a", "b"]

    def block(count: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    meets = rows.select(
        F.size("v").alias("dim"), _each(str(as_), "a"), block(bs).alias("b"), "vec_id", "label", "v"
    )
    asks = asking.select(
        F.size("v").alias("dim"), block(as_).alias("a"), _each(str(bs), "b"), *asking.columns
    )
    schema = (
        f"anchor_id bigint, positive_id bigint, positive_score decimal({_DIGITS}, 0), "
        f"negative_id bigint, negative_score decimal({_DIGITS}, 0)"
    )
    pairs = _meet(asks, meets, key, _negatives, schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(
        F.desc("negative_score"), "negative_id"
    )
    return (
        pairs.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= NEGATIVES)
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            "negative_id",
            _as_long("positive_score"),
            _as_long("negative_score"),
        )
    )
