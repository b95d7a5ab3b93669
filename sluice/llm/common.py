"""Helpers shared by the text operators: words, word hashes, staged tables, components."""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_path

#: ``bytes.split()`` cuts at exactly these bytes: space and 0x09-0x0D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_START = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_PRIME = np.uint64((1 << 31) - 1)
_BASES = (1_103_515_245, 862_048_943)
_POWERS: dict[int, np.ndarray] = {}
#: Masks of the first 0 to 8 bytes of a little-endian number.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
#: Longer words are hashed one by one.
_LONG_WORD = 4096
#: A text is hashed in pieces of about this many bytes, so arrays stay small.
_PIECE = 1 << 22


#: Whether Spark deletes the shuffle files of a query as soon as the query has ended.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession):
    """Shuffle files of the queries that run inside are deleted as soon as a query has ended.

    Nothing else may use them, as a cached frame does.
    """
    before = spark.conf.get(_FREED)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def staged(frame: DataFrame, label: str, free: bool = False) -> DataFrame:
    """``frame`` written to the shared folder and read again, ``free``: as in ``freed``.

    This cuts the lineage: a lost executor costs a reread, not a recomputation.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    with freed(spark) if free else nullcontext():
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def unused(columns: Iterable[str], count: int) -> list[str]:
    """Column names that none of ``columns`` has, in any case of letters."""
    taken = {name.lower() for name in columns}
    free = (name for n in itertools.count() if (name := f"_own{n}") not in taken)
    return list(itertools.islice(free, count))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped(frame: DataFrame, rows: Callable[[pa.RecordBatch], Iterable[dict]], schema: str):
    """``mapInArrow`` by a function from one batch to column dictionaries.

    Batches are cut to a few hundred rows, so one step holds a bounded number of texts.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for columns in rows(batch.slice(start, 256)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            values
                            if isinstance(values, pa.Array)
                            else pa.array(values, type=field.type)
                            for field, values in ((f, columns[f.name]) for f in arrow)
                        ],
                        schema=arrow,
                    )

    return frame.mapInArrow(run, schema)


def counted(frame: DataFrame, update: Callable, schema: str, limit: int = 200_000) -> DataFrame:
    """Partial counts: rows (key, n) of what ``update(counter, batch)`` adds, emptied at ``limit``."""
    key, kind = schema.split(",")[0].split()
    first = pa.field(key, {"string": pa.string(), "binary": pa.binary()}[kind])
    arrow = pa.schema([first, ("n", pa.int64())])

    def emptied(seen: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(seen), first.type), pa.array(list(seen.values()), pa.int64())]
        seen.clear()
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                update(seen, batch.slice(start, 64))
                if len(seen) >= limit:
                    yield emptied(seen)
        yield emptied(seen)

    return frame.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of every text, None for null."""
    for value in column.cast(pa.binary()):
        yield value.as_py()


def list_array(values: np.ndarray, lengths: Iterable[int], kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row's list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def flat(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=dtype)


def powers(base: int, length: int) -> np.ndarray:
    """``base ** n`` in the field, for n below ``length``."""
    known = _POWERS.get(base, np.ones(1, dtype=np.uint64))
    while len(known) < length:
        step = np.uint64(pow(base, len(known), int(_PRIME)))
        known = np.concatenate([known, known * step % _PRIME])
    _POWERS[base] = known
    return known[:length]


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that low and high bits are usable on their own."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word, in order. Equal words have equal hashes."""
    if len(text) <= _PIECE:
        return _word_hashes(text)
    parts, start = [], 0
    while start < len(text):
        end = min(start + _PIECE, len(text))
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        parts.append(_word_hashes(text[start:end]))
        start = end
    return flat(parts, np.uint64)


def words_between(text: bytes, edges: np.ndarray) -> np.ndarray:
    """How many words of a text begin between each two neighbouring places."""
    inside = np.zeros(len(text) + 1, dtype=bool)
    inside[1:] = ~_SPACE[np.frombuffer(text, dtype=np.uint8)]
    return np.diff(np.searchsorted(np.flatnonzero(inside[1:] & ~inside[:-1]), edges))


def _word_hashes(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    steps = np.diff(inside)
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    lengths = ends - starts
    found = mixed(lengths.astype(np.uint64) + _START)
    if not len(starts):
        return found
    # The eight bytes from every place on, as one number.
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    open_ = np.flatnonzero(lengths <= _LONG_WORD)
    at, left = starts[open_], lengths[open_]
    while len(open_):
        chunk = eight[at] & _MASKS[np.minimum(left, 8)]
        found[open_] = mixed((found[open_] ^ chunk) * _FACTOR + _START)
        more = left > 8
        open_, at, left = open_[more], at[more] + 8, left[more] - 8
    for place in np.flatnonzero(lengths > _LONG_WORD).tolist():
        word = hashlib.blake2b(text[starts[place] : ends[place]], digest_size=8).digest()
        found[place] = int.from_bytes(word, "little")
    return found


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` consecutive words."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    parts = []
    for sums, back in _prefix_sums(hashes):
        part = (sums[length:] - sums[:count]) % _PRIME
        parts.append(part * back[:count] % _PRIME)
    return _named(parts, np.full(1, length, dtype=np.uint64))


def spans_hash(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of words ``[start, end)``, equal for equal word sequences."""
    parts = []
    for sums, back in _prefix_sums(hashes):
        parts.append((sums[ends] - sums[starts]) % _PRIME * back[starts] % _PRIME)
    return _named(parts, (ends - starts).astype(np.uint64))


def _prefix_sums(hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Two polynomials over a prime field: sums up to every place, and factors that shift back.

    Modulo a power of two such sums of long regular runs can all vanish; in a field they do not.
    """
    for shift, base in zip((0, 33), _BASES):
        terms = ((hashes >> np.uint64(shift)) & _PRIME) * powers(base, len(hashes)) % _PRIME
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        # Less than 2 ** 31 each, so no sum of a text's words overflows.
        np.cumsum(terms, out=sums[1:])
        yield sums, powers(pow(base, -1, int(_PRIME)), len(hashes) + 1)


def _named(parts: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    return mixed((parts[0] << np.uint64(31) | parts[1]) + lengths * _FACTOR + _START)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every window of ``width`` values, by doubling."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    size, current = 1, values
    while size * 2 <= width:
        current = np.minimum(current[:-size], current[size:])
        size *= 2
    return np.minimum(current[:count], current[width - size : width - size + count])


def bucket(column: Column, modulus: int) -> Column:
    """``crc32`` of a value's text modulo ``modulus``; null values go to bucket 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus, F.lit(0))


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of ``edges(a, b)``: (id, component), component the smallest id.

    Only ids that have an edge are returned. Every round takes the smallest label among the
    neighbours and then the label of that label, so chains shorten geometrically; each round is a
    table in the shared folder. Self-links are harmless, null ends are not allowed.
    """
    both = staged(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), label
    )
    spark = edges.sparkSession
    labels = staged(
        both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")),
        label,
    )
    while True:
        # The smallest label around each id; the id's own label takes part as well.
        around = both.join(labels.withColumnRenamed("id", "b"), "b").select(
            F.col("a").alias("id"), "component"
        )
        lower = around.union(labels).groupBy("id").agg(F.min("component").alias("component"))
        lower = staged(lower, label)
        # Whatever carries label L moves on to the label that L itself has now; and an id that is
        # a label adopts the smallest label its followers have found.
        roots = lower.select(F.col("id").alias("root"), F.col("component").alias("above"))
        jumped = (
            lower.withColumnRenamed("component", "root")
            .join(roots, "root", "left")
            .select("id", F.coalesce("above", "root").alias("component"))
        )
        found = labels.withColumnRenamed("component", "old").join(lower, "id")
        pulled = found.groupBy(F.col("old").alias("id")).agg(
            F.min("component").alias("component")
        )
        after = staged(
            jumped.union(pulled).groupBy("id").agg(F.min("component").alias("component")), label
        )
        changed = (
            after.join(labels.withColumnRenamed("component", "old"), "id")
            .where("component <> old")
            .limit(1)
            .count()
        )
        labels = after
        if not changed:
            return labels


def as_signed(values: np.ndarray) -> np.ndarray:
    """uint64 hashes as the bigint values that Spark stores."""
    return values.view(np.int64)
