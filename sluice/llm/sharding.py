"""Sharding by extendible hashing, with DataFrame functions only.

A row's hash has ``BITS`` bits: the first half from its key, the second half from the key and the
``spread`` columns, so that rows of one frequent key still part. A directory is indexed by a prefix
of the hash. Starting from one bucket, every bucket above the byte limit splits on its next bit and
no other does: a row's shard is the shortest prefix whose rows fit the limit. The directory begins as
deep as the total size asks for and only its cells that are still too large are deepened.

Bytes are those of the size column as UTF-8, null counts 0. Null key or spread values hash like the
empty text. A bucket that has used all bits (true copies of one row) and one whose single row is
over the limit stay whole: rows are never cut or dropped; ``oversized`` marks their shard. An empty
table has no shards. Input columns with a name of an added column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import staged, unused

BITS = 60
#: Bits beyond log2(total / limit) at the start, and bits added to cells that are too large.
SPARE = 3
DEEPER = 10
LIMIT = 16 * 1024 * 1024


def _half(columns: list[str]) -> Column:
    joined = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    number = F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")
    return F.shiftright(number, 32 - BITS // 2)


def hash_bits(key: list[str], spread: list[str]) -> Column:
    return F.shiftleft(_half(key), BITS // 2).bitwiseOR(_half([*key, *spread]))


def _cell(bits: str, depth: int) -> Column:
    return F.shiftright(bits, BITS - depth)


def _directory(cells: DataFrame, above: int, depth: int, limit: int) -> DataFrame:
    """(cell, shard_depth, shard_bytes) of cells at ``depth``; null depth where all are too large.

    Buckets of more than ``above`` bits are considered; a cell's bucket is the shortest that fits.
    """
    levels = cells.withColumn("level", F.explode(F.sequence(F.lit(above), F.lit(depth)))).withColumn(
        "bucket", F.expr(f"shiftright(cell, {depth} - level)")
    )
    fits = (
        levels.groupBy("level", "bucket")
        .agg(F.sum("bytes").alias("total"))
        .where((F.col("total") <= limit) | (F.col("level") == BITS))
    )
    return (
        levels.join(fits, ["level", "bucket"], "left")
        .groupBy("cell")
        .agg(
            F.min(F.when(F.col("total").isNotNull(), F.struct("level", "total"))).alias("shard")
        )
        .select(
            "cell",
            F.col("shard.level").alias("shard_depth"),
            F.col("shard.total").alias("shard_bytes"),
        )
    )


def with_shards(
    rows: DataFrame,
    key: list[str],
    spread: list[str],
    size: str,
    limit: int = LIMIT,
) -> DataFrame:
    """``rows`` with shard (its hash prefix in binary), shard_bytes and oversized."""
    kept = rows.drop("shard", "shard_bytes", "oversized")
    # Three columns, and three for every round.
    rounds = BITS // DEEPER + 2
    bits, bytes_, used, *free = unused(kept.columns, 3 + 3 * rounds)
    hashed = kept.withColumn(bits, hash_bits(key, spread)).withColumn(
        bytes_, F.coalesce(F.octet_length(size), F.lit(0)).cast("bigint")
    )
    small = hashed.select(bits, bytes_)
    total = small.agg(F.sum(bytes_)).first()[0] or 0
    depth = min(BITS, max(0, math.ceil(math.log2(max(1.0, total / limit)))) + SPARE)
    cells = small.groupBy(_cell(bits, depth).alias("cell")).agg(F.sum(bytes_).alias("bytes"))
    above, found, depths, sums = 0, hashed, [], []
    while True:
        directory = staged(_directory(cells, above, depth, limit), "directory")
        cell, shard_depth, shard_bytes = free[:3]
        free = free[3:]
        here = directory.where("shard_depth IS NOT NULL").select(
            F.col("cell").alias(cell),
            F.col("shard_depth").alias(shard_depth),
            F.col("shard_bytes").alias(shard_bytes),
        )
        found = found.join(here, _cell(bits, depth) == F.col(cell), "left")
        depths.append(shard_depth)
        sums.append(shard_bytes)
        large = directory.where("shard_depth IS NULL").select(F.col("cell").alias("large"))
        if not large.limit(1).count():
            break
        # Only the rows of cells that are too large go one round deeper.
        small = small.join(large, _cell(bits, depth) == F.col("large"), "left_semi")
        above, depth = depth + 1, min(BITS, depth + DEEPER)
        cells = small.groupBy(_cell(bits, depth).alias("cell")).agg(F.sum(bytes_).alias("bytes"))
    total_bytes = F.coalesce(*sums)
    return found.withColumn(used, F.coalesce(*depths)).select(
        *(F.col(f"`{c}`") for c in kept.columns),
        F.when(F.col(used) == 0, "")
        .otherwise(F.expr(f"lpad(bin(shiftright({bits}, {BITS} - {used})), {used}, '0')"))
        .alias("shard"),
        total_bytes.alias("shard_bytes"),
        (total_bytes > limit).alias("oversized"),
    )
