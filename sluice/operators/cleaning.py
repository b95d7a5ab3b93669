"""Raw snapshot rows to typed, normalised, masked rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.casts import whole_number
from sluice.model import BUSINESS_DATE, ENTITIES
from sluice.operators.dedup import latest_snapshot_rows

# Fixed value: where the business date stands in a landing path.
ODATE_IN_PATH = r"(?:^|/)odate=(\d{4}-\d{2}-\d{2})(?:/|$)"

# Raw rows of one typed key up to which ``clean_counted`` gathers them in one task.
HOT_ROWS = 100_000
_HOME, _HOT = "__home", "__hot"


def path_odate(path: Column) -> Column:
    """The business date named by a landing path, NULL where it names none."""
    return F.regexp_extract(path, ODATE_IN_PATH, 1).try_cast("date")


def with_effective_odate(frame: DataFrame, path: str = "_source_file") -> DataFrame:
    known = F.coalesce(F.col(BUSINESS_DATE), path_odate(F.col(path)))
    return frame.withColumn(BUSINESS_DATE, known)


def snapshot_of(frame: DataFrame, odate: date, path: str = "_source_file") -> DataFrame:
    """Rows whose effective business date is ``odate``.

    The filter names the bare partition column first, so only the wanted
    partition and the NULL partition are listed and read.
    """
    stored = F.col(BUSINESS_DATE)
    lost = stored.isNull() & (path_odate(F.col(path)) == F.lit(odate))
    chosen = frame.where((stored == F.lit(odate)) | lost)
    return chosen.withColumn(BUSINESS_DATE, F.lit(odate).cast("date"))


def clean(
    raw: DataFrame,
    entity_name: str,
    for_gate: bool = False,
    dedup_on: str = "raw",
) -> DataFrame:
    """Deduplicate, type, normalise, mask, and drop rows without required values.

    ``dedup_on="raw"`` compares the key text, so ``17`` and ``17.0`` both survive
    and the uniqueness rule reports them. ``"typed"`` compares the typed key.
    """
    if entity_name not in ENTITIES:
        raise ValueError(f"unknown entity {entity_name!r}")
    if dedup_on not in ("raw", "typed"):
        raise ValueError("dedup_on must be 'raw' or 'typed'")
    entity = ENTITIES[entity_name]
    if dedup_on == "typed":
        raw = raw.withColumn(
            entity.key, F.col(entity.key).try_cast("double").try_cast("bigint").cast("string")
        )
    typed = latest_snapshot_rows(raw, entity.key).select(*entity.typed_columns(for_gate))
    return typed.na.drop(subset=list(entity.required))


def clean_counted(
    raw: DataFrame, entity_name: str, copies: str, for_gate: bool = False
) -> DataFrame:
    """``clean`` with ``copies``: how many cleaned rows have the row's typed key.

    Whole rows are shuffled once, by typed key, and sorted behind that shuffle only: texts of
    one typed key lie together, so deduplication and count need no further one. Keys with
    more than ``HOT_ROWS`` raw rows, found by a narrow count, and NULL are reduced below the
    shuffle instead. They are few, so their counts are broadcast.
    """
    entity = ENTITIES[entity_name]
    keyed = raw.withColumn(_HOME, whole_number(entity.key))
    hot = F.broadcast(
        keyed.groupBy(F.col(_HOME).alias(_HOT))
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where((F.col("__rows") > HOT_ROWS) | F.col(_HOT).isNull())
        .select(_HOT)
    )
    same = F.col(_HOME).eqNullSafe(F.col(_HOT))

    def cleaned(rows: DataFrame, within: tuple[str, ...]) -> DataFrame:
        kept = latest_snapshot_rows(rows, entity.key, within)
        typed = kept.select(*entity.typed_columns(for_gate), _HOME)
        return typed.na.drop(subset=list(entity.required))

    one = F.count(F.lit(1))
    few = cleaned(keyed.join(hot, same, "left_anti"), (_HOME,))
    few = few.withColumn(copies, one.over(Window.partitionBy(_HOME)))
    many = cleaned(keyed.join(hot, same, "left_semi"), ())
    counts = many.groupBy(F.col(_HOME).alias(_HOT)).agg(one.alias(copies))
    many = many.join(F.broadcast(counts), same).drop(_HOT)
    return few.unionByName(many).drop(_HOME)
