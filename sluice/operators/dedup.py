"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice.operators.once import with_columns_once

_RANK = "__rank"
_TEXTS, _VALUES = "__texts", "__values"
# What a packed text holds for NULL, behind each value, and for these three signs in a value.
_NULL, _END, _SIGN = "\u0000", "\u0001", "\u0002"
_ESCAPED = {_SIGN: _SIGN + "\u0005", _NULL: _SIGN + "\u0003", _END: _SIGN + "\u0004"}


def keep_latest(
    frame: DataFrame,
    keys: Sequence[str | Column],
    newest_first: Sequence[Column],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the first in ``newest_first`` order.

    NULL keys form one group. ``tie_break`` columns (descending, NULLs last) make
    the order total, so reruns and recomputed tasks keep the same row. The
    ``row_number() = 1`` filter lets Spark place a partial WindowGroupLimit below
    the shuffle: each map task sends at most one row per key, so a key that owns
    a third of the input still reaches its reducer as a handful of rows.
    """
    order = [*newest_first, *(F.col(name).desc_nulls_last() for name in tie_break)]
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return frame.withColumn(_RANK, ranked).where(F.col(_RANK) == 1).drop(_RANK)


def packed(names: Sequence[str]) -> Column:
    """Text columns as one text that sorts like them, one after the other, NULL first.

    Sorting and shuffling move whole rows, and a column of short text takes three
    or four times its length there.
    """
    parts = []
    for name in names:
        value = F.col(name)
        for sign, code in _ESCAPED.items():
            value = F.replace(value, F.lit(sign), F.lit(code))
        parts += [F.coalesce(value, F.lit(_NULL)), F.lit(_END)]
    return F.concat(*parts)


def unpacked(frame: DataFrame, text: str, names: Sequence[str]) -> DataFrame:
    """The columns of ``packed`` in place of it, byte by byte as they were.

    A text is cut once, however often filters behind refer to its columns. ``split``
    mends broken UTF-8, so texts that have some, or escaped signs, are cut by bytes.
    """
    whole = F.col(text)
    cut = [
        F.substring_index(F.substring_index(whole, _END, place), _END, -1)
        for place in range(1, len(names) + 1)
    ]
    easy = F.is_valid_utf8(whole) & ~F.contains(whole, F.lit(_SIGN))
    values = F.when(easy, F.transform(F.split(whole, _END), _present)).otherwise(
        F.transform(F.array(*cut), lambda value: _unescaped(_present(value)))
    )
    found = with_columns_once(frame, {_VALUES: values}).withColumns(
        {name: F.get(_VALUES, F.lit(place)) for place, name in enumerate(names)}
    )
    return found.drop(text, _VALUES)


def _present(value: Column) -> Column:
    return F.nullif(value, F.lit(_NULL))


def _unescaped(value: Column) -> Column:
    for sign, code in reversed(_ESCAPED.items()):
        value = F.replace(value, F.lit(code), F.lit(sign))
    return value


def latest_snapshot_rows(frame: DataFrame, key: str, within: Sequence[str] = ()) -> DataFrame:
    """Latest ingested copy of each raw key inside one snapshot.

    One file carries one ingestion time, so equal order values are the normal
    case; the remaining columns decide between differing copies. ``within`` names
    columns that follow from the key: rows are moved by them, unsorted and unreduced.
    """
    lineage = ("_ingested_at", "_source_file")
    others = [name for name in frame.columns if name not in (key, *within, *lineage)]
    keys = [*within, key]
    # The texts from the source file on stand next to each other in the order.
    kinds = {field.name: field.dataType for field in frame.schema.fields}
    texts = []
    for name in ("_source_file", *others):
        if kinds[name] != StringType():
            break
        texts.append(name)
    if not texts:
        frame = frame.repartition(*within) if within else frame
        kept = keep_latest(
            frame, keys, [F.col(name).desc_nulls_last() for name in lineage], tie_break=others
        )
        return kept.drop("_rescued_data", "_corrupt_record")
    behind = [name for name in ("_source_file", *others) if name not in texts]
    slim = frame.select(*keys, "_ingested_at", packed(texts).alias(_TEXTS), *behind)
    slim = slim.repartition(*within) if within else slim
    newest = [F.col(name).desc_nulls_last() for name in ("_ingested_at", _TEXTS)]
    kept = keep_latest(slim, keys, newest, tie_break=behind)
    whole = unpacked(kept, _TEXTS, texts).select(*frame.columns)
    return whole.drop("_rescued_data", "_corrupt_record")
