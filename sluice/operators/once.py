"""Evaluate derived columns exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` for expensive expressions that later filters refer to.

    Catalyst pushes a filter below the projection that defines its columns by
    inlining their expressions, so a rule pack over a parsed payload would parse
    it once per mention. Columns emitted by a one-element ``inline`` are plain
    attributes: nothing is inlined, and the row count does not change.
    """
    row = F.struct(*(value.alias(name) for name, value in columns.items()))
    kept = [name for name in frame.columns if name not in columns]
    added = [name for name in columns if name not in frame.columns]
    return frame.select(*kept, F.inline(F.array(row))).select(*frame.columns, *added)
