"""Evaluate rules over a frame: annotate, split, count.

Key rules never use an unbounded window: repeated keys come from a
``groupBy().count()``, which is pre-aggregated before its shuffle, and are joined
back. The joined side holds one row per repeated key; AQE broadcasts it when its
measured size allows and splits hot partitions of the other side otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.once import with_columns_once
from sluice.operators.rules import (
    Rule,
    any_failed,
    failed_names,
    key_rules,
    row_failed,
    row_rules,
)

ERRORS = "_dq_errors"

# Up to this many repeated keys are broadcast; their number is counted first.
BROADCAST_KEYS = 500_000


def repeated_keys(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    counted = frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    return counted.where(F.col("__copies") > 1)


def _flag_repeated(
    frame: DataFrame, rules: Sequence[Rule], counted: int | None, copies: str | None = None
) -> tuple[DataFrame, dict[str, Column]]:
    """Add one marker column per key rule; ``counted`` is a known key count.

    ``copies`` names a column of ``frame`` with the rows of the row's key, if there is one; with
    it nothing is joined.
    """
    flags: dict[str, Column] = {}
    if copies is not None:
        keyed = key_rules(rules)
        if len(keyed) != 1:
            raise ValueError("copies are counted for rules with one key rule")
        return frame, {keyed[0].name: F.col(copies) > 1}
    for number, rule in enumerate(key_rules(rules)):
        if counted == 0:
            flags[rule.name] = F.lit(False)
            continue
        marker = f"__repeated{number}"
        renamed = [F.col(name).alias(f"{marker}_{name}") for name in rule.unique_on]
        repeated = repeated_keys(frame, rule.unique_on).select(*renamed, F.lit(True).alias(marker))
        if counted is not None and counted <= BROADCAST_KEYS:
            repeated = F.broadcast(repeated)
        same_key = [
            F.col(name).eqNullSafe(F.col(f"{marker}_{name}")) for name in rule.unique_on
        ]
        frame = frame.join(repeated, on=same_key, how="left").drop(
            *(f"{marker}_{name}" for name in rule.unique_on)
        )
        flags[rule.name] = F.col(marker).isNotNull()
    return frame, flags


def _failures(rules: Sequence[Rule], flags: dict[str, Column]) -> list[tuple[str, Column]]:
    return [(r.name, flags[r.name] if r.unique_on else r.failed) for r in rules]


def _without(frame: DataFrame, copies: str | None) -> list[str]:
    return [name for name in frame.columns if name != copies]


def annotate(
    frame: DataFrame, rules: Sequence[Rule], errors: str = ERRORS, copies: str | None = None
) -> DataFrame:
    """Every row with the array of the rules it violates."""
    flagged, flags = _flag_repeated(frame, rules, None, copies)
    names = failed_names(_failures(rules, flags))
    return flagged.select(*_without(frame, copies), names.alias(errors))


def rejected(
    frame: DataFrame,
    rules: Sequence[Rule],
    repeated: int | None = None,
    errors: str = ERRORS,
    copies: str | None = None,
) -> DataFrame:
    """Only the violating rows. ``repeated`` is the key count of ``tally``, if known.

    The boolean filter comes first, so the name array is built for bad rows only.
    """
    flagged, flags = _flag_repeated(frame, rules, repeated, copies)
    failures = _failures(rules, flags)
    bad = flagged.where(any_failed(failed for _, failed in failures))
    return bad.select(*_without(frame, copies), failed_names(failures).alias(errors))


def accepted(
    frame: DataFrame, rules: Sequence[Rule], copies: str | None = None
) -> DataFrame:
    """Only the rows that break no rule.

    With key rules the verdict is computed above the join. Its parts would else be
    pushed into one side of it only, and that side could no longer share the
    shuffle of ``frame`` with the search for repeated keys.
    """
    if not key_rules(rules):
        return frame.where(~row_failed(rules)).select(*_without(frame, copies))
    flagged, flags = _flag_repeated(frame, rules, None, copies)
    bad = any_failed(failed for _, failed in _failures(rules, flags))
    judged = with_columns_once(flagged, {"__bad": bad})
    return judged.where(~F.col("__bad")).select(*_without(frame, copies))


def accepted_keys(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The keys of the rows that break no rule, from one narrow shuffle of (key, two counters)."""
    keyed = key_rules(rules)
    if len(keyed) != 1:
        raise ValueError("keys are accepted by rules with one key rule")
    key = keyed[0].unique_on
    counted = frame.groupBy(*key).agg(
        F.count(F.lit(1)).alias("__copies"), F.count_if(row_failed(rules)).alias("__bad")
    )
    return counted.where((F.col("__copies") == 1) & (F.col("__bad") == 0)).select(*key)


def split(frame: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): disjoint, together all rows of ``frame``."""
    return accepted(frame, rules), rejected(frame, rules)


def tally(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: checked_rows, valid_rows, quarantined_rows, repeated_keys.

    With a single key rule no join is needed: rows are counted per key with a
    partial aggregate, a repeated key rejects all its rows, any other key only
    those that break a row rule. One scan, one shuffle of (key, two counters).
    """
    keyed = key_rules(rules)
    bad = row_failed(rules)
    if len(keyed) == 1:
        per_key = frame.groupBy(*keyed[0].unique_on).agg(
            F.count(F.lit(1)).alias("copies"), F.count_if(bad).alias("bad")
        )
        repeated = F.col("copies") > 1
        counts = per_key.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("checked_rows"),
            F.coalesce(
                F.sum(F.when(repeated, F.col("copies")).otherwise(F.col("bad"))), F.lit(0)
            ).alias("quarantined_rows"),
            F.count_if(repeated).alias("repeated_keys"),
        )
    else:
        flagged, flags = _flag_repeated(frame, rules, None)
        broken = any_failed(failed for _, failed in _failures(rules, flags))
        counts = flagged.agg(
            F.count(F.lit(1)).alias("checked_rows"),
            F.count_if(broken).alias("quarantined_rows"),
            (F.lit(None).cast("bigint") if keyed else F.lit(0).cast("bigint")).alias(
                "repeated_keys"
            ),
        )
    return counts.select(
        "checked_rows",
        (F.col("checked_rows") - F.col("quarantined_rows")).alias("valid_rows"),
        "quarantined_rows",
        "repeated_keys",
    )


def rule_outcomes(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Passed and failed rows of each row rule, as one row per rule.

    All counters come from a single aggregate over the frame.
    """
    checked = row_rules(rules)
    counters = [F.count_if(rule.failed).alias(rule.name) for rule in checked]
    total = frame.agg(F.count(F.lit(1)).alias("__rows"), *counters)
    pairs = ", ".join(f"'{rule.name}', `{rule.name}`" for rule in checked)
    return total.select(
        "__rows", F.expr(f"stack({len(checked)}, {pairs}) AS (dq_rule, failed_records)")
    ).select(
        "dq_rule",
        (F.col("__rows") - F.col("failed_records")).alias("passed_records"),
        "failed_records",
    )
