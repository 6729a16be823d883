"""Reject accounting: which rule removed a row, and how many each rule removed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failed_rule(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule (in order) whose predicate is not true; NULL if all pass.

    Rules apply in sequence, so a row is charged to the first rule only.
    """
    return F.coalesce(*[F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules])


def reject_table(
    entity: str,
    classified: DataFrame,
    rule_col: str,
    rule_names: Sequence[str],
    copies_col: str | None = None,
    duplicate_rule: str = "duplicate_key",
    weight_col: str | None = None,
    removed_col: str | None = None,
) -> DataFrame:
    """One aggregate pass -> rows (entity, rule, rejected), one per rule, zeros included.

    ``classified`` carries ``rule_col`` (from :func:`first_failed_rule`).
    It is either one row per deduplicated row, with ``copies_col`` (the
    copies count of :func:`keep_first`), or pre-counted rows, with
    ``weight_col`` (rows per class) and ``removed_col`` (copies removed by
    deduplication).
    """
    weight = F.col(weight_col) if weight_col else F.lit(1)
    counts = []
    names = []
    if copies_col or removed_col:
        removed = F.col(copies_col) - 1 if copies_col else F.col(removed_col)
        counts.append(F.coalesce(F.sum(removed), F.lit(0)).cast("long"))
        names.append(duplicate_rule)
    for name in rule_names:
        counts.append(F.coalesce(F.sum(F.when(F.col(rule_col) == name, weight)), F.lit(0)).cast("long"))
        names.append(name)
    one_row = classified.agg(*[c.alias(f"_r{i}") for i, c in enumerate(counts)])
    rows = F.array(*[
        F.struct(F.lit(entity).alias("entity"), F.lit(n).alias("rule"), F.col(f"_r{i}").alias("rejected"))
        for i, n in enumerate(names)
    ])
    return one_row.select(F.explode(rows).alias("r")).select("r.entity", "r.rule", "r.rejected")
