"""Joins (B1, B2) and the group-mean join-back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def activity_outcome_join(activity: DataFrame, info: DataFrame, left_keys: list[str],
                          right_keys: list[str] | None = None,
                          info_cols: list[str] = ("final_result", "gender", "age_band",
                                                  "highest_education")) -> DataFrame:
    """B1: inner equi-join, all activity columns plus the listed info columns.

    No hint: the planner broadcasts the info side when its size is known to be
    small, otherwise it is a sort-merge join that AQE may still convert, and
    whose skewed partitions (one student with a third of the activity) AQE splits.
    The default keys of the reference omit the module (quirk Q1); pass it in the
    keys for the strict join."""
    right_keys = list(right_keys or left_keys)
    info_cols = list(info_cols)
    right = info.select(*[F.col(r).alias(f"__k{i}") for i, r in enumerate(right_keys)], *info_cols)
    cond = None
    for i, l in enumerate(left_keys):
        e = activity[l] == right[f"__k{i}"]
        cond = e if cond is None else cond & e
    return activity.join(right, cond, "inner").drop(*[f"__k{i}" for i in range(len(right_keys))])


def outcome_only_join(activity: DataFrame, info: DataFrame, left_keys: list[str],
                      right_keys: list[str] | None = None, label: str = "final_result") -> DataFrame:
    """B2: the same join with only the outcome projected."""
    return activity_outcome_join(activity, info, left_keys, right_keys, [label])
