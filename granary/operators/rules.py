"""Validity rules as data: filter by them, count by them, gate by them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.spec import Rule


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that meet every rule."""
    return df.filter(reduce(and_, (rule.condition() for rule in rules)))


def drop_blank_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL or blank."""
    return keep_valid(df, [Rule(name, non_blank=True) for name in columns])


def metric_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Rows for which each predicate holds, as (metric, rows), in one pass."""
    counted = df.agg(
        *[
            F.count(F.when(predicate, 1)).alias(f"m{i}")
            for i, predicate in enumerate(predicates.values())
        ]
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("metric"), F.col(f"m{i}").alias("rows"))
                    for i, name in enumerate(predicates)
                ]
            )
        )
    )


def reject_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that fail each rule, as (metric, rows), in one pass."""
    return metric_counts(df, {rule.label: ~rule.condition() for rule in rules})


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """Expected columns that the frame lacks, in the given order."""
    return [name for name in expected if name not in df.columns]


def require(df: DataFrame, columns: Sequence[str], min_rows: int = 1) -> bool:
    """Whether the columns are there and there are at least ``min_rows`` rows.

    Rows are counted; on staged Parquet the count comes from the footers.
    """
    return not missing_columns(df, columns) and df.count() >= min_rows
