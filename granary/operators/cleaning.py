"""Row-wise cleaning steps and deduplication. All lazy, one projection each."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import (
    guarded_ratio,
    join_key,
    named,
    parse_integer,
    ratio,
    standard_name,
    tidy_text,
)

logger = logging.getLogger(__name__)


def marker_values(data_type: T.DataType, markers: Sequence[str]) -> list:
    """The markers a column of this type can hold: text as text, numbers as numbers."""
    if isinstance(data_type, T.StringType):
        return [marker for marker in markers if marker]
    if not isinstance(data_type, T.NumericType):
        return []
    numbers = []
    for marker in markers:
        try:
            numbers.append(float(marker))
        except ValueError:
            continue
    if isinstance(data_type, T.FractionalType):
        return numbers
    return [int(number) for number in numbers if number.is_integer()]


def null_markers(
    df: DataFrame,
    markers: Sequence[str],
    columns: Sequence[str] | Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Set cells that equal a marker to NULL.

    ``columns`` limits the columns (default all), or maps columns to marker
    lists of their own. The empty marker is never applied.
    """
    if isinstance(columns, Mapping):
        wanted = columns
    else:
        wanted = {name: markers for name in (df.columns if columns is None else columns)}
    changes = {}
    for column in df.schema.fields:
        values = marker_values(column.dataType, wanted.get(column.name, ()))
        if values:
            cell = named(column.name)
            changes[column.name] = F.when(~cell.isin(values), cell)
    return df.withColumns(changes) if changes else df


def null_sentinels(df: DataFrame, sentinels: Mapping[str, Sequence[float]]) -> DataFrame:
    """Set numeric cells that equal one of the column's sentinel numbers to NULL."""
    return df.withColumns(
        {
            name: F.when(~named(name).isin(list(values)), named(name))
            for name, values in sentinels.items()
        }
    )


def clean_text(df: DataFrame, *columns: str) -> DataFrame:
    """Drop symbols and squeeze white space in text columns."""
    return df.withColumns({name: tidy_text(named(name)) for name in columns})


def standardize_name(
    df: DataFrame, column: str, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Clean and trim a name column; ``aliases`` maps cleaned spellings to one.

    A frame without the column is returned as it is.
    """
    if column not in df.columns:
        return df
    value = standard_name(named(column))
    if aliases:
        table = F.create_map(*[F.lit(text) for pair in aliases.items() for text in pair])
        value = F.coalesce(F.try_element_at(table, value), value)
    return df.withColumn(column, value)


def normalize_key(df: DataFrame, column: str) -> DataFrame:
    """Lower-case a join column and drop its symbols."""
    return df.withColumn(column, join_key(named(column)))


def cast_to(value: Column, source: T.DataType, target: str | T.DataType) -> Column:
    """Cast that gives NULL where the value does not fit the type."""
    wanted = T._parse_datatype_string(target) if isinstance(target, str) else target
    if source == wanted:
        return value
    if isinstance(source, T.StringType) and isinstance(wanted, T.IntegralType):
        return parse_integer(value, wanted.simpleString())
    return value.try_cast(wanted)


def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast several columns; values that do not fit become NULL."""
    return df.withColumns(
        {
            name: cast_to(named(name), df.schema[name].dataType, target)
            for name, target in types.items()
        }
    )


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that are not there are ignored."""
    return df.withColumnsRenamed(dict(names))


def conform(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, Any] | None = None
) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    A column that is not there comes from ``defaults`` (a literal, or an
    expression over the frame), else it is a typed NULL.
    """
    defaults = defaults or {}
    present = {column.name: column.dataType for column in df.schema.fields}
    output = []
    for column in schema.fields:
        if column.name in present:
            value = cast_to(named(column.name), present[column.name], column.dataType)
        else:
            default = defaults.get(column.name)
            given = default if isinstance(default, Column) else F.lit(default)
            value = given.try_cast(column.dataType)
        output.append(value.alias(column.name))
    return df.select(*output)


def add_ratio(
    df: DataFrame,
    name: str,
    numerator: str,
    denominator: str,
    digits: int | None = None,
    guard: bool = False,
    without_denominator: str = "error",
) -> DataFrame:
    """Add ``numerator / denominator``.

    ``guard`` asks for a positive denominator. If the denominator column is
    absent, ``without_denominator`` says what to add: "numerator" (as double),
    "null", or nothing but an error.
    """
    over = named(numerator)
    if denominator in df.columns:
        under = named(denominator)
        value = guarded_ratio(over, under) if guard else ratio(over, under)
        if digits is not None:
            value = F.round(value, digits)
    elif without_denominator == "numerator":
        value = over.cast("double")
    elif without_denominator == "null":
        value = F.lit(None).cast("double")
    else:
        raise ValueError(f"no column {denominator!r} to divide by")
    return df.withColumn(name, value)


def handle_missing(
    df: DataFrame, strategy: str = "drop", fill_values: Mapping[str, Any] | None = None
) -> DataFrame:
    """Drop rows with any NULL ("drop"), or fill NULLs per column ("fill").

    Anything else is reported and leaves the frame as it is.
    """
    if strategy == "drop":
        return df.na.drop()
    if strategy == "fill" and fill_values:
        return df.na.fill(dict(fill_values))
    logger.warning("no missing values handled: strategy %r, fill values %r", strategy, fill_values)
    return df


def evaluate_once(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed here and only here.

    A filter on computed columns is otherwise pushed below the computation, and
    each mention of a column there repeats its whole expression: parsing runs
    several times a row and generated code outgrows what can be compiled. The
    one-element generator keeps filters above it. Use it after parsing, not on
    stored columns, whose filters should reach the scan.
    """
    return df.select(F.inline(F.array(F.struct(*map(named, df.columns)))))


def dedupe(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct row, or per key.

    Copies collapse before the shuffle, so a row repeated any number of times
    costs each reducer one row per map task. With ``keys`` the smallest row by
    the other columns stays, which makes the choice repeatable.
    """
    if not keys:
        return df.dropDuplicates()
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    kept = (
        df.select(*map(named, keys), F.struct(*map(named, others)).alias("_rest"))
        .groupBy(*map(named, keys))
        .agg(F.min("_rest").alias("_rest"))
    )
    unpacked = [F.col("_rest").getField(name).alias(name) for name in others]
    return kept.select(*map(named, keys), *unpacked).select(*map(named, df.columns))
