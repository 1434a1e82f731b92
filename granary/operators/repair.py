"""Repair of rows that a delimited reader could not take apart."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import named


def unpack_delimited(
    df: DataFrame, column: str, separator: str, positions: Mapping[str, int]
) -> DataFrame:
    """Take fields by 0-based position out of a column that holds whole lines.

    A line that is too short gives NULL for the fields it lacks.
    """
    parts = F.split(named(column), re.escape(separator))
    return df.select(*[F.get(parts, F.lit(at)).alias(name) for name, at in positions.items()])


def repair_rows(
    df: DataFrame,
    packed_column: str,
    empty_column: str,
    patterns: Mapping[str, str],
    separator: str = ",",
) -> DataFrame:
    """Rebuild rows whose whole text landed in ``packed_column``.

    A row is packed if that column holds the separator while ``empty_column``
    is NULL; its fields are then the first groups of ``patterns``. Packed rows
    without a readable ``packed_column`` field, and other rows without
    ``empty_column``, are dropped. One pass, no branch on the data.
    """
    text, witness = named(packed_column), named(empty_column)
    packed = is_packed(packed_column, empty_column, separator)
    fields = {name: F.regexp_extract(text, pattern, 1) for name, pattern in patterns.items()}
    usable = witness.isNotNull() | (packed & (fields[packed_column] != ""))
    return df.filter(usable).withColumns(
        {name: F.when(packed, field).otherwise(named(name)) for name, field in fields.items()}
    )


def is_packed(packed_column: str, empty_column: str, separator: str = ",") -> Column:
    """True for rows whose whole text landed in ``packed_column``."""
    return F.coalesce(named(packed_column).contains(separator), F.lit(False)) & named(empty_column).isNull()


def is_corrupt(df: DataFrame, repairable: Column, corrupt_column: str = "_corrupt_record") -> Column:
    """True for rows the reader did not accept and no repair takes back; never NULL."""
    if corrupt_column not in df.columns:
        return F.lit(False)
    return named(corrupt_column).isNotNull() & _readable(df, corrupt_column) & ~repairable


def _readable(df: DataFrame, corrupt_column: str) -> Column:
    """True for every row; names another column, as Spark reads no corrupt column alone."""
    other = named(next(name for name in df.columns if name != corrupt_column))
    return F.length(F.coalesce(other.cast("string"), F.lit(""))) >= 0


def split_corrupt(
    df: DataFrame, corrupt_column: str = "_corrupt_record"
) -> tuple[DataFrame, DataFrame]:
    """Rows the reader accepted (without the corrupt column), and the others.

    Spark refuses to read the corrupt column alone, as a count of either part
    would; the test on another column, which every row passes, avoids that.
    """
    corrupt, readable = named(corrupt_column), _readable(df, corrupt_column)
    good = df.filter(corrupt.isNull() & readable).drop(corrupt_column)
    return good, df.filter(corrupt.isNotNull() & readable)
