"""Names and values as expressions, whatever characters or numbers they hold."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column with exactly this name, also with dots, blanks or semicolons in it."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    """The name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: str | int | float | None) -> str:
    """The value as SQL text; floats stay doubles."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"{value!r}D" if math.isfinite(value) else f"CAST('{value}' AS DOUBLE)"
    return str(value)
