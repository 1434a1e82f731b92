"""Calendar expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _numeric_pattern(fmt: str) -> tuple[str, str]:
    """A regular expression for a format such as dd/MM/yyyy, and its ISO rewriting."""
    parts = re.findall(r"(yyyy|MM|dd)|([^yMd]+)", fmt)
    fields = [field for field, _ in parts if field]
    if sorted(fields) != ["MM", "dd", "yyyy"] or "".join(map("".join, parts)) != fmt:
        raise ValueError(f"not a day, month and year format: {fmt!r}")
    pattern = "".join(rf"(\d{{{len(field)}}})" if field else re.escape(gap) for field, gap in parts)
    iso = "-".join(f"${fields.index(field) + 1}" for field in ("yyyy", "MM", "dd"))
    return pattern, iso


def date_from(text: Column, fmt: str, allow_time: bool = False) -> Column:
    """Text to date, NULL for other text and for days that do not exist.

    With ``allow_time`` a time of day may follow the date and is ignored. The
    text is rewritten to ISO order and cast, since a pattern parser raises and
    catches an exception for every unreadable cell.
    """
    pattern, iso = _numeric_pattern(fmt)
    tail = r"(?:[ T].*)?" if allow_time else ""
    # The second branch turns all other text into bare hyphens.
    whole = rf"(?s)^\s*{pattern}{tail}\s*$|^.*$"
    return F.regexp_replace(text, whole, iso).try_cast("date")


def year_from(text: Column, fmt: str, allow_time: bool = False) -> Column:
    """The year of :func:`date_from` as an integer."""
    return F.year(date_from(text, fmt, allow_time))
