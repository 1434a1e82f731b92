"""Text normalisation expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r" \t\n\x0B\f\r"

# What is kept, and what becomes one blank. The classes list their characters
# one by one because Java looks those up in a table; it tests ranges in turn,
# which takes twice as long.
SYMBOLS = f"[^{string.ascii_letters}{string.digits}{_SPACE}]"
BLANK_RUN = f"[{_SPACE}]+"


def strip_symbols(text: Column) -> Column:
    """Keep ASCII letters, digits and white space."""
    return F.regexp_replace(text, SYMBOLS, "")


def tidy_text(text: Column) -> Column:
    """Drop symbols, then squeeze white space to single blanks; ends are kept."""
    return F.regexp_replace(strip_symbols(text), BLANK_RUN, " ")


def standard_name(text: Column) -> Column:
    """:func:`tidy_text` without blanks at the ends."""
    return F.trim(tidy_text(text))


def join_key(text: Column) -> Column:
    """Drop symbols and lower the case; white space is kept as it is."""
    return F.lower(strip_symbols(text))
