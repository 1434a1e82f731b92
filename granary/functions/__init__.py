"""Column expressions. All are built-in Spark functions and stay in generated code."""

from granary.functions.bands import label_by_threshold, score_by_threshold
from granary.functions.dates import date_from, year_from
from granary.functions.names import literal, named, quoted
from granary.functions.numbers import (
    guarded_ratio,
    integer_sql,
    parse_integer,
    parse_number,
    ratio,
)
from granary.functions.text import join_key, standard_name, strip_symbols, tidy_text

__all__ = [
    "date_from",
    "guarded_ratio",
    "integer_sql",
    "join_key",
    "label_by_threshold",
    "literal",
    "named",
    "parse_integer",
    "parse_number",
    "quoted",
    "ratio",
    "score_by_threshold",
    "standard_name",
    "strip_symbols",
    "tidy_text",
    "year_from",
]
