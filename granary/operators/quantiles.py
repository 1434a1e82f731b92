"""Exact quantiles of many columns without sorting or gathering the data.

``percentile`` and ``percentile_approx`` merge one buffer per task in a single
reducer, which grows with the number of tasks. Here a first pass counts rows
per order of magnitude, and every further pass per equal-width bin of the range
that holds the wanted rank; the range narrows to the one bin that holds it.
Counts combine on the map side, so a pass shuffles a bounded number of groups
per task. Once few rows are left in the range, they are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import literal, quoted

_LARGEST = 1.7976931348623157e308


@dataclass
class _Search:
    column: str
    probability: float
    rank: int  # 1-based rank of the wanted value among the rows in the range
    low: float
    high: float
    rows: int  # rows in the range

    @property
    def span(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high

    @property
    def done(self) -> bool:
        return self.low == self.high

    def enter(self, bins: Sequence) -> None:
        """Narrow the range to the one of these bins that holds the rank."""
        for found in bins:
            if self.rank <= found["rows"]:
                self.low, self.high, self.rows = found["low"], found["high"], found["rows"]
                return
            self.rank -= found["rows"]


def number_sql(name: str) -> str:
    """The column as a finite double, in SQL; NaN counts as missing."""
    value = f"CAST({quoted(name)} AS DOUBLE)"
    bounded = f"greatest(least({value}, {literal(_LARGEST)}), {literal(-_LARGEST)})"
    # The bounds need the test for NULL: least and greatest pass over it.
    return f"CASE WHEN {value} IS NOT NULL AND NOT isnan({value}) THEN {bounded} END"


def as_number(name: str) -> Column:
    return F.expr(number_sql(name))


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, float]]:
    """n, min, max, mean and stddev per column, from one pass."""
    if not columns:
        return {}
    measures = {
        "n": F.count,
        "min": F.min,
        "max": F.max,
        "mean": F.avg,
        "stddev": F.stddev,
    }
    row = df.agg(
        *[
            measure(as_number(name)).alias(f"{label}_{i}")
            for i, name in enumerate(columns)
            for label, measure in measures.items()
        ]
    ).first()
    return {
        name: {label: row[f"{label}_{i}"] for label in measures}
        for i, name in enumerate(columns)
    }


def _magnitude_bin(value: Column) -> Column:
    """A bin that needs no known range: sign, and 32 steps per factor of two; monotone."""
    step = F.floor(F.log2(F.abs(value)) * 32) + 40_000  # above 0 for every double
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * step).cast("int")


def _first_pass(
    df: DataFrame, columns: Sequence[str]
) -> tuple[dict[str, dict[str, float]], dict[str, list]]:
    """The summary and a first histogram of every column from one pass."""
    cells = [
        F.struct(F.lit(at).alias("column"), as_number(name).alias("value"))
        for at, name in enumerate(columns)
    ]
    counted = (
        df.select(F.inline(F.array(*cells)))
        .filter("value IS NOT NULL")
        .groupBy("column", _magnitude_bin(F.col("value")).alias("bin"))
        .agg(
            F.count("*").alias("rows"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.avg("value").alias("mean"),
            F.var_pop("value").alias("spread"),
        )
        .collect()
    )
    bins = _by(counted, "column")
    histograms = {name: bins.get(at, []) for at, name in enumerate(columns)}
    return {name: _merged_summary(bins) for name, bins in histograms.items()}, histograms


def _by(rows: Sequence, key: str) -> dict[int, list]:
    """Rows by a key, in the order of their bins."""
    found: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: r["bin"]):
        found.setdefault(row[key], []).append(row)
    return found


def _merged_summary(bins: Sequence) -> dict[str, float]:
    n = sum(b["rows"] for b in bins)
    if not n:
        return {"n": 0, "min": None, "max": None, "mean": None, "stddev": None}
    mean = sum(b["rows"] * b["mean"] for b in bins) / n
    gaps = [b["mean"] - mean for b in bins]
    squares = sum(b["rows"] * (b["spread"] + gap * gap) for b, gap in zip(bins, gaps))
    return {
        "n": n,
        "min": min(b["low"] for b in bins),
        "max": max(b["high"] for b in bins),
        "mean": mean,
        "stddev": math.sqrt(squares / (n - 1)) if n > 1 else None,
    }


def _bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """Bin of a value in [low, high]; monotone, with the ends in different bins."""
    if math.isinf(high - low):
        share = (value / 2 - low / 2) / (high / 2 - low / 2)
    else:
        share = (value - F.lit(low)) / F.lit(high - low)
    return F.least(F.floor(share * bins), F.lit(bins - 1))


def _in_range(value: Column, low: float, high: float) -> Column:
    return value.between(F.lit(low), F.lit(high))


def _narrow(df: DataFrame, searches: Sequence[_Search], bins: int) -> None:
    """One counting pass: move every search into the bin that holds its rank."""
    spans = list(dict.fromkeys(search.span for search in searches))
    cells = []
    for at, (column, low, high) in enumerate(spans):
        value = as_number(column)
        cells.append(
            F.when(
                _in_range(value, low, high),
                F.struct(
                    F.lit(at).alias("span"),
                    _bin_of(value, low, high, bins).alias("bin"),
                    value.alias("value"),
                ),
            )
        )
    counted = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .filter("cell IS NOT NULL")
        .groupBy("cell.span", "cell.bin")
        .agg(
            F.count("*").alias("rows"),
            F.min("cell.value").alias("low"),
            F.max("cell.value").alias("high"),
        )
        .collect()
    )
    found, places = _by(counted, "span"), {span: at for at, span in enumerate(spans)}
    for search in searches:
        search.enter(found.get(places[search.span], []))


def _rank(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Rank the few rows left in each range and read off the wanted values."""
    cells = []
    for at, search in enumerate(searches):
        value = as_number(search.column)
        cells.append(
            F.when(
                _in_range(value, search.low, search.high),
                F.struct(
                    F.lit(at).alias("search"),
                    F.lit(search.rank).alias("rank"),
                    value.alias("value"),
                ),
            )
        )
    up_to_here = (
        Window.partitionBy("search")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .filter("cell IS NOT NULL")
        .groupBy("cell.search", "cell.rank", "cell.value")
        .agg(F.count("*").alias("rows"))
        .withColumn("reached", F.sum("rows").over(up_to_here))
        .filter("reached >= rank")
        .groupBy("search")
        .agg(F.min("value").alias("value"))
        .collect()
    )
    for row in found:
        search = searches[row["search"]]
        search.low = search.high = row["value"]


def summary_and_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    bins: int = 1024,
    finish_rows: int = 100_000,
) -> tuple[dict[str, dict[str, float]], dict[str, list[float | None]]]:
    """n, min, max, mean, stddev and exact quantiles of each column.

    Runs a few jobs; each sends the driver a bounded number of bins per column.
    A quantile is the smallest value with at least the given share of the
    values at or below it; a column without numbers gives None.
    """
    if not columns:
        return {}, {}
    summary, histograms = _first_pass(df, columns)
    searches = []
    for column in columns:
        n = summary[column]["n"]
        for probability in probabilities if n else ():
            rank = max(1, math.ceil(round(probability * n, 9)))
            search = _Search(column, probability, rank, 0.0, 0.0, n)
            search.enter(histograms[column])
            searches.append(search)
    while wide := [s for s in searches if not s.done and s.rows > finish_rows]:
        _narrow(df, wide, bins)
    if close := [s for s in searches if not s.done]:
        _rank(df, close)
    values = {(s.column, s.probability): s.low for s in searches}
    return summary, {c: [values.get((c, p)) for p in probabilities] for c in columns}


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    bins: int = 1024,
    finish_rows: int = 100_000,
) -> dict[str, list[float | None]]:
    """The quantiles of :func:`summary_and_quantiles`."""
    return summary_and_quantiles(df, columns, probabilities, bins, finish_rows)[1]


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 10_000
) -> dict[str, list[float | None]]:
    """The same from one pass of ``percentile_approx``, within 1/accuracy of the rank."""
    if not columns:
        return {}
    wanted = F.array(*map(F.lit, probabilities))
    row = df.agg(
        *[
            F.percentile_approx(as_number(name), wanted, accuracy).alias(f"q{i}")
            for i, name in enumerate(columns)
        ]
    ).first()
    nothing = [None] * len(probabilities)
    return {name: list(row[f"q{i}"] or nothing) for i, name in enumerate(columns)}
