"""Declarative settings: what a source looks like, what a valid row is, what to join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.names import named


@dataclass(frozen=True)
class SourceSpec:
    """How one delimited file is laid out.

    ``multi_line`` says that records may span lines. Such a file cannot be split and is
    one task whatever its size, so it is off unless asked for; a quote left open then ends
    with its line. ``split`` reads such a file in splits all the same, three times over.
    """

    name: str
    separator: str = ","
    columns: tuple[str, ...] = ()
    renames: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, str] = field(default_factory=dict)
    multi_line: bool = False
    split: bool = False
    corrupt_column: str | None = None


@dataclass(frozen=True)
class Rule:
    """A validity condition on one column; bounds are closed unless marked open."""

    column: str
    low: float | None = None
    high: float | None = None
    low_open: bool = False
    high_open: bool = False
    nullable: bool = False
    non_blank: bool = False

    @property
    def label(self) -> str:
        parts = [self.column]
        if self.low is not None:
            parts.append(f"{'>' if self.low_open else '>='} {self.low:g}")
        if self.high is not None:
            parts.append(f"{'<' if self.high_open else '<='} {self.high:g}")
        if self.non_blank:
            parts.append("not blank")
        parts.append("or null" if self.nullable else "not null")
        return " ".join(parts)

    def condition(self) -> Column:
        """True or False for every row, never NULL."""
        value = named(self.column)
        holds = F.lit(True)
        if self.low is not None:
            holds &= value > self.low if self.low_open else value >= self.low
        if self.high is not None:
            holds &= value < self.high if self.high_open else value <= self.high
        if self.non_blank:
            holds &= F.trim(value) != ""
        return value.isNull() | holds if self.nullable else value.isNotNull() & holds


@dataclass(frozen=True)
class RatioCheck:
    """``stated`` should equal ``numerator / denominator`` within ``tolerance``."""

    stated: str
    numerator: str
    denominator: str
    tolerance: float = 0.1


@dataclass(frozen=True)
class QualitySpec:
    """What the quality checks should expect of a dataset."""

    dataset: str
    expected_columns: tuple[str, ...] = ()
    key_columns: tuple[str, ...] = ()
    markers: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    year_column: str | None = None
    year_range: tuple[int, int] = (2000, 2030)
    max_year_span: int = 15
    region_column: str | None = None
    rare_below: int = 5
    ratio: RatioCheck | None = None
    top_k: int = 5


@dataclass(frozen=True)
class Agg:
    """One aggregate of a summary: ``function`` of ``column`` named ``alias``."""

    function: str
    column: str
    alias: str


@dataclass(frozen=True)
class Enrichment:
    """One source to left-join to a mart.

    A source with ``aggs`` is aggregated to one row per key first. A source
    without is joined as it is, so repeated keys repeat mart rows; set
    ``unique`` when its keys are known not to repeat. ``frame`` None means the
    source is absent, and then it adds no columns.
    """

    name: str
    frame: DataFrame | None
    on: Sequence[str]
    aggs: tuple[Agg, ...] = ()
    unique: bool = False
