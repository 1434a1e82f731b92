"""Regional marts: summaries, enrichment joins, scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import named
from granary.operators.cleaning import evaluate_once, normalize_key
from granary.spec import Agg, Enrichment

_FUNCTIONS = {
    "sum": F.sum,
    "avg": F.avg,
    "count": F.count,
    "count_distinct": F.count_distinct,
    "min": F.min,
    "max": F.max,
}


def summarize(df: DataFrame, keys: Sequence[str], aggs: Sequence[Agg]) -> DataFrame:
    """One row per key with the given aggregates."""
    return df.groupBy(*map(named, keys)).agg(
        *[_FUNCTIONS[agg.function](named(agg.column)).alias(agg.alias) for agg in aggs]
    )


def _partial(agg: Agg, at: int) -> list[Column]:
    value = named(agg.column)
    if agg.function == "avg":
        return [F.sum(value).alias(f"p{at}_sum"), F.count(value).alias(f"p{at}_n")]
    if agg.function in ("sum", "count", "min", "max"):
        return [_FUNCTIONS[agg.function](value).alias(f"p{at}")]
    raise ValueError(f"{agg.function} cannot be built from partial results")


def _merged(agg: Agg, at: int) -> Column:
    if agg.function == "avg":
        value = F.try_divide(F.sum(f"p{at}_sum"), F.sum(f"p{at}_n"))
    elif agg.function in ("min", "max"):
        value = _FUNCTIONS[agg.function](f"p{at}")
    else:
        value = F.sum(f"p{at}")
    return value.alias(agg.alias)


def summarize_normalized(
    df: DataFrame, column: str, keys: Sequence[str], aggs: Sequence[Agg]
) -> DataFrame:
    """:func:`summarize` with the key ``column`` normalised for joining.

    Rows are aggregated by the stored spelling first, so that the normalising
    runs once per spelling and not once per row; the few results are merged.
    """
    partial = df.groupBy(*map(named, keys)).agg(
        *[measure for at, agg in enumerate(aggs) for measure in _partial(agg, at)]
    )
    return (
        normalize_key(partial, column)
        .groupBy(*map(named, keys))
        .agg(*[_merged(agg, at) for at, agg in enumerate(aggs)])
    )


def summarize_through(
    df: DataFrame,
    dimension: DataFrame,
    link: str,
    keys: Sequence[str],
    aggs: Sequence[Agg],
) -> DataFrame:
    """:func:`summarize` of ``df`` joined to ``dimension`` on ``link``.

    Some ``keys`` belong to the dimension, whose ``link`` must be unique. The
    fact side is aggregated per link value before the join, so the join sees
    one row per link value and own key, however often a link value occurs.
    """
    own = [name for name in keys if name in df.columns]
    partial = df.groupBy(named(link), *map(named, own)).agg(
        *[column for at, agg in enumerate(aggs) for column in _partial(agg, at)]
    )
    joined = partial.join(dimension, link)
    return joined.groupBy(*map(named, keys)).agg(
        *[_merged(agg, at) for at, agg in enumerate(aggs)]
    )


def _join_repeating(base: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a source whose keys may repeat, any one of them heavily.

    The matched part is an inner join: adaptive execution may split a heavy
    key on either side of it, which a left join does not allow on its right
    side. The unmatched rows need only the distinct keys of the source. Both
    parts read one and the same base: without :func:`evaluate_once` the inner
    join would push its own key filter into it, and it would be built twice.
    """
    keys = list(on)
    base = evaluate_once(base)
    columns = [*base.columns, *[name for name in source.columns if name not in keys]]
    matched = base.join(source, keys).select(*map(named, columns))
    known = source.select(*map(named, keys)).distinct()
    unmatched = base.join(known, keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def enrich(base: DataFrame, sources: Sequence[Enrichment]) -> DataFrame:
    """Left-join the sources that are there to ``base``.

    Columns come in the order of ``sources``. Sources with one row per key are
    joined first, on one partitioning; those that may repeat rows come last,
    so that repeated rows pass through no further join.
    """
    present = [source for source in sources if source.frame is not None]
    output = list(base.columns)
    result = base
    prepared = []
    for source in present:
        if source.aggs:
            frame = summarize(source.frame, source.on, source.aggs)
        else:
            frame = source.frame
        output += [name for name in frame.columns if name not in source.on]
        prepared.append((source, frame, bool(source.aggs) or source.unique))
    for source, frame, single in prepared:
        if single:
            result = result.join(frame, list(source.on), "left")
    for source, frame, single in prepared:
        if not single:
            result = _join_repeating(result, frame, source.on)
    return result.select(*map(named, output))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*map(named, keys)).agg(F.count("*").alias("rows")).filter("rows > 1")


def validate_mart(df: DataFrame, required: Sequence[str], region_column: str) -> DataFrame:
    """One row: rows, regions, and whether the mart is usable.

    Missing columns raise at once, since they need no data.
    """
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"mart lacks columns: {', '.join(missing)}")
    regions = df.groupBy(named(region_column)).agg(F.count("*").alias("n"))
    return regions.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("*").alias("region_count"),
        (F.coalesce(F.sum("n"), F.lit(0)) > 0).alias("valid"),
    )
