"""Data quality as tidy tables: (dataset, check, column, metric, value, detail).

Checks that only need column aggregates are *probes*: a set of aggregates and
the metrics made from them. Any number of probes shares one pass over the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import integer_sql, label_by_threshold, literal, named, parse_integer, quoted
from granary.operators.cleaning import evaluate_once, marker_values
from granary.operators.quantiles import (
    approximate_quantiles,
    number_sql,
    numeric_summary,
    summary_and_quantiles,
)
from granary.spec import QualitySpec

ALL_COLUMNS = "*"

# Weights of the overall score, and the status thresholds.
SCORE_WEIGHTS = {
    "completeness": 0.25,
    "validity": 0.25,
    "uniqueness": 0.20,
    "consistency": 0.20,
    "schema": 0.10,
}
STATUS_BANDS = ((80, "PASS"), (60, "REVIEW REQUIRED"))
STATUS_DEFAULT = "FAIL"
COMPLETENESS_MINIMUM = 90
INVALID_SHARE_LIMIT = 0.05
ISSUE_LIMIT = 2
ISSUE_PENALTY = 10

# Characters by which listed values with equal counts are chosen before their texts are read.
HEAD = 256
# Named values that may go to the driver and to all tasks.
_NAMED_BYTES = 8 << 20


@dataclass
class Metric:
    """One value of the result, as SQL over the aggregates of its frame."""

    check: str
    column: str
    metric: str
    value: str
    detail: str | None = None


@dataclass
class Probe:
    """Aggregates in SQL by alias, and the metrics computed from these aliases.

    Both are SQL text because a wide table makes hundreds of them, which Spark
    parses at once, while composing them as columns takes longer than the scan.
    """

    measures: dict[str, str] = field(default_factory=dict)
    metrics: list[Metric] = field(default_factory=list)


def tidy_row(one_row: DataFrame, dataset: str, metrics: Sequence[Metric]) -> DataFrame:
    """Spread a row of aggregates into one row per metric."""
    cells = [
        f"{literal(m.check)}, {literal(m.column)}, {literal(m.metric)}, "
        f"CAST({m.value} AS DOUBLE), CAST({literal(m.detail)} AS STRING)"
        for m in metrics
    ]
    if not cells:
        return tidy_row(one_row, dataset, [Metric("", "", "", "NULL")]).filter("false")
    return one_row.selectExpr(
        f"{literal(dataset)} AS dataset",
        f"stack({len(cells)}, {', '.join(cells)}) AS (`check`, `column`, metric, value, detail)",
    )


def _all_measures(probes: Sequence[Probe]) -> dict[str, str]:
    measures = {"rows_": "count(*)"}
    for probe in probes:
        measures.update(probe.measures)
    return measures


def _aggregated(df: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{measure} AS {alias}" for alias, measure in measures.items()])


def run_probes(df: DataFrame, dataset: str, probes: Sequence[Probe]) -> DataFrame:
    """All metrics of all probes from a single aggregation.

    Probes that measure nothing, such as column types, read no data.
    """
    metrics = [m for probe in probes for m in probe.metrics]
    if not any(probe.measures for probe in probes) and not any("rows_" in m.value for m in metrics):
        return tidy_row(df.sparkSession.range(1), dataset, metrics)
    return tidy_row(_aggregated(df, _all_measures(probes)), dataset, metrics)


class Watch:
    """Aggregates measured while rows are written, which so takes no scan of its own.

    Spark adds up what finished tasks of the writing stage measured, each once, also where lost
    executors have it run tasks again. That does not hold below a shuffle, whose tasks may count
    twice; so :meth:`over` must be the last step before the write.
    """

    def __init__(self, measures: Mapping[str, str]):
        self.measures = dict(measures)
        self._seen = Observation()
        self._over: DataFrame | None = None

    def over(self, df: DataFrame) -> DataFrame:
        self._over = df
        return df.observe(self._seen, *[F.expr(text).alias(alias) for alias, text in self.measures.items()])

    def values(self) -> dict:
        """What was measured; asked after the write."""
        # A write without rows may leave nothing to observe.
        return self._seen.get or _aggregated(self._over.limit(0), self.measures).first().asDict()

    def tidy(self, dataset: str, probes: Sequence[Probe]) -> DataFrame:
        """The metrics of probes whose measures were watched, without reading the rows again."""
        kinds = _aggregated(self._over, self.measures).schema
        values = self.values()
        row = self._over.sparkSession.createDataFrame([tuple(values[name] for name in kinds.names)], kinds)
        return tidy_row(row, dataset, [m for probe in probes for m in probe.metrics])


def _count(predicate: str) -> str:
    """Rows that meet a predicate. ``count_if`` would add a projection for each."""
    return f"count(CASE WHEN {predicate} THEN 1 END)"


def _percent(part: str, whole: str) -> str:
    return f"try_divide(({part}) * 100D, {whole})"


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


# Probes


def completeness_probe(df: DataFrame) -> Probe:
    probe = Probe()
    for at, column in enumerate(df.schema.fields):
        cell, count = quoted(column.name), f"missing_{at}"
        missing = f"{cell} IS NULL"
        if isinstance(column.dataType, (T.FloatType, T.DoubleType)):
            missing += f" OR isnan({cell})"
        probe.measures[count] = _count(missing)
        probe.metrics += [
            Metric("completeness", column.name, "null_count", count),
            Metric("completeness", column.name, "null_percentage", _percent(count, "rows_")),
            Metric(
                "completeness",
                column.name,
                "completeness_score",
                _percent(f"rows_ - {count}", "rows_"),
            ),
        ]
    cells = f"(rows_ * {len(df.columns)})"
    overall = _percent(f"{cells} - ({' + '.join(probe.measures)})", cells)
    probe.metrics += [
        Metric("completeness", ALL_COLUMNS, "overall_completeness", overall),
        Metric("completeness", ALL_COLUMNS, "threshold_met", f"{overall} >= {COMPLETENESS_MINIMUM}"),
    ]
    return probe


def validity_probe(df: DataFrame, spec: QualitySpec) -> Probe:
    """Marker cells, negative cells where none may be, and years out of range."""
    probe = Probe()

    def count(column: str, metric: str, alias: str, predicate: str) -> None:
        probe.measures[alias] = _count(predicate)
        probe.metrics.append(Metric("validity", column, metric, alias))

    for at, column in enumerate(df.schema.fields):
        cell = quoted(column.name)
        markers = marker_values(column.dataType, spec.markers)
        if markers:
            listed = ", ".join(map(literal, markers))
            count(column.name, "marker_count", f"markers_{at}", f"{cell} IN ({listed})")
        numeric = isinstance(column.dataType, T.NumericType)
        if numeric and column.name in spec.non_negative:
            count(column.name, "negative_count", f"negative_{at}", f"{cell} < 0")
        if column.name == spec.year_column:
            first, last = spec.year_range
            year = cell if numeric else integer_sql(column.name)
            outside = f"{year} NOT BETWEEN {first} AND {last}"
            count(column.name, "year_out_of_range", f"year_{at}", outside)
    cells = f"(rows_ * {len(df.columns)})"
    total = f"({' + '.join(probe.measures) or '0'})"
    share = f"try_divide({total} * 1D, {cells})"
    probe.metrics += [
        Metric("validity", ALL_COLUMNS, "total_invalid_values", total),
        Metric("validity", ALL_COLUMNS, "validity_score", _percent(f"{cells} - {total}", cells)),
        Metric(
            "validity",
            ALL_COLUMNS,
            "threshold_met",
            f"coalesce({share} < {literal(INVALID_SHARE_LIMIT)}, true)",
        ),
    ]
    return probe


def moments_probe(df: DataFrame) -> Probe:
    """Minimum, maximum, mean and sample deviation of the numeric columns."""
    probe = Probe()
    functions = {"min": "min", "max": "max", "mean": "avg", "stddev": "stddev_samp"}
    for at, name in enumerate(numeric_columns(df)):
        for metric, function in functions.items():
            probe.measures[f"{metric}_{at}"] = f"{function}({number_sql(name)})"
            probe.metrics.append(Metric("profile", name, metric, f"{metric}_{at}"))
    return probe


def outlier_probe(
    summary: dict[str, dict[str, float]],
    quartiles: dict[str, list[float | None]] | None = None,
    z_limit: float | None = None,
    two_sided: bool = False,
) -> Probe:
    """Counts outside the interquartile bounds and beyond the z limit.

    The bounds are constants by now, so counting takes no further join.
    Columns without a deviation (fewer than two values) are left out.
    """
    probe = Probe()
    for at, (name, facts) in enumerate(summary.items()):
        if facts["stddev"] is None:
            continue
        value = number_sql(name)
        if quartiles is not None:
            first, third = quartiles[name]
            reach = 1.5 * (third - first)
            low, high = literal(float(first - reach)), literal(float(third + reach))
            count = f"iqr_{at}"
            probe.measures[count] = _count(f"{value} < {low} OR {value} > {high}")
            probe.metrics += [
                Metric("outliers", name, "iqr_outliers", count),
                Metric("outliers", name, "lower_bound", low),
                Metric("outliers", name, "upper_bound", high),
                Metric("outliers", name, "outlier_percentage", _percent(count, "rows_")),
            ]
        if z_limit is not None:
            mean, deviation = literal(float(facts["mean"])), literal(float(facts["stddev"]))
            score = f"try_divide({value} - {mean}, {deviation})"
            score = f"abs({score})" if two_sided else score
            probe.measures[f"z_{at}"] = _count(f"{score} > {literal(float(z_limit))}")
            probe.metrics.append(Metric("outliers", name, "z_score_outliers", f"z_{at}"))
    return probe


# Checks that need only aggregates


def schema_probe(df: DataFrame, expected: Sequence[str]) -> Probe:
    """Missing and extra columns."""
    missing = [name for name in expected if name not in df.columns]
    extra = [name for name in df.columns if name not in expected]
    metrics = [Metric("schema", name, "missing", "1") for name in missing]
    metrics += [Metric("schema", name, "extra", "1") for name in extra]
    metrics.append(Metric("schema", ALL_COLUMNS, "schema_valid", "0" if missing else "1"))
    return Probe(metrics=metrics)


def check_schema(df: DataFrame, expected: Sequence[str], dataset: str) -> DataFrame:
    """Missing and extra columns; reads no data."""
    return run_probes(df, dataset, [schema_probe(df, expected)])


def completeness(df: DataFrame, dataset: str) -> DataFrame:
    """NULL and NaN cells per column and overall."""
    return run_probes(df, dataset, [completeness_probe(df)])


def validity(df: DataFrame, spec: QualitySpec) -> DataFrame:
    """Invalid cells per column and overall."""
    return run_probes(df, spec.dataset, [validity_probe(df, spec)])


def outliers_iqr(
    df: DataFrame, dataset: str, skip: Sequence[str] = (), method: str = "exact"
) -> DataFrame:
    """Values outside the quartiles by more than 1.5 interquartile ranges."""
    summary, quartiles = _summary_and_quartiles(df, numeric_columns(df, skip), method)
    return run_probes(df, dataset, [outlier_probe(summary, quartiles)])


def outliers_z(
    df: DataFrame,
    dataset: str,
    skip: Sequence[str] = (),
    limit: float = 3.0,
    two_sided: bool = False,
) -> DataFrame:
    """Values more than ``limit`` deviations above (or also below) the mean."""
    summary = numeric_summary(df, numeric_columns(df, skip))
    probe = outlier_probe(summary, z_limit=limit, two_sided=two_sided)
    return run_probes(df, dataset, [probe])


def _summary_and_quartiles(df: DataFrame, names: Sequence[str], method: str) -> tuple[dict, dict]:
    if method == "exact":
        return summary_and_quantiles(df, names, (0.25, 0.75))
    if method == "approximate":
        return numeric_summary(df, names), approximate_quantiles(df, names, (0.25, 0.75))
    raise ValueError("method must be 'exact' or 'approximate'")


# Checks that need groups


def row_hashes(df: DataFrame) -> list[Column]:
    """A 128-bit hash of the row, so that wide rows shuffle at 16 bytes each.

    NULLs count by position, since the hash function alone skips them.
    """
    cells = [named(name) for name in df.columns]
    shape = F.concat(*[F.when(cell.isNull(), "0").otherwise("1") for cell in cells])
    return [
        F.xxhash64(shape, *cells).alias("_hash_a"),
        F.xxhash64(F.lit("b"), shape, *cells).alias("_hash_b"),
    ]


def _collapse(
    df: DataFrame,
    keys: Sequence[str] = (),
    region: str | None = None,
    year: str | None = None,
    mismatch: Column | None = None,
    rare_below: int = 5,
    rows: str | None = None,
) -> DataFrame:
    """Rows to distinct rows to keys to regions to one row, in one chain.

    Each level combines on the map side before its shuffle and carries the
    number of raw rows along, so a single scan answers for all levels. ``rows``
    is "columns" or "hash" for the way distinct rows are told apart, or None
    where they are not wanted.
    """
    keys = [name for name in keys if name in df.columns]
    wanted = [name for name in dict.fromkeys([*keys, region, year]) if name]
    flag = F.lit(False) if mismatch is None else F.coalesce(mismatch, F.lit(False))
    if rows == "columns":
        groups = df.groupBy(*map(named, df.columns)).agg(F.count("*").alias("_n"))
        groups = groups.select(*map(named, wanted), flag.alias("_flag"), "_n")
    else:
        slim = [*map(named, wanted), flag.alias("_flag")]
        if rows == "hash":
            slim += row_hashes(df)
        narrow = df.select(*slim)
        groups = narrow.groupBy(*map(named, narrow.columns)).agg(F.count("*").alias("_n"))
    measured = {"_n": F.col("_n"), "_bad": F.when(F.col("_flag"), F.col("_n")).otherwise(0)}
    merges = {"_n": F.sum, "_bad": F.sum}
    if year:
        number = df.schema[year].dataType
        value = named(year) if isinstance(number, T.NumericType) else parse_integer(named(year))
        measured |= {"_first": value, "_last": value}
        merges |= {"_first": F.min, "_last": F.max}
    names = [name for name in wanted if name in keys or name == region]
    level = groups.select(
        *map(named, names), *[value.alias(alias) for alias, value in measured.items()]
    )
    steps = [(keys, "unique_keys")] if keys else []
    steps += [([region], "regions")] if region else []
    entity = "unique_rows" if rows else None
    for by, following in [*steps, ([], None)]:
        aggs = [merge(alias).alias(alias) for alias, merge in merges.items()]
        if entity:
            aggs.append(F.count("*").alias(entity))
            if entity == "regions":
                aggs.append(F.count(F.when(F.col("_n") < rare_below, 1)).alias("_rare"))
            merges[entity] = F.sum
        if following == "unique_keys" and region and region not in keys:
            raise ValueError("the region column must be one of the key columns")
        level = level.groupBy(*map(named, by)).agg(*aggs)
        entity = following
    return level


def _uniqueness_metrics(rows: bool, keys: bool) -> list[Metric]:
    total = "coalesce(_n, 0)"
    metrics = [Metric("uniqueness", ALL_COLUMNS, "total_rows", total)]
    if rows:
        unique = "coalesce(unique_rows, 0)"
        repeated = f"{total} - {unique}"
        metrics += [
            Metric("uniqueness", ALL_COLUMNS, "unique_rows", unique),
            Metric("uniqueness", ALL_COLUMNS, "duplicate_count", repeated),
            Metric("uniqueness", ALL_COLUMNS, "duplicate_percentage", _percent(repeated, total)),
            Metric("uniqueness", ALL_COLUMNS, "uniqueness_score", _percent(unique, total)),
        ]
    if keys:
        unique_keys = "coalesce(unique_keys, 0)"
        metrics += [
            Metric("uniqueness", ALL_COLUMNS, "unique_keys", unique_keys),
            Metric("uniqueness", ALL_COLUMNS, "key_duplicates", f"{total} - {unique_keys}"),
        ]
    return metrics


def _consistency_metrics(
    spec: QualitySpec, region: str | None, year: str | None, ratio: bool
) -> list[Metric]:
    found = []
    if region:
        found.append((region, "rare_values", "_rare", 0))
    if year:
        found.append((year, "year_span", "_last - _first", spec.max_year_span))
    if ratio:
        found.append((spec.ratio.stated, "ratio_mismatch", "coalesce(_bad, 0)", 0))
    flags = [f"CASE WHEN {value} > {limit} THEN 1 ELSE 0 END" for _, _, value, limit in found]
    issues = f"({' + '.join(flags) or '0'})"
    return [
        *[Metric("consistency", column, metric, value) for column, metric, value, _ in found],
        Metric("consistency", ALL_COLUMNS, "consistency_issues", issues),
        Metric("consistency", ALL_COLUMNS, "consistency_score", f"100 - {issues} * {ISSUE_PENALTY}"),
        Metric("consistency", ALL_COLUMNS, "threshold_met", f"{issues} <= {ISSUE_LIMIT}"),
    ]


def ratio_mismatch(df: DataFrame, spec: QualitySpec) -> Column | None:
    """True where the stated ratio is off; None if a column is absent."""
    check = spec.ratio
    if check is None or not {check.stated, check.numerator, check.denominator} <= set(df.columns):
        return None
    stated, over, under = (
        named(name).try_cast("double")
        for name in (check.stated, check.numerator, check.denominator)
    )
    gap = F.abs(stated - F.try_divide(over, under))
    return (over > 0) & (under > 0) & (gap > check.tolerance)


def _present(df: DataFrame, name: str | None) -> str | None:
    return name if name in df.columns else None


def uniqueness(
    df: DataFrame, dataset: str, keys: Sequence[str] = (), rows: str = "columns"
) -> DataFrame:
    """Repeated rows, and repeated keys if ``keys`` are given; NULL counts as a value."""
    keys = [name for name in keys if name in df.columns]
    one = _collapse(df, keys=keys, rows=rows)
    return tidy_row(one, dataset, _uniqueness_metrics(True, bool(keys)))


def key_duplicates(df: DataFrame, dataset: str, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key; NULL counts as a value."""
    return tidy_row(_collapse(df, keys=keys), dataset, _uniqueness_metrics(False, True))


def consistency(df: DataFrame, spec: QualitySpec) -> DataFrame:
    """Rare region names, the span of years, and stated ratios that are off."""
    region, year = _present(df, spec.region_column), _present(df, spec.year_column)
    mismatch = ratio_mismatch(df, spec)
    one = _collapse(
        df, region=region, year=year, mismatch=mismatch, rare_below=spec.rare_below
    )
    metrics = _consistency_metrics(spec, region, year, mismatch is not None)
    return tidy_row(one, spec.dataset, metrics)


def rare_values(df: DataFrame, column: str, below: int = 5) -> DataFrame:
    """Values (NULL included) that occur fewer than ``below`` times."""
    counted = df.groupBy(named(column).alias("value")).agg(F.count("*").alias("rows"))
    return counted.filter(F.col("rows") < below)


def top_values(df: DataFrame, column: str, k: int = 5, order: str = "desc") -> DataFrame:
    """The ``k`` most ("desc") or least ("asc") frequent values; ties go by value."""
    counted = df.groupBy(named(column).alias("value")).agg(F.count("*").alias("rows"))
    by_count = F.col("rows").desc() if order == "desc" else F.col("rows").asc()
    return counted.orderBy(by_count, F.col("value").asc_nulls_first()).limit(k)


def top_values_bounded(df: DataFrame, column: str, k: int = 5, tracked: int = 10_000) -> DataFrame:
    """What :func:`top_values` gives, without a shuffle of all distinct values where that can be told.

    A summary of ``tracked`` counters, merged over all tasks, names every value with more than a
    share of 7 / ``tracked`` of the rows (twice its greatest error). A second pass counts the
    named ones exactly. If these are all rows, or the last one listed is above that share, no
    other value can be listed. Else, or if the named values take more than 8 MB, all are counted.
    """
    named_ones = f"approx_top_k({quoted(column)}, {tracked}, {tracked})"
    seen = df.agg(F.count("*").alias("n"), F.expr(named_ones).alias("top"))
    sizes = F.transform("top", lambda x: F.octet_length(F.coalesce(x["item"].cast("string"), F.lit(""))).cast("long"))
    seen = seen.withColumn("bytes", F.aggregate(sizes, F.lit(0).cast("long"), lambda x, y: x + y))
    found = seen.select("n", F.when(F.col("bytes") <= _NAMED_BYTES, F.col("top")).alias("top"))
    first = found.first()
    if first["top"]:
        kind = T.StructType([T.StructField("value", df.schema[column].dataType)])
        listed = df.sparkSession.createDataFrame([(x["item"],) for x in first["top"]], kind)
        same = named(column).eqNullSafe(F.col("_named"))
        chosen = df.select(named(column)).join(F.broadcast(listed.withColumnRenamed("value", "_named")), same, "left_semi")
        counted = chosen.groupBy(named(column).alias("value")).agg(F.count("*").alias("rows"))
        rows = counted.orderBy(F.col("rows").desc(), F.col("value").asc_nulls_first()).collect()
        whole, rows = sum(row["rows"] for row in rows) == first["n"], rows[:k]
        if whole or len(rows) == k and rows[-1]["rows"] * tracked > 7 * first["n"]:
            return df.sparkSession.createDataFrame(rows, T.StructType([*kind.fields, T.StructField("rows", T.LongType())]))
    return top_values(df, column, k)


def _as_text(column: T.StructField) -> Column:
    """Text that differs exactly where the values differ."""
    cell = named(column.name)
    kind = column.dataType
    if isinstance(kind, T.StringType):
        return cell
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (cell + F.lit(0.0)).cast("string")  # -0.0 becomes 0.0
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(cell).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(cell)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(cell)
    return cell.cast("string")


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value as text, rows) for every value of every column, in one pass."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    cells = [
        F.struct(F.lit(f.name).alias("column"), _as_text(f).alias("value")) for f in fields
    ]
    return (
        df.select(F.inline(F.array(*cells)))
        .groupBy("column", "value")
        .agg(F.count("*").alias("rows"))
    )


def _cell_counts(df: DataFrame) -> DataFrame:
    """(column, a, b, head, rows) for every value of every column; NULL has NULL for both.

    Whole numbers stand in ``a`` as they are. Other values stand as a 128-bit hash, so
    that long text is not shuffled; ``head`` is the beginning of a text.
    """
    cells = []
    for column in df.schema.fields:
        cell, kind = named(column.name), column.dataType
        second, head = F.lit(0), F.lit(None)
        if isinstance(kind, (T.IntegralType, T.BooleanType)):
            first = cell
        elif isinstance(kind, T.DateType):
            first = F.unix_date(cell)
        elif isinstance(kind, T.TimestampType):
            first = F.unix_micros(cell)
        else:
            first, second = _text_hash(_as_text(column))
        if isinstance(kind, T.StringType):
            head = F.substring(cell, 1, HEAD)
        there = cell.isNotNull()
        cells.append(
            F.struct(
                F.lit(column.name).alias("column"),
                F.when(there, first.cast("bigint")).alias("a"),
                F.when(there, second.cast("bigint")).alias("b"),
                head.cast("string").alias("head"),
            )
        )
    long = df.select(F.inline(F.array(*cells)))
    return long.groupBy("column", "a", "b", "head").agg(F.count("*").alias("rows"))


def _text_hash(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit("b"), text)


def _tidy_metric(dataset: str, metric: str | Column, value: str, detail: Column | None = None) -> list[Column]:
    return [
        F.lit(dataset).alias("dataset"),
        F.lit("profile").alias("check"),
        F.col("column"),
        (F.lit(metric) if isinstance(metric, str) else metric).alias("metric"),
        F.col(value).cast("double").alias("value"),
        (F.lit(None).cast("string") if detail is None else detail).alias("detail"),
    ]


def _distinct_metrics(counts: DataFrame, dataset: str, listed: Sequence[str], k: int) -> DataFrame:
    """Distinct values and NULLs per column, and how many values are listed."""
    missing = F.col("a").isNull()
    per_column = counts.groupBy("column").agg(
        F.count(F.when(~missing, 1)).alias("distinct_count"),
        F.sum(F.when(missing, F.col("rows")).otherwise(0)).alias("null_count"),
        F.least(F.count("*"), F.lit(k)).alias("cardinality"),
    )
    metrics = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"))
            for name in ("distinct_count", "null_count", "cardinality")
        ]
    )
    tidy = per_column.select("column", F.inline(metrics))
    kept = tidy.filter((F.col("metric") != "cardinality") | F.col("column").isin(list(listed)))
    return kept.select(*_tidy_metric(dataset, F.col("metric"), "value"))


def _listed_values(
    df: DataFrame, counts: DataFrame, dataset: str, listed: Sequence[str], k: int, order: str
) -> DataFrame:
    """The first ``k`` values by frequency of each listed column; ties go by text.

    Values are chosen by count and first characters, ties included. A text of fewer than
    ``HEAD`` characters is all in its head; only longer ones that are chosen are looked up by
    their hash. Their number is not bounded, so that join has no hint; copies are dropped where they
    are found. Up to a ``k`` of 1,000 Spark cuts the groups before the shuffle.
    """
    by_count = F.col("rows").desc() if order == "desc" else F.col("rows").asc()
    place = Window.partitionBy("column").orderBy(by_count, F.col("head").asc_nulls_first())
    chosen = (
        evaluate_once(counts)
        .filter(F.col("column").isin(list(listed)))
        .withColumn("place", F.rank().over(place))
        .filter(F.col("place") <= k)
        .select("column", "a", "b", "head", "rows")
    )
    short = F.coalesce(F.length("head") < HEAD, F.lit(True))
    known = chosen.filter(short).select("column", "rows", F.col("head").alias("text"))
    cells = []
    for name in listed:
        first, second = _text_hash(named(name))
        key = [first.alias("a"), second.alias("b")]
        cells.append(F.struct(F.lit(name).alias("column"), *key, named(name).alias("text")))
    keys = ["column", "a", "b"]
    found = df.select(F.inline(F.array(*cells))).filter(F.length("text") >= HEAD)
    found = found.join(chosen.filter(~short).select(*keys, "rows"), keys)
    found = found.select(*keys, "rows", "text").distinct().groupBy(*keys, "rows").agg(F.min("text").alias("text"))
    texts = known.unionByName(found.select("column", "rows", "text"))
    by_text = Window.partitionBy("column").orderBy(by_count, F.col("text").asc_nulls_first())
    placed = texts.withColumn("place", F.row_number().over(by_text)).filter(F.col("place") <= k)
    metric = F.concat(F.lit("value_"), F.col("place"))
    return placed.select(*_tidy_metric(dataset, metric, "rows", F.col("text")))


def _type_metrics(df: DataFrame) -> Probe:
    return Probe(
        metrics=[
            Metric("profile", f.name, "data_type", "NULL", f.dataType.simpleString())
            for f in df.schema.fields
        ]
    )


def profile(
    df: DataFrame,
    dataset: str,
    k: int = 5,
    order: str = "asc",
    approximate: bool = False,
    moments: Probe | None = None,
) -> DataFrame:
    """Types, distinct values, NULLs, listed text values and numeric moments.

    The listed values are the ``k`` rarest by default. Exact distinct counts shuffle a
    short key of each distinct value; ``approximate`` takes all distinct counts from
    small sketches in the same pass as the moments, and only the listed values need keys.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    probes = [_type_metrics(df), moments or moments_probe(df)]
    counted = df
    if approximate:
        counted = df.select(*map(named, text))
        sketch = Probe()
        for at, name in enumerate(df.columns):
            sketch.measures[f"distinct_{at}"] = f"approx_count_distinct({quoted(name)})"
            sketch.measures[f"nulls_{at}"] = _count(f"{quoted(name)} IS NULL")
            sketch.metrics += [
                Metric("profile", name, "distinct_count", f"distinct_{at}"),
                Metric("profile", name, "null_count", f"nulls_{at}"),
            ]
        probes.append(sketch)
    result = run_probes(df, dataset, probes)
    if counted.columns:
        counts = _cell_counts(counted)
        exact = _distinct_metrics(counts, dataset, text, k)
        if approximate:
            exact = exact.filter(F.col("metric") == "cardinality")
        result = result.unionByName(exact)
        if text:
            result = result.unionByName(_listed_values(df, counts, dataset, text, k, order))
    return result


# All together

CHECKS = (
    "overview", "schema", "completeness", "validity", "uniqueness", "consistency", "outliers", "profile",
)
# What the score and the report read.
SCORED_CHECKS = ("overview", *SCORE_WEIGHTS)


def assess(
    df: DataFrame,
    spec: QualitySpec,
    quantiles: str = "exact",
    rows: str = "columns",
    approximate_profile: bool = False,
    checks: Sequence[str] = CHECKS,
) -> DataFrame:
    """The wanted checks of ``spec`` on ``df``.

    Without outliers and profile the result is lazy and takes two scans: one for all
    column aggregates, one for the chain of groupings. Outliers take a few small jobs up
    front for the quartiles; moments for the profile come along with them.
    """
    unknown = set(checks).difference(CHECKS)
    if unknown:
        raise ValueError(f"unknown checks: {', '.join(sorted(unknown))}")
    dataset = spec.dataset
    probes, parts, moments = [], [], None
    if "overview" in checks:
        probes.append(_overview(df))
    if "schema" in checks:
        probes.append(schema_probe(df, spec.expected_columns))
    if "completeness" in checks:
        probes.append(completeness_probe(df))
    if "validity" in checks:
        probes.append(validity_probe(df, spec))
    if "outliers" in checks:
        summary, quartiles = _summary_and_quartiles(df, numeric_columns(df), quantiles)
        judged = {name: facts for name, facts in summary.items() if name != spec.year_column}
        probes.append(outlier_probe(judged, quartiles, z_limit=3.0))
        moments = Probe(
            metrics=[
                Metric("profile", name, metric, literal(facts[metric]))
                for name, facts in summary.items()
                for metric in ("min", "max", "mean", "stddev")
            ]
        )
    parts += _grouped_checks(df, spec, rows, checks)
    if "profile" in checks:
        parts.append(profile(df, dataset, spec.top_k, "asc", approximate_profile, moments))
    if probes:
        parts.insert(0, run_probes(df, dataset, probes))
    if not parts:
        return run_probes(df, dataset, [])
    return reduce(DataFrame.unionByName, parts)


def _overview(df: DataFrame) -> Probe:
    return Probe(
        metrics=[
            Metric("overview", ALL_COLUMNS, "row_count", "rows_"),
            Metric("overview", ALL_COLUMNS, "column_count", str(len(df.columns))),
        ]
    )


def column_probes(df: DataFrame, spec: QualitySpec) -> list[Probe]:
    """The probes behind the score that need column aggregates only."""
    return [_overview(df), schema_probe(df, spec.expected_columns), completeness_probe(df), validity_probe(df, spec)]


def probe_measures(probes: Sequence[Probe]) -> dict[str, str]:
    """What a :class:`Watch` has to measure for these probes."""
    return _all_measures(probes)


def assess_watched(df: DataFrame, spec: QualitySpec, watch: Watch, rows: str = "columns") -> DataFrame:
    """The scored checks, where the column aggregates were watched as ``df`` was written.

    Only the chain of groupings, which needs a shuffle, reads ``df``.
    """
    return reduce(
        DataFrame.unionByName,
        [watch.tidy(spec.dataset, column_probes(df, spec)), *_grouped_checks(df, spec, rows, SCORED_CHECKS)],
    )


def score_metrics(df: DataFrame, spec: QualitySpec) -> list[Metric]:
    """Uniqueness and consistency, over the totals that one chain of groupings ends in."""
    keys = any(name in df.columns for name in spec.key_columns)
    region, year = _present(df, spec.region_column), _present(df, spec.year_column)
    return _uniqueness_metrics(True, keys) + _consistency_metrics(spec, region, year, ratio_mismatch(df, spec) is not None)


def _grouped_checks(
    df: DataFrame, spec: QualitySpec, rows: str, checks: Sequence[str]
) -> list[DataFrame]:
    """Uniqueness and consistency, from one chain of groupings where the keys allow it."""
    keys = [name for name in spec.key_columns if name in df.columns]
    region = _present(df, spec.region_column)
    unique, consistent = "uniqueness" in checks, "consistency" in checks
    if not (unique and consistent) or (keys and region and region not in keys):
        found = [uniqueness(df, spec.dataset, keys, rows)] if unique else []
        return found + ([consistency(df, spec)] if consistent else [])
    year, mismatch = _present(df, spec.year_column), ratio_mismatch(df, spec)
    grouped = _collapse(df, keys, region, year, mismatch, spec.rare_below, rows)
    return [tidy_row(grouped, spec.dataset, score_metrics(df, spec))]


def _pick(check: str, metric: str) -> Column:
    wanted = (F.col("check") == check) & (F.col("metric") == metric)
    return F.max(F.when(wanted & (F.col("column") == ALL_COLUMNS), F.col("value")))


def _score_picks() -> dict[str, Column]:
    picks = {
        "completeness": _pick("completeness", "overall_completeness"),
        "validity": _pick("validity", "validity_score"),
        "uniqueness": _pick("uniqueness", "uniqueness_score"),
        "consistency": _pick("consistency", "consistency_score"),
        "schema": _pick("schema", "schema_valid") * 100,
    }
    return {name: F.coalesce(pick, F.lit(0.0)) for name, pick in picks.items()}


def _overall_score() -> Column:
    weighted = F.lit(0.0)
    for name, weight in SCORE_WEIGHTS.items():
        weighted += F.col(name) * weight
    return F.round(weighted, 2)


def quality_score(assessment: DataFrame) -> DataFrame:
    """The weighted score of each dataset in an assessment; absent checks score 0."""
    picked = assessment.groupBy("dataset").agg(
        *[pick.alias(name) for name, pick in _score_picks().items()]
    )
    return picked.withColumn("overall_score", _overall_score())


def quality_report(assessment: DataFrame) -> DataFrame:
    """One row per dataset: size, scores, issue counts and status."""
    counts = {
        "row_count": _pick("overview", "row_count"),
        "column_count": _pick("overview", "column_count"),
        "duplicate_count": _pick("uniqueness", "duplicate_count"),
        "invalid_values": _pick("validity", "total_invalid_values"),
        "consistency_issues": _pick("consistency", "consistency_issues"),
    }
    missing = F.collect_set(F.when(F.col("metric") == "missing", F.col("column")))
    picked = assessment.groupBy("dataset").agg(
        *[pick.cast("bigint").alias(name) for name, pick in counts.items()],
        *[pick.alias(name) for name, pick in _score_picks().items()],
        F.array_join(F.array_sort(missing), ", ").alias("missing_columns"),
    )
    status = label_by_threshold(F.col("overall_score"), STATUS_BANDS, STATUS_DEFAULT)
    return picked.withColumn("overall_score", _overall_score()).withColumn("status", status)
