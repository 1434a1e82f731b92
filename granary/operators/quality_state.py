"""Quality of a partitioned table from states of its partitions.

A state holds what the checks need of one partition (a year, say), and states of several add up
to that of all: counts and sums of column aggregates, counts per region, and sketches of numbers
and of distinct values. A run measures only the partitions that changed and merges the rest from
the table of states, whose size does not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import literal, named
from granary.operators.quality import (
    column_probes,
    numeric_columns,
    probe_measures,
    ratio_mismatch,
    score_metrics,
    tidy_row,
)
from granary.operators.quantiles import number_sql
from granary.sources.tables import write_table
from granary.spec import QualitySpec

# Size of the sketch of quantiles, and the rank error it keeps with 99 percent confidence.
QUANTILE_SIZE = 800
QUANTILE_ERROR = 0.005
# Sketches of distinct values have 2 to this many cells; three deviations of their error.
DISTINCT_BITS = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_BITS / 2)

STATE_SCHEMA = (
    "kind string, name string, rows bigint, mismatched bigint, unique_rows bigint, unique_keys bigint, "
    "sketch binary, dataset string, part string"
)


def _row(kind: str | Column, name: str | Column, rows: str | Column, sketch: Column | None = None) -> Column:
    text = lambda value: F.lit(value) if isinstance(value, str) else value
    rows = F.expr(rows) if isinstance(rows, str) else rows
    return F.struct(
        text(kind).alias("kind"),
        text(name).alias("name"),
        rows.cast("bigint").alias("rows"),
        (F.lit(None) if sketch is None else sketch).cast("binary").alias("sketch"),
    )


def _check(df: DataFrame, spec: QualitySpec) -> None:
    if not {spec.year_column, spec.region_column} <= {*spec.key_columns} & {*df.columns}:
        raise ValueError("partitions add up only where year and region are columns and part of the key")


def partition_states(df: DataFrame, spec: QualitySpec, sketches: bool = True) -> DataFrame:
    """The states of the partitions that ``df`` has rows of, by ``spec.year_column``.

    Equal rows, and rows of one key, lie in one partition, since the year is part of both; so their
    counts add up. Distinct rows are counted by a chain of groupings, each a map-side combine of
    the one below; column aggregates and sketches take a pass of their own.
    """
    _check(df, spec)
    year, region = named(spec.year_column), named(spec.region_column)
    part = year.cast("string").alias("part")

    aggregates = {alias: F.expr(text) for alias, text in probe_measures(column_probes(df, spec)).items()}
    cells = [_row("measure", alias, F.col(alias)) for alias in aggregates]
    if sketches:
        for at, name in enumerate(numeric_columns(df)):
            sketch = f"_quantiles_{at}"
            aggregates[sketch] = F.expr(f"kll_sketch_agg_double(CAST({number_sql(name)} AS DOUBLE), {QUANTILE_SIZE})")
            cells.append(_row("quantiles", F.lit(name), F.lit(None), F.col(sketch)))
        for at, column in enumerate(df.schema.fields):
            sketch = f"_distinct_{at}"
            value = named(column.name).cast("string") if not isinstance(column.dataType, T.StringType) else named(column.name)
            aggregates[sketch] = F.hll_sketch_agg(value, F.lit(DISTINCT_BITS))
            cells.append(_row("distinct", F.lit(column.name), F.lit(None), F.col(sketch)))
    by_column = df.groupBy(part).agg(*[value.alias(alias) for alias, value in aggregates.items()])
    no = F.lit(None).cast("bigint")
    by_column = by_column.select("part", F.inline(F.array(*cells))).withColumns(
        {"mismatched": no, "unique_rows": no, "unique_keys": no}
    )

    mismatch = ratio_mismatch(df, spec)
    keys = [name for name in spec.key_columns if name in df.columns]
    groups = df.groupBy(*map(named, df.columns)).agg(F.count("*").alias("_n"))
    flag = F.lit(False) if mismatch is None else F.coalesce(mismatch, F.lit(False))
    groups = groups.withColumn("_bad", F.when(flag, F.col("_n")).otherwise(0))
    groups = groups.groupBy(*map(named, keys)).agg(
        F.sum("_n").alias("_n"), F.sum("_bad").alias("_bad"), F.count("*").alias("_unique")
    )
    by_region = groups.groupBy(part, region.alias("name")).agg(
        F.lit("region").alias("kind"),
        F.sum("_n").alias("rows"),
        F.sum("_bad").alias("mismatched"),
        F.sum("_unique").alias("unique_rows"),
        F.count("*").alias("unique_keys"),
        F.lit(None).cast("binary").alias("sketch"),
    )
    states = by_column.unionByName(by_region).withColumn("dataset", F.lit(spec.dataset))
    return states.select(*[field.split()[0] for field in STATE_SCHEMA.split(", ")])


def refresh_states(df: DataFrame, spec: QualitySpec, path: str, parts: Sequence, sketches: bool = True) -> None:
    """Measure some partitions of a table anew and replace their states below ``path``.

    ``df`` is the whole table; only the named partitions are read. One that has no rows any more
    gets an empty state, so that its former one does not stay.
    """
    spark = df.sparkSession
    changed = df.filter(named(spec.year_column).isin(list(parts)))
    if None in parts:
        changed = df.filter(named(spec.year_column).isin([p for p in parts if p is not None]) | named(spec.year_column).isNull())
    # Asked for here, as a row for every partition replaces its former state.
    asked = [("asked", None, 0, None, None, None, None, spec.dataset, None if p is None else str(p)) for p in parts]
    states = partition_states(changed, spec, sketches).unionByName(spark.createDataFrame(asked, STATE_SCHEMA))
    write_table(states, path, ["dataset", "part"], only_present=True)


def read_states(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """The states of one dataset; only its folders are read."""
    return spark.read.schema(STATE_SCHEMA).parquet(path).filter(F.col("dataset") == dataset)


def assess_states(states: DataFrame, df: DataFrame, spec: QualitySpec) -> DataFrame:
    """The scored checks of the whole table, as ``assess`` gives them, from its states alone.

    Of ``df`` only the column types are looked at.
    """
    _check(df, spec)
    probes = column_probes(df, spec)
    of = lambda alias: F.when((F.col("kind") == "measure") & (F.col("name") == alias), F.col("rows"))
    measured = states.agg(*[F.coalesce(F.sum(of(alias)), F.lit(0)).alias(alias) for alias in probe_measures(probes)])
    by_region = states.filter("kind = 'region'").groupBy("name").agg(
        *[F.sum(name).alias(name) for name in ("rows", "mismatched", "unique_rows", "unique_keys")],
        *[f(F.when(F.col("rows") > 0, F.expr("try_cast(part AS BIGINT)"))).alias(a) for f, a in ((F.min, "_first"), (F.max, "_last"))],
    )
    grouped = by_region.agg(
        F.sum("rows").alias("_n"),
        F.sum("mismatched").alias("_bad"),
        F.sum("unique_rows").alias("unique_rows"),
        F.sum("unique_keys").alias("unique_keys"),
        F.count(F.when(F.col("rows") < spec.rare_below, 1)).alias("_rare"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )
    parts = [
        tidy_row(measured, spec.dataset, [m for probe in probes for m in probe.metrics]),
        tidy_row(grouped, spec.dataset, score_metrics(df, spec)),
    ]
    return reduce(DataFrame.unionByName, parts)


def state_quantiles(states: DataFrame, probabilities: Sequence[float] = (0.25, 0.75)) -> DataFrame:
    """(column, probability, value) from merged sketches: values of which a share of about
    ``probability`` is no larger, off by at most ``QUANTILE_ERROR`` of the rows as a rule."""
    merged = states.filter("kind = 'quantiles'").groupBy(F.col("name").alias("column")).agg(
        F.expr(f"kll_merge_agg_double(sketch, {QUANTILE_SIZE})").alias("sketch")
    )
    wanted = ", ".join(f"struct({float(p)}D AS probability, kll_sketch_get_quantile_double(sketch, {float(p)}D) AS value)" for p in probabilities)
    return merged.filter("kll_sketch_get_n_double(sketch) > 0").select("column", F.expr(f"inline(array({wanted}))"))


def state_distinct(states: DataFrame) -> DataFrame:
    """(column, distinct_count) from merged sketches, NULL not counted; off by a share of at most
    ``DISTINCT_ERROR`` as a rule."""
    merged = states.filter("kind = 'distinct'").groupBy(F.col("name").alias("column"))
    return merged.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))).alias("distinct_count"))


def state_outliers(states: DataFrame, df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """(column, low, high, outliers): values beyond the quartiles by more than 1.5 of their distance.

    The bounds come from merged sketches and stand as constants, so counting is one pass over ``df``.
    """
    found = {(r["column"], r["probability"]): r["value"] for r in state_quantiles(states, (0.25, 0.75)).collect()}
    counts, rows = [], []
    for at, name in enumerate(numeric_columns(df, skip)):
        first, third = found.get((name, 0.25)), found.get((name, 0.75))
        if first is None:
            continue
        low, high = (literal(v) for v in (first - 1.5 * (third - first), third + 1.5 * (third - first)))
        value = number_sql(name)
        counts.append(f"count(CASE WHEN {value} < {low} OR {value} > {high} THEN 1 END) AS n{at}")
        rows.append(f"{literal(name)}, {low}, {high}, n{at}")
    if not rows:
        return df.sparkSession.createDataFrame([], "column string, low double, high double, outliers bigint")
    return df.selectExpr(*counts).selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (column, low, high, outliers)")
