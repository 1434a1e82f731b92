"""The quality queries of the workload and their SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import granary as g
from granary.operators import quality_state
from granary.plans import presets
from workload import scratch
from workload.catalog import query, rounded
from workload.views import VIEWS, Tables, view, with_views

ROWS = "count(*)"
LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PRODUCTION_SPEC_COLUMNS = presets.DECLARED_COLUMNS["produksi_pangan"]


def tidy_sql(source: str, dataset: str, entries: Sequence[tuple]) -> str:
    """One tidy row per entry, each an aggregate over ``source``."""
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{entry[0]}' AS \"check\", '{entry[1]}' AS \"column\", "
        f"'{entry[2]}' AS metric, round(CAST({entry[3]} AS DOUBLE), 6) AS value, "
        f"CAST({entry[4] if len(entry) > 4 else 'NULL'} AS VARCHAR) AS detail FROM {source}"
        for entry in entries
    )


def tidy(df: DataFrame) -> DataFrame:
    return rounded(df, "value")


# ---------------------------------------------------------------- schema


@query(
    "dq_schema",
    tidy_sql(
        "lineitem",
        "lineitem",
        [
            ("overview", "*", "row_count", ROWS),
            ("overview", "*", "column_count", "max(11)"),
            ("schema", "l_comment", "missing", "max(1)"),
            *[
                ("schema", name, "extra", "max(1)")
                for name in (
                    "l_partkey",
                    "l_suppkey",
                    "l_linenumber",
                    "l_extendedprice",
                    "l_discount",
                    "l_returnflag",
                    "l_linestatus",
                    "l_shipdate",
                )
            ],
            ("schema", "*", "schema_valid", "max(0)"),
        ],
    ),
)
def _schema(t: Tables) -> DataFrame:
    expected = ["l_orderkey", "l_quantity", "l_comment", "l_tax"]
    spec = g.QualitySpec("lineitem", expected_columns=tuple(expected))
    return tidy(g.assess(t.lineitem, spec, checks=("overview", "schema")))


# ---------------------------------------------------------------- completeness

GAPS = "(SELECT *, CASE WHEN o_orderkey % 9 = 0 THEN 'nan'::DOUBLE ELSE amount END AS noisy FROM gappy_orders)"


def completeness_entries(columns: Sequence[str], floats: Sequence[str] = ()) -> list[tuple]:
    missing = {
        c: f"count(*) FILTER ({c} IS NULL" + (f" OR isnan({c}))" if c in floats else ")")
        for c in columns
    }
    entries: list[tuple] = []
    for column, count in missing.items():
        entries += [
            ("completeness", column, "null_count", count),
            ("completeness", column, "null_percentage", f"{count} * 100.0 / {ROWS}"),
            ("completeness", column, "completeness_score", f"({ROWS} - {count}) * 100.0 / {ROWS}"),
        ]
    cells = f"({ROWS} * {len(columns)})"
    overall = f"(({cells} - ({' + '.join(missing.values())})) * 100.0 / {cells})"
    return entries + [
        ("completeness", "*", "overall_completeness", overall),
        ("completeness", "*", "threshold_met", f"CAST({overall} >= 90 AS INTEGER)"),
    ]


@query(
    "dq_completeness",
    with_views(
        tidy_sql(
            GAPS,
            "orders",
            completeness_entries(
                ["o_orderkey", "status", "amount", "noisy"], floats=["amount", "noisy"]
            ),
        ),
        "gappy_orders",
    ),
)
def _completeness(t: Tables) -> DataFrame:
    noisy = F.expr("CASE WHEN o_orderkey % 9 = 0 THEN double('NaN') ELSE amount END")
    return tidy(g.completeness(view(t, "gappy_orders").withColumn("noisy", noisy), "orders"))


# ---------------------------------------------------------------- uniqueness


def uniqueness_entries(rows: bool, keys: bool) -> list[tuple]:
    entries: list[tuple] = [("uniqueness", "*", "total_rows", "max(total)")]
    if rows:
        entries += [
            ("uniqueness", "*", "unique_rows", "max(uniq)"),
            ("uniqueness", "*", "duplicate_count", "max(total - uniq)"),
            ("uniqueness", "*", "duplicate_percentage", "max((total - uniq) * 100.0 / total)"),
            ("uniqueness", "*", "uniqueness_score", "max(uniq * 100.0 / total)"),
        ]
    if keys:
        entries += [
            ("uniqueness", "*", "unique_keys", "max(keys)"),
            ("uniqueness", "*", "key_duplicates", "max(total - keys)"),
        ]
    return entries


def uniqueness_source(name: str, keys: Sequence[str]) -> str:
    return (
        f"(SELECT (SELECT count(*) FROM {name}) AS total, "
        f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {name})) AS uniq, "
        f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {name})) AS keys)"
    )


LINE_KEYS = ["l_orderkey", "l_linenumber"]
UNIQUENESS_SQL = with_views(
    tidy_sql(
        uniqueness_source("doubled_lines", LINE_KEYS), "lineitem", uniqueness_entries(True, True)
    ),
    "doubled_lines",
)


@query("dq_uniqueness", UNIQUENESS_SQL)
def _uniqueness(t: Tables) -> DataFrame:
    return tidy(g.uniqueness(view(t, "doubled_lines"), "lineitem", LINE_KEYS))


@query("dq_uniqueness_hashed", UNIQUENESS_SQL)
def _uniqueness_hashed(t: Tables) -> DataFrame:
    return tidy(g.uniqueness(view(t, "doubled_lines"), "lineitem", LINE_KEYS, rows="hash"))


@query(
    "dq_key_duplicates",
    with_views(
        tidy_sql(
            uniqueness_source("raw_social", ['"Kabupaten/Kota"', "Tahun"]),
            "social",
            uniqueness_entries(False, True),
        ),
        "raw_social",
    ),
)
def _key_duplicates(t: Tables) -> DataFrame:
    return tidy(g.key_duplicates(view(t, "raw_social"), "social", ["Kabupaten/Kota", "Tahun"]))


# ---------------------------------------------------------------- validity

MARKERS_SQL = "('#N/A', '8888', '9999', '-')"


def validity_entries(counts: Sequence[tuple[str, str, str]], columns: int) -> list[tuple]:
    entries: list[tuple] = [
        ("validity", column, metric, f"count(*) FILTER ({predicate})")
        for column, metric, predicate in counts
    ]
    total = "(" + " + ".join(entry[3] for entry in entries) + ")"
    cells = f"({ROWS} * {columns})"
    return entries + [
        ("validity", "*", "total_invalid_values", total),
        ("validity", "*", "validity_score", f"({cells} - {total}) * 100.0 / {cells}"),
        ("validity", "*", "threshold_met", f"CAST({total} * 1.0 / {cells} < 0.05 AS INTEGER)"),
    ]


RAW_PRODUCTION = list(VIEWS["raw_production"].columns)
# The year check of text columns cuts off decimal fractions, as the cleaner does.
RAW_VALIDITY = [
    *[(c, "marker_count", f"{c} IN {MARKERS_SQL}") for c in RAW_PRODUCTION],
    (
        "tahun",
        "year_out_of_range",
        "TRY_CAST(split_part(tahun, '.', 1) AS INTEGER) NOT BETWEEN 2000 AND 2030",
    ),
]


@query(
    "dq_validity",
    with_views(
        tidy_sql("raw_production", "produksi_pangan", validity_entries(RAW_VALIDITY, 6)),
        "raw_production",
    ),
)
def _validity(t: Tables) -> DataFrame:
    spec = presets.quality_spec("produksi_pangan")
    return tidy(g.validity(view(t, "raw_production"), spec))


def production_validity() -> list[tuple[str, str, str]]:
    return [
        ("kabupaten_kota", "marker_count", f"kabupaten_kota IN {MARKERS_SQL}"),
        ("komoditas", "marker_count", f"komoditas IN {MARKERS_SQL}"),
        ("produksi", "marker_count", "produksi IN (8888, 9999)"),
        ("produksi", "negative_count", "produksi < 0"),
        ("luas_panen", "marker_count", "luas_panen IN (8888, 9999)"),
        ("luas_panen", "negative_count", "luas_panen < 0"),
        ("produktivitas", "marker_count", "produktivitas IN (8888, 9999)"),
        ("tahun", "marker_count", "tahun IN (8888, 9999)"),
        ("tahun", "year_out_of_range", "tahun NOT BETWEEN 2000 AND 2030"),
    ]


@query(
    "dq_validity_typed",
    with_views(
        tidy_sql("production", "produksi_pangan", validity_entries(production_validity(), 6)),
        "production",
    ),
)
def _validity_typed(t: Tables) -> DataFrame:
    return tidy(g.validity(view(t, "production"), presets.quality_spec("produksi_pangan")))


# ---------------------------------------------------------------- consistency

MISMATCH_SQL = (
    "produksi > 0 AND luas_panen > 0 AND abs(produktivitas - produksi / luas_panen) > 0.1"
)
CONSISTENCY_SOURCE = (
    "(SELECT (SELECT count(*) FROM (SELECT kabupaten_kota FROM production GROUP BY 1 "
    "HAVING count(*) < 5)) AS rare, "
    "(SELECT max(tahun) - min(tahun) FROM production) AS span, "
    f"(SELECT count(*) FROM production WHERE {MISMATCH_SQL}) AS bad)"
)
ISSUES = (
    "max(CASE WHEN rare > 0 THEN 1 ELSE 0 END + CASE WHEN span > 15 THEN 1 ELSE 0 END "
    "+ CASE WHEN bad > 0 THEN 1 ELSE 0 END)"
)
CONSISTENCY_ENTRIES: list[tuple] = [
    ("consistency", "kabupaten_kota", "rare_values", "max(rare)"),
    ("consistency", "tahun", "year_span", "max(span)"),
    ("consistency", "produktivitas", "ratio_mismatch", "max(bad)"),
    ("consistency", "*", "consistency_issues", ISSUES),
    ("consistency", "*", "consistency_score", f"100 - {ISSUES} * 10"),
    ("consistency", "*", "threshold_met", f"CAST({ISSUES} <= 2 AS INTEGER)"),
]


@query(
    "dq_consistency",
    with_views(
        tidy_sql(CONSISTENCY_SOURCE, "produksi_pangan", CONSISTENCY_ENTRIES), "production"
    ),
)
def _consistency(t: Tables) -> DataFrame:
    return tidy(g.consistency(view(t, "production"), presets.quality_spec("produksi_pangan")))


TEXT_YEAR = "TRY_CAST(split_part(tahun, '.', 1) AS INTEGER)"
RAW_CONSISTENCY_SOURCE = (
    "(SELECT (SELECT count(*) FROM (SELECT kabupaten_kota FROM raw_production GROUP BY 1 "
    "HAVING count(*) < 5)) AS rare, "
    f"(SELECT max({TEXT_YEAR}) - min({TEXT_YEAR}) FROM raw_production) AS span, "
    "(SELECT count(*) FROM raw_production WHERE TRY_CAST(produksi AS DOUBLE) > 0 AND "
    "TRY_CAST(luas_panen AS DOUBLE) > 0 AND abs(TRY_CAST(produktivitas AS DOUBLE) - "
    "TRY_CAST(produksi AS DOUBLE) / TRY_CAST(luas_panen AS DOUBLE)) > 0.1) AS bad)"
)


@query(
    "dq_consistency_raw",
    with_views(
        tidy_sql(RAW_CONSISTENCY_SOURCE, "produksi_pangan", CONSISTENCY_ENTRIES), "raw_production"
    ),
)
def _consistency_raw(t: Tables) -> DataFrame:
    return tidy(g.consistency(view(t, "raw_production"), presets.quality_spec("produksi_pangan")))


@query(
    "dq_rare_values",
    "SELECT user_id AS value, count(*) AS rows FROM events GROUP BY 1 HAVING count(*) < 65",
)
def _rare_values(t: Tables) -> DataFrame:
    return g.rare_values(t.events, "user_id", 65)


# ---------------------------------------------------------------- outliers


def iqr_entries(column: str, source: str) -> list[tuple]:
    q1, q3 = (f"(SELECT quantile_disc({column}, {q}) FROM {source})" for q in (0.25, 0.75))
    low, high = f"({q1} - 1.5 * ({q3} - {q1}))", f"({q3} + 1.5 * ({q3} - {q1}))"
    count = f"count(*) FILTER ({column} < {low} OR {column} > {high})"
    return [
        ("outliers", column, "iqr_outliers", count),
        ("outliers", column, "lower_bound", f"max({low})"),
        ("outliers", column, "upper_bound", f"max({high})"),
        ("outliers", column, "outlier_percentage", f"{count} * 100.0 / {ROWS}"),
    ]


def z_entries(column: str, source: str, two_sided: bool = False) -> list[tuple]:
    mean, deviation = (f"(SELECT {f}({column}) FROM {source})" for f in ("avg", "stddev_samp"))
    score = f"({column} - {mean}) / {deviation}"
    score = f"abs({score})" if two_sided else score
    return [("outliers", column, "z_score_outliers", f"count(*) FILTER ({score} > 3)")]


# Squares and cubes give the otherwise flat columns a tail.
TAILED = "(SELECT value AS v1, value * value / 100 AS v2, value * value * value AS v3 FROM events)"
TAILED_COLUMNS = ["v1", "v2", "v3"]


def _tailed(t: Tables) -> DataFrame:
    return t.events.selectExpr(
        "value AS v1", "value * value / 100 AS v2", "value * value * value AS v3"
    )


LINE_IQR_SQL = tidy_sql(
    "lineitem", "lineitem", [e for c in LINE_COLUMNS for e in iqr_entries(c, "lineitem")]
)


@query("dq_outliers_iqr", LINE_IQR_SQL)
def _outliers_iqr(t: Tables) -> DataFrame:
    return tidy(g.outliers_iqr(t.lineitem.select(*LINE_COLUMNS), "lineitem"))


@query(
    "dq_outliers_iqr_tailed",
    tidy_sql(TAILED, "events", [e for c in TAILED_COLUMNS for e in iqr_entries(c, TAILED)]),
)
def _outliers_iqr_tailed(t: Tables) -> DataFrame:
    return tidy(g.outliers_iqr(_tailed(t), "events"))


WEATHER_COLUMNS = ["curah_hujan", "suhu_rata_rata"]


@query(
    "dq_outliers_with_gaps",
    with_views(
        tidy_sql(
            "weather",
            "cuaca",
            [e for c in WEATHER_COLUMNS for e in iqr_entries(c, "weather")],
        ),
        "weather",
    ),
)
def _outliers_with_gaps(t: Tables) -> DataFrame:
    return tidy(g.outliers_iqr(view(t, "weather"), "cuaca", skip=["tahun"]))


def _rank_error_sql(column: str, probability: float) -> str:
    return (
        f"SELECT '{column}' AS \"column\", CAST({probability} AS DOUBLE) AS probability, "
        "true AS close FROM lineitem HAVING count(*) > 0"
    )


@query(
    "dq_quantiles_approximate",
    " UNION ALL ".join(_rank_error_sql(c, q) for c in LINE_COLUMNS for q in (0.25, 0.75)),
)
def _quantiles_approximate(t: Tables) -> DataFrame:
    """Whether each approximate quartile's rank is off by no more than a ten-thousandth of the rows."""
    found = g.approximate_quantiles(t.lineitem, LINE_COLUMNS, (0.25, 0.75))
    cells = []
    for column, values in found.items():
        for probability, value in zip((0.25, 0.75), values):
            below = F.count(F.when(F.col(column) < value, 1))
            upto = F.count(F.when(F.col(column) <= value, 1))
            wanted, slack = F.count(column) * probability, F.count(column) / 10_000 + 1
            close = (below <= wanted + slack) & (upto >= wanted - slack)
            cells.append(F.struct(F.lit(column).alias("column"), F.lit(probability).alias("probability"), close.alias("close")))
    return t.lineitem.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


@query(
    "dq_outliers_iqr_approximate",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", true AS close FROM lineitem HAVING count(*) > 0" for c in LINE_COLUMNS
    ),
)
def _outliers_iqr_approximate(t: Tables) -> DataFrame:
    """Whether the approximate outliers of each column are those beyond its own bounds, all counted."""
    found = g.outliers_iqr(t.lineitem.select(*LINE_COLUMNS), "lineitem", method="approximate")
    wide = found.groupBy("column").pivot("metric", ["iqr_outliers", "lower_bound", "upper_bound"]).agg(F.first("value"))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in LINE_COLUMNS])
    beyond = (F.col("v") < F.col("lower_bound")) | (F.col("v") > F.col("upper_bound"))
    values = t.lineitem.select(F.inline(cells)).join(wide, "column")
    return values.groupBy("column").agg((F.count(F.when(beyond, 1)) == F.first("iqr_outliers")).alias("close"))


@query(
    "dq_outliers_z",
    tidy_sql(TAILED, "events", [e for c in TAILED_COLUMNS for e in z_entries(c, TAILED)]),
)
def _outliers_z(t: Tables) -> DataFrame:
    return tidy(g.outliers_z(_tailed(t), "events"))


@query(
    "dq_outliers_z_two_sided",
    tidy_sql(TAILED, "events", [e for c in TAILED_COLUMNS for e in z_entries(c, TAILED, True)]),
)
def _outliers_z_two_sided(t: Tables) -> DataFrame:
    return tidy(g.outliers_z(_tailed(t), "events", two_sided=True))


QUANTILES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


@query(
    "dq_quantiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({q} AS DOUBLE) AS probability, "
        f"quantile_disc({c}, {q}) AS value FROM lineitem"
        for c in LINE_COLUMNS
        for q in QUANTILES
    ),
)
def _quantiles(t: Tables) -> DataFrame:
    found = g.exact_quantiles(t.lineitem, LINE_COLUMNS, QUANTILES)
    cells = [
        F.struct(F.lit(c).alias("column"), F.lit(q).alias("probability"), F.lit(v).alias("value"))
        for c, values in found.items()
        for q, v in zip(QUANTILES, values)
    ]
    return t.spark.range(1).select(F.inline(F.array(*cells)))


# ---------------------------------------------------------------- profile


@query(
    "dq_top_values",
    "SELECT event_type AS value, count(*) AS rows FROM events GROUP BY 1 "
    "ORDER BY rows DESC, value LIMIT 3",
)
def _top_values(t: Tables) -> DataFrame:
    return g.top_values(t.events, "event_type", 3)


@query(
    "dq_top_values_bounded",
    "SELECT 'type' AS kind, value, rows FROM (SELECT event_type AS value, count(*) AS rows FROM events GROUP BY 1 ORDER BY rows DESC, value LIMIT 3) "
    "UNION ALL SELECT 'word', value, rows FROM (SELECT unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+')) AS value, "
    "count(*) AS rows FROM documents GROUP BY 1 ORDER BY rows DESC, value LIMIT 10)",
)
def _top_values_bounded(t: Tables) -> DataFrame:
    """Few values, and the words of all texts, of which there are very many."""
    words = t.documents.select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z]+"), F.lit(0))).alias("word"))
    types = g.top_values_bounded(t.events, "event_type", 3).select(F.lit("type").alias("kind"), "value", "rows")
    return types.unionByName(g.top_values_bounded(words, "word", 10).select(F.lit("word").alias("kind"), "value", "rows"))


@query(
    "dq_rarest_values",
    "SELECT user_id AS value, count(*) AS rows FROM events GROUP BY 1 ORDER BY rows, value LIMIT 5",
)
def _rarest_values(t: Tables) -> DataFrame:
    return g.top_values(t.events, "user_id", 5, "asc")


def distinct_sql(source: str, dataset: str, columns: Sequence[str], text: Sequence[str]) -> list[str]:
    parts = []
    for column in columns:
        entries = [
            ("profile", column, "distinct_count", f"count(DISTINCT {column})"),
            ("profile", column, "null_count", f"count(*) FILTER ({column} IS NULL)"),
        ]
        if column in text:
            groups = f"(SELECT count(*) FROM (SELECT DISTINCT {column} FROM {source}))"
            entries.append(("profile", column, "cardinality", f"max(least(5, {groups}))"))
        parts.append(tidy_sql(source, dataset, entries))
    return parts


def listed_sql(source: str, dataset: str, column: str) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, 'profile' AS \"check\", '{column}' AS \"column\", "
        "'value_' || row_number() OVER (ORDER BY n, v NULLS FIRST) AS metric, "
        "CAST(n AS DOUBLE) AS value, v AS detail FROM (SELECT * FROM "
        f"(SELECT {column} AS v, count(*) AS n FROM {source} GROUP BY 1) "
        "ORDER BY n, v NULLS FIRST LIMIT 5)"
    )


def profile_sql(source: str, dataset: str, types: dict[str, str]) -> str:
    text = [name for name, kind in types.items() if kind == "string"]
    numbers = [name for name, kind in types.items() if kind in ("bigint", "int", "double")]
    kinds = [("profile", name, "data_type", "NULL", f"'{kind}'") for name, kind in types.items()]
    moments = [
        ("profile", name, metric, f"{function}({name})")
        for name in numbers
        for metric, function in (
            ("min", "min"),
            ("max", "max"),
            ("mean", "avg"),
            ("stddev", "stddev_samp"),
        )
    ]
    parts = [tidy_sql("(SELECT 1)", dataset, kinds), tidy_sql(source, dataset, moments)]
    parts += distinct_sql(source, dataset, list(types), text)
    parts += [listed_sql(source, dataset, name) for name in text]
    return " UNION ALL ".join(f"({part})" for part in parts)


LINE_TYPES = {
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


@query("dq_profile", profile_sql("lineitem", "lineitem", LINE_TYPES))
def _profile(t: Tables) -> DataFrame:
    return tidy(g.profile(t.lineitem.select(*LINE_TYPES), "lineitem"))


DOCUMENT_TYPES = {"lang": "string", "source": "string", "text": "string", "n_chars": "bigint"}


@query("dq_profile_documents", profile_sql("documents", "documents", DOCUMENT_TYPES))
def _profile_documents(t: Tables) -> DataFrame:
    return tidy(g.profile(t.documents.select(*DOCUMENT_TYPES), "documents"))


PRODUCTION_TYPES = {
    "kabupaten_kota": "string",
    "komoditas": "string",
    "produksi": "double",
    "luas_panen": "double",
    "produktivitas": "double",
    "tahun": "int",
}

# ---------------------------------------------------------------- scores


SPEC = presets.quality_spec("produksi_pangan")
PARTS_SQL = (
    "SELECT (SELECT count(*) FROM production) AS n, "
    "(SELECT count(*) FROM (SELECT DISTINCT * FROM production)) AS uniq, "
    "(SELECT count(*) FILTER (kabupaten_kota IS NULL) + count(*) FILTER (komoditas IS NULL) "
    "+ count(*) FILTER (produksi IS NULL) + count(*) FILTER (luas_panen IS NULL) "
    "+ count(*) FILTER (produktivitas IS NULL) + count(*) FILTER (tahun IS NULL) "
    "FROM production) AS gaps, "
    "(SELECT "
    + " + ".join(f"count(*) FILTER ({p})" for _, _, p in production_validity())
    + f" FROM production) AS invalid, (SELECT {ISSUES} FROM {CONSISTENCY_SOURCE}) AS issues"
)
SCORES_SQL = (
    "SELECT n, uniq, invalid, issues, (n * 6 - gaps) * 100.0 / (n * 6) AS completeness, "
    "(n * 6 - invalid) * 100.0 / (n * 6) AS validity, uniq * 100.0 / n AS uniqueness, "
    f"CAST(100 - issues * 10 AS DOUBLE) AS consistency, CAST(100 AS DOUBLE) AS schema FROM ({PARTS_SQL})"
)
OVERALL_SQL = (
    "round(CAST(completeness * 0.25 + validity * 0.25 + uniqueness * 0.2 + consistency * 0.2 "
    "+ schema * 0.1 AS DOUBLE), 2)"
)
SCORE_COLUMNS = ["completeness", "validity", "uniqueness", "consistency", "schema"]
SCORE_LIST = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in SCORE_COLUMNS)


@query(
    "dq_score",
    with_views(
        f"SELECT 'produksi_pangan' AS dataset, {SCORE_LIST}, {OVERALL_SQL} AS overall_score "
        f"FROM ({SCORES_SQL})",
        "production",
    ),
)
def _score(t: Tables) -> DataFrame:
    score = g.quality_score(g.assess(view(t, "production"), SPEC, checks=g.SCORED_CHECKS))
    return rounded(score, *SCORE_COLUMNS)


@query(
    "dq_report",
    with_views(
        "SELECT *, CASE WHEN overall_score >= 80 THEN 'PASS' WHEN overall_score >= 60 "
        "THEN 'REVIEW REQUIRED' ELSE 'FAIL' END AS status FROM "
        "(SELECT 'produksi_pangan' AS dataset, n AS row_count, CAST(6 AS BIGINT) AS column_count, "
        "n - uniq AS duplicate_count, CAST(invalid AS BIGINT) AS invalid_values, "
        "CAST(issues AS BIGINT) AS consistency_issues, '' AS missing_columns, "
        f"{SCORE_LIST}, {OVERALL_SQL} AS overall_score FROM ({SCORES_SQL}))",
        "production",
    ),
)
def _report(t: Tables) -> DataFrame:
    report = g.quality_report(g.assess(view(t, "production"), SPEC, checks=g.SCORED_CHECKS))
    return rounded(report, *SCORE_COLUMNS)


def scored_parts(*more: tuple) -> list[str]:
    """The SQL of the scored checks; further entries join those of the columns."""
    return [
        tidy_sql(
            "production",
            "produksi_pangan",
            [
                ("overview", "*", "row_count", ROWS),
                ("overview", "*", "column_count", "max(6)"),
                *completeness_entries(
                    list(PRODUCTION_TYPES), floats=["produksi", "luas_panen", "produktivitas"]
                ),
                *validity_entries(production_validity(), 6),
                *more,
            ],
        ),
        tidy_sql("(SELECT 1)", "produksi_pangan", [("schema", "*", "schema_valid", "1")]),
        tidy_sql(
            uniqueness_source("production", ["kabupaten_kota", "tahun", "komoditas"]),
            "produksi_pangan",
            uniqueness_entries(True, True),
        ),
        tidy_sql(CONSISTENCY_SOURCE, "produksi_pangan", CONSISTENCY_ENTRIES),
    ]


OUTLIER_ENTRIES = [
    entry
    for c in ("produksi", "luas_panen", "produktivitas")
    for entry in [*iqr_entries(c, "production"), *z_entries(c, "production")]
]
ASSESS_SQL = " UNION ALL ".join(
    f"({part})"
    for part in [*scored_parts(*OUTLIER_ENTRIES), profile_sql("production", "produksi_pangan", PRODUCTION_TYPES)]
)


@query("dq_assess", with_views(ASSESS_SQL, "production"))
def _assess(t: Tables) -> DataFrame:
    return tidy(g.assess(view(t, "production"), SPEC))


# Two years are written anew: one with other values, one with fewer and repeated rows.
CHANGED = (
    "SELECT kabupaten_kota, komoditas, CASE WHEN tahun = 1996 THEN 2 * produksi ELSE produksi END AS produksi, "
    "luas_panen, produktivitas, tahun FROM {0} WHERE tahun <> 1997 OR komoditas LIKE 'A%' "
    "UNION ALL SELECT * FROM {0} WHERE tahun = 1997 AND komoditas = 'AF'"
)
CHANGED_SQL = f"WITH first AS ({VIEWS['production'].sql}), production AS ({CHANGED.format('first')}) "


def _states(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A table by year with the states of its years, after two years have been replaced."""
    frame = view(t, "production")
    place = scratch.folder(t.spark, "dq_states")
    table, states = f"{place}/table", f"{place}/states"
    g.write_table(frame, table, "tahun")
    stored = t.spark.read.schema(frame.schema).parquet(table)
    years = [row["tahun"] for row in stored.select("tahun").distinct().collect()]
    g.refresh_states(stored, SPEC, states, years)
    frame.createOrReplaceTempView("production_first")
    changed = t.spark.sql(CHANGED.format("production_first")).filter("tahun IN (1996, 1997)")
    g.write_table(changed, table, "tahun", only_present=True)
    stored = t.spark.read.schema(frame.schema).parquet(table)
    g.refresh_states(stored, SPEC, states, [1996, 1997])
    return g.read_states(t.spark, states, SPEC.dataset), stored


@query("dq_assess_incremental", CHANGED_SQL + " UNION ALL ".join(f"({part})" for part in scored_parts()))
def _assess_incremental(t: Tables) -> DataFrame:
    """The scored checks from states of years, of which a second run measured only two."""
    states, stored = _states(t)
    return tidy(g.assess_states(states, stored, SPEC))


NUMBERS = ["produksi", "luas_panen", "produktivitas", "tahun"]


@query(
    "dq_quartiles_incremental",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({q} AS DOUBLE) AS probability, true AS close FROM lineitem HAVING count(*) > 0"
        for c in NUMBERS for q in (0.25, 0.75)
    ),
)
def _quartiles_incremental(t: Tables) -> DataFrame:
    """Whether quartiles from merged sketches of years keep their rank error over the whole table."""
    states, stored = _states(t)
    found = g.state_quantiles(states)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in NUMBERS])
    judged = stored.select(F.inline(cells)).join(found, "column").groupBy("column", "probability").agg(
        F.count("v").alias("n"),
        F.count(F.when(F.col("v") < F.col("value"), 1)).alias("below"),
        F.count(F.when(F.col("v") <= F.col("value"), 1)).alias("upto"),
    )
    wanted, slack = F.col("n") * F.col("probability"), F.col("n") * quality_state.QUANTILE_ERROR + 1
    return judged.select("column", "probability", ((F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)).alias("close"))


@query(
    "dq_distinct_incremental",
    CHANGED_SQL + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS exact, true AS close FROM production" for c in VIEWS["production"].columns),
)
def _distinct_incremental(t: Tables) -> DataFrame:
    """Exact distinct counts, and whether those from merged sketches of years are close to them."""
    states, stored = _states(t)
    exact = stored.agg(*[F.count_distinct(c).alias(c) for c in stored.columns])
    names = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in stored.columns])
    both = exact.select(F.inline(names)).join(g.state_distinct(states), "column")
    gap = F.abs(F.col("distinct_count") - F.col("exact"))
    return both.select("column", "exact", (gap <= F.col("exact") * quality_state.DISTINCT_ERROR).alias("close"))


@query(
    "dq_outliers_incremental",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", true AS close FROM lineitem HAVING count(*) > 0" for c in NUMBERS[:3]),
)
def _outliers_incremental(t: Tables) -> DataFrame:
    """Whether all values beyond the bounds from merged sketches are counted, and those are near the exact ones."""
    states, stored = _states(t)
    found = g.state_outliers(states, stored, skip=["tahun"])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in NUMBERS[:3]])
    beyond = F.col("v").isNotNull() & ((F.col("v") < F.col("low")) | (F.col("v") > F.col("high")))
    values = stored.select(F.inline(cells)).join(found, "column")
    return values.groupBy("column").agg((F.count(F.when(beyond, 1)) == F.first("outliers")).alias("close"))
