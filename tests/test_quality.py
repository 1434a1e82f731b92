import random

import numpy as np
import pytest
from conftest import metrics, tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import granary as g
from granary import QualitySpec, RatioCheck
from granary.operators import quality
from granary.operators.quantiles import summary_and_quantiles

SPEC = QualitySpec(
    dataset="d",
    expected_columns=("region", "tahun", "made", "area", "rate"),
    key_columns=("region", "tahun"),
    markers=("#N/A", "8888", "-"),
    non_negative=("made",),
    year_column="tahun",
    region_column="region",
    ratio=RatioCheck("rate", "made", "area"),
)


@pytest.fixture
def crops(rows):
    return rows(
        "region string, tahun int, made double, area double, rate double",
        *[("North", 2001, 10.0, 2.0, 5.0)] * 6,
        ("North", 2001, 12.0, 2.0, 6.0),
        ("South", 2018, -1.0, 2.0, None),
        ("-", 1999, 8888.0, 4.0, 1.0),
        (None, 2005, float("nan"), None, 1.0),
    )


def test_schema(crops):
    found = metrics(g.check_schema(crops.drop("rate").withColumn("x", F.lit(1)), SPEC.expected_columns, "d"))
    assert found == {
        ("schema", "rate", "missing"): 1,
        ("schema", "x", "extra"): 1,
        ("schema", "*", "schema_valid"): 0,
    }


def test_completeness(crops):
    found = metrics(g.completeness(crops, "d"))
    assert found["completeness", "made", "null_count"] == 1  # NaN
    assert found["completeness", "region", "null_percentage"] == 10
    assert found["completeness", "*", "overall_completeness"] == pytest.approx(100 * 46 / 50)
    assert found["completeness", "*", "threshold_met"] == 1


def test_validity(crops):
    found = metrics(g.validity(crops, SPEC))
    assert found["validity", "region", "marker_count"] == 1
    assert found["validity", "made", "marker_count"] == 1
    assert found["validity", "made", "negative_count"] == 1
    assert found["validity", "tahun", "year_out_of_range"] == 1
    assert found["validity", "*", "total_invalid_values"] == 4
    assert found["validity", "*", "validity_score"] == pytest.approx(92)
    assert found["validity", "*", "threshold_met"] == 0


@pytest.mark.parametrize("rows_by", ["columns", "hash"])
def test_uniqueness(crops, rows_by):
    found = metrics(g.uniqueness(crops, "d", SPEC.key_columns, rows_by))
    assert found["uniqueness", "*", "total_rows"] == 10
    assert found["uniqueness", "*", "unique_rows"] == 5
    assert found["uniqueness", "*", "duplicate_percentage"] == 50
    assert found["uniqueness", "*", "unique_keys"] == 4
    assert found["uniqueness", "*", "key_duplicates"] == 6


def test_hashed_rows_tell_nulls_apart_by_position(rows):
    df = rows("a int, b int", (None, 1), (1, None), (1, 1), (None, None))
    found = metrics(g.uniqueness(df, "d", rows="hash"))
    assert found["uniqueness", "*", "unique_rows"] == 4


def test_key_duplicates_count_null_as_a_value(rows):
    df = rows("k int", (None,), (None,), (1,))
    found = metrics(g.key_duplicates(df, "d", ["k"]))
    assert found["uniqueness", "*", "key_duplicates"] == 1


def test_consistency(crops):
    found = metrics(g.consistency(crops, SPEC))
    assert found["consistency", "region", "rare_values"] == 3  # South, "-" and NULL
    assert found["consistency", "tahun", "year_span"] == 19
    assert found["consistency", "rate", "ratio_mismatch"] == 1
    assert found["consistency", "*", "consistency_issues"] == 3
    assert found["consistency", "*", "consistency_score"] == 70
    assert found["consistency", "*", "threshold_met"] == 0


def test_consistency_without_its_columns(rows):
    found = metrics(g.consistency(rows("x int", (1,)), SPEC))
    assert found["consistency", "*", "consistency_score"] == 100


def test_rare_and_top_values(rows):
    df = rows("v string", *[("a",)] * 3, ("b",), ("c",), (None,))
    assert tuples(g.rare_values(df, "v", 2)) == [("b", 1), ("c", 1), (None, 1)]
    assert [tuple(r) for r in g.top_values(df, "v", 2).collect()] == [("a", 3), (None, 1)]
    assert [tuple(r) for r in g.top_values(df, "v", 2, "asc").collect()] == [(None, 1), ("b", 1)]


def test_outliers(rows):
    df = rows("v double, constant int, tahun int", *[(float(i), 1, 2000) for i in range(20)],
              (1000.0, 1, 2000), (-1000.0, 1, 2000))
    found = metrics(g.outliers_iqr(df, "d", skip=["tahun"]))
    assert found["outliers", "v", "iqr_outliers"] == 2
    assert found["outliers", "v", "lower_bound"] == 4 - 1.5 * 11
    assert found["outliers", "constant", "iqr_outliers"] == 0
    assert not any(column == "tahun" for _, column, _ in found)
    upper = metrics(g.outliers_z(df, "d"))
    both = metrics(g.outliers_z(df, "d", two_sided=True))
    assert upper["outliers", "v", "z_score_outliers"] == 1
    assert both["outliers", "v", "z_score_outliers"] == 2
    assert upper["outliers", "constant", "z_score_outliers"] == 0  # no deviation


def test_approximate_outliers_agree_on_small_data(rows):
    df = rows("v double", *[(float(i * i),) for i in range(300)])
    exact = metrics(g.outliers_iqr(df, "d"))
    assert metrics(g.outliers_iqr(df, "d", method="approximate")) == exact


def test_too_few_values_have_no_outliers(rows):
    df = rows("v double, s string", (1.0, "x"))
    assert g.outliers_iqr(df.select("s"), "d").count() == 0
    assert metrics(g.outliers_z(df, "d")) == {}


numbers = st.lists(
    st.one_of(
        st.none(),
        st.integers(-3, 3).map(float),
        st.floats(allow_nan=True, allow_infinity=False, width=64),
    ),
    max_size=40,
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=numbers)
def test_quantiles_match_sorting(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    probabilities = (0.0, 0.25, 0.5, 0.75, 1.0)
    summary, found = summary_and_quantiles(df, ["v"], probabilities, bins=4, finish_rows=3)
    kept = sorted(v for v in values if v is not None and v == v)
    assert summary["v"]["n"] == len(kept)
    if kept:
        ranks = [max(1, int(np.ceil(p * len(kept)))) for p in probabilities]
        assert found["v"] == [kept[rank - 1] for rank in ranks]
    else:
        assert found["v"] == [None] * 5


def test_quantiles_of_a_hot_value(spark):
    df = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7.0 ELSE CAST(id AS DOUBLE) END AS v", "id AS w"
    )
    found = g.exact_quantiles(df, ["v", "w"], (0.25, 0.5, 0.9), bins=16, finish_rows=50)
    pandas = df.toPandas()
    for column in ("v", "w"):
        ordered = np.sort(pandas[column].to_numpy(dtype=float))
        expected = [ordered[int(np.ceil(p * 30_000)) - 1] for p in (0.25, 0.5, 0.9)]
        assert found[column] == expected


def test_summary_matches_numpy(spark):
    values = np.random.default_rng(1).lognormal(3, 2, 2000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    facts = summary_and_quantiles(df, ["v"], (0.5,))[0]["v"]
    assert facts["mean"] == pytest.approx(values.mean(), rel=1e-12)
    assert facts["stddev"] == pytest.approx(values.std(ddof=1), rel=1e-12)
    assert (facts["min"], facts["max"]) == (values.min(), values.max())


@pytest.mark.parametrize("approximate", [False, True])
def test_profile(crops, approximate):
    result = g.profile(crops, "d", k=2, approximate=approximate)
    found = metrics(result)
    assert found["profile", "region", "distinct_count"] == 3
    assert found["profile", "region", "null_count"] == 1
    assert found["profile", "region", "cardinality"] == 2
    assert found["profile", "tahun", "distinct_count"] == 4
    assert ("profile", "tahun", "cardinality") not in found
    assert found["profile", "area", "max"] == 4
    listed = result.filter("metric LIKE 'value_%'").orderBy("metric").collect()
    assert [(r["detail"], r["value"]) for r in listed] == [(None, 1.0), ("-", 1.0)]
    kinds = result.filter("metric = 'data_type'").collect()
    assert {r["column"]: r["detail"] for r in kinds}["made"] == "double"


def test_profile_counts_every_type(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (0.0D, DATE'2020-01-01', TIMESTAMP'2020-01-01 00:00:00', true, "
        "1.5BD, array(1), X'01'), (-0.0D, DATE'2020-01-02', TIMESTAMP'2020-01-01 00:00:01', "
        "false, 1.50BD, array(1), X'02'), (NULL, NULL, NULL, NULL, NULL, NULL, NULL) "
        "AS t(d, day, ts, b, n, a, x)"
    )
    found = metrics(g.profile(df, "d"))
    distinct = {c: found["profile", c, "distinct_count"] for c in df.columns}
    assert distinct == {"d": 1, "day": 2, "ts": 2, "b": 2, "n": 1, "a": 1, "x": 2}
    assert {found["profile", c, "null_count"] for c in df.columns} == {1}
    assert tuples(g.value_counts(df, ["d"])) == [("d", "0.0", 2), ("d", None, 1)]


def test_assess_agrees_with_the_single_checks(crops):
    together = metrics(g.assess(crops, SPEC))
    parts = [
        g.check_schema(crops, SPEC.expected_columns, "d"),
        g.completeness(crops, "d"),
        g.validity(crops, SPEC),
        g.uniqueness(crops, "d", SPEC.key_columns),
        g.consistency(crops, SPEC),
        g.outliers_iqr(crops, "d", ["tahun"]),
        g.outliers_z(crops, "d", ["tahun"]),
        g.profile(crops, "d"),
    ]
    for part in parts:
        for key, value in metrics(part).items():
            assert together[key] == pytest.approx(value, nan_ok=True), key
    assert together["overview", "*", "row_count"] == 10


def test_assess_with_a_region_outside_the_keys(crops):
    from dataclasses import replace

    found = metrics(g.assess(crops, replace(SPEC, key_columns=("tahun",))))
    assert found["uniqueness", "*", "unique_keys"] == 4
    assert found["consistency", "region", "rare_values"] == 3


def test_score_and_report(crops):
    report = g.quality_report(g.assess(crops, SPEC)).first()
    assert report["completeness"] == pytest.approx(92)
    assert report["schema"] == 100
    expected = 92 * 0.25 + 92 * 0.25 + 50 * 0.2 + 70 * 0.2 + 10
    assert report["overall_score"] == pytest.approx(expected)
    assert report["status"] == "PASS"
    assert report["duplicate_count"] == 5
    assert report["missing_columns"] == ""
    partial = g.quality_report(g.completeness(crops, "d")).first()
    assert partial["overall_score"] == 23  # absent checks score nothing
    assert partial["status"] == "FAIL"


def test_report_names_missing_columns(crops):
    report = g.quality_report(g.assess(crops.drop("rate", "area"), SPEC)).first()
    assert report["missing_columns"] == "area, rate"
    assert report["schema"] == 0


def test_empty_input(crops):
    found = metrics(g.assess(crops.filter("false"), SPEC))
    assert found["overview", "*", "row_count"] == 0
    assert found["completeness", "*", "overall_completeness"] is None
    assert found["uniqueness", "*", "uniqueness_score"] is None
    assert found["consistency", "tahun", "year_span"] is None
    assert found["validity", "*", "threshold_met"] == 1


def test_one_scan_for_all_aggregates(crops, tmp_path):
    path = str(tmp_path / "crops")
    crops.write.parquet(path)
    stored = crops.sparkSession.read.parquet(path)
    probes = [quality.completeness_probe(stored), quality.validity_probe(stored, SPEC)]
    plan = quality.run_probes(stored, "d", probes)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1


def test_scored_checks_take_two_scans(crops, tmp_path):
    path = str(tmp_path / "scored")
    crops.write.parquet(path)
    stored = crops.sparkSession.read.parquet(path)
    judged = g.assess(stored, SPEC, checks=g.SCORED_CHECKS)
    assert judged._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    whole = g.quality_report(g.assess(stored, SPEC)).first()
    assert g.quality_report(judged).first() == whole
    with pytest.raises(ValueError, match="unknown"):
        g.assess(stored, SPEC, checks=["speed"])


def test_years_read_as_the_cleaner_reads_them(rows):
    df = rows("region string, tahun string", ("a", "1899.0"), ("a", "1899"), ("a", "2010"), ("a", "x"), ("a", "1e3"))
    spec = g.QualitySpec("d", year_column="tahun", region_column="region")
    assert metrics(g.validity(df, spec))["validity", "tahun", "year_out_of_range"] == 2
    assert metrics(g.consistency(df, spec))["consistency", "tahun", "year_span"] == 111


def test_long_texts_are_listed_without_being_keys(rows):
    long = "x" * 300
    df = rows("t string", (long + "b",), (long + "a",), (long + "a",), (None,), (None,), ("y",))
    found = g.profile(df, "d", k=3)
    assert metrics(found)["profile", "t", "distinct_count"] == 3
    listed = {r["metric"]: r["detail"] for r in found.filter("metric LIKE 'value%'").collect()}
    assert listed == {"value_1": long + "b", "value_2": "y", "value_3": None}
    about = metrics(g.profile(df, "d", k=3, approximate=True))
    assert about["profile", "t", "distinct_count"] == 3 and about["profile", "t", "cardinality"] == 3


@pytest.mark.parametrize("case", ["heavy tail", "all alike", "few", "nulls", "numbers", "nothing"])
def test_top_values_in_bounded_memory(spark, case):
    rnd = random.Random(4)
    values = {
        "heavy tail": [f"v{min(int(rnd.paretovariate(0.6)), 10**6)}" for _ in range(20_000)],
        "all alike": [f"u{k}" for k in range(3000)],
        "few": ["b", "a", "b", "c"],
        "nulls": [None] * 50 + ["x"] * 50 + ["y"],
        "numbers": [k * k % 97 for k in range(2000)],
        "nothing": [],
    }[case]
    df = spark.createDataFrame([(v,) for v in values], "v " + ("long" if case == "numbers" else "string")).repartition(4)
    for k in (1, 5):
        bounded = g.top_values_bounded(df, "v", k, tracked=256)
        assert sorted(map(tuple, bounded.collect()), key=repr) == sorted(map(tuple, g.top_values(df, "v", k).collect()), key=repr)
        # Only where nothing can be told are all values counted.
        if case in ("few", "nulls", "numbers") or case == "heavy tail" and k == 1:
            assert "Exchange" not in bounded._jdf.queryExecution().toString()


def test_listed_values_read_texts_only_of_long_ones(spark, capsys):
    long = "z" * 300
    values = [*["a"] * 50, *["b"] * 3, None, *[long + "1"] * 2, long + "2", "z" * 256, "z" * 255]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    listed = g.profile(df, "d", k=6)
    found = {r["metric"]: (r["value"], r["detail"]) for r in listed.collect() if r["metric"].startswith("value_")}
    assert list(dict(sorted(found.items())).values()) == [
        (1, None), (1, "z" * 255), (1, "z" * 256), (1, long + "2"), (2, long + "1"), (3, "b"),
    ]
    listed.explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if line.startswith("Condition") and "length" in line]
    assert any(">= 256" in line for line in filters)
