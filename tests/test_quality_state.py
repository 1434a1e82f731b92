"""States of partitions against the checks over the whole table."""

import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

import granary as g
from granary.operators import quality_state
from granary.plans import presets

SPEC = presets.quality_spec("produksi_pangan")
SCHEMA = "kabupaten_kota string, komoditas string, produksi double, luas_panen double, produktivitas double, tahun int"


def rows_of(count, seed, years):
    rnd = random.Random(seed)
    return [
        (
            rnd.choice(["A", "B", "C", "rare", None]) if k % 40 else "rare", rnd.choice(["x", "8888", None, "y"]),
            rnd.choice([None, -1.0, 8888.0, float("nan"), 12.5, 100.0]), rnd.choice([0.0, 2.0, None]), rnd.choice([6.25, 1.0, None]), rnd.choice(years),
        )
        for k in range(count)
    ]


@pytest.fixture
def table(spark, tmp_path):
    """Writes a table by year, or some years of it, and reads it again."""

    def write(rows, **options):
        frame = spark.createDataFrame(rows, SCHEMA)
        g.write_table(frame, str(tmp_path / "table"), "tahun", **options)
        return spark.read.schema(frame.schema).parquet(str(tmp_path / "table"))

    return write


def judged(df):
    return tuples(df.select("dataset", "check", "column", "metric", F.round("value", 9), "detail"))


def assert_same(states, stored):
    assert judged(g.assess_states(states, stored, SPEC)) == judged(g.assess(stored, SPEC, checks=g.SCORED_CHECKS))


@pytest.mark.parametrize("years", [[2001], [2001, 2002, 2003], [1990, 2001, 2099, None]])
def test_states_add_up_to_the_whole(spark, tmp_path, table, years):
    stored = table(rows_of(400, 1, years))
    path = str(tmp_path / "states")
    g.refresh_states(stored, SPEC, path, years)
    assert_same(g.read_states(spark, path, SPEC.dataset), stored)
    assert g.read_states(spark, path, "other").count() == 0


def test_only_changed_years_are_measured(spark, tmp_path, table):
    path = str(tmp_path / "states")
    stored = table(rows_of(300, 2, [2001, 2002, 2003]))
    g.refresh_states(stored, SPEC, path, [2001, 2002, 2003])
    stored = table(rows_of(50, 3, [2002]) * 2, only_present=True)
    assert {r["tahun"] for r in stored.select("tahun").distinct().collect()} == {2001, 2002, 2003}
    plan = g.partition_states(stored.filter(F.col("tahun").isin([2002])), SPEC)._jdf.queryExecution().toString()
    scans = [line for line in plan.split("\n") if "PartitionFilters" in line]
    assert scans and all("2002" in line for line in scans)
    g.refresh_states(stored, SPEC, path, [2002])
    assert_same(g.read_states(spark, path, SPEC.dataset), stored)


def test_a_year_without_rows_loses_its_state(spark, tmp_path, table):
    path = str(tmp_path / "states")
    stored = table(rows_of(300, 2, [2001, 2002]))
    g.refresh_states(stored, SPEC, path, [2001, 2002])
    stored = table(rows_of(200, 4, [2001]))
    g.refresh_states(stored, SPEC, path, [2001, 2002])
    assert_same(g.read_states(spark, path, SPEC.dataset), stored)


def test_states_of_nothing(spark, tmp_path, table):
    stored = table(rows_of(10, 2, [2001])).filter("false")
    path = str(tmp_path / "states")
    g.refresh_states(stored, SPEC, path, [2001])
    states = g.read_states(spark, path, SPEC.dataset)
    assert_same(states, stored)
    assert g.state_quantiles(states).collect() == [] and g.state_outliers(states, stored).collect() == []


def test_sketches_of_years_answer_for_all(spark, tmp_path, table):
    rnd = random.Random(5)
    values = [(f"R{k % 700}", "x", rnd.gauss(0, 100) if k % 50 else 1e6, float(k), None, 2001 + k % 3) for k in range(20_000)]
    stored = table(values)
    path = str(tmp_path / "states")
    g.refresh_states(stored, SPEC, path, [2001, 2002, 2003])
    states = g.read_states(spark, path, SPEC.dataset)
    found = {(r["column"], r["probability"]): r["value"] for r in g.state_quantiles(states, (0.0, 0.5, 1.0)).collect()}
    assert ("produktivitas", 0.5) not in found and found["produksi", 1.0] == 1e6 and found["luas_panen", 0.0] == 0
    assert abs(found["luas_panen", 0.5] - 10_000) <= quality_state.QUANTILE_ERROR * 20_000
    distinct = {r["column"]: r["distinct_count"] for r in g.state_distinct(states).collect()}
    assert distinct["produktivitas"] == 0 and distinct["tahun"] == 3
    assert abs(distinct["luas_panen"] - 20_000) <= quality_state.DISTINCT_ERROR * 20_000
    outliers = {r["column"]: r for r in g.state_outliers(states, stored, skip=["tahun"]).collect()}
    production = outliers["produksi"]
    assert production["outliers"] == sum(not production["low"] <= v[2] <= production["high"] for v in values) >= 400
    assert outliers["luas_panen"]["outliers"] == 0


def test_keys_without_the_year_do_not_add_up(rows):
    df = rows(SCHEMA)
    with pytest.raises(ValueError, match="key"):
        g.partition_states(df, g.QualitySpec("x", key_columns=("komoditas",), year_column="tahun", region_column="kabupaten_kota"))


def test_only_an_overwrite_by_partitions_replaces_those_present(rows, tmp_path):
    with pytest.raises(ValueError, match="partitions"):
        g.write_table(rows("a int", (1,)), str(tmp_path / "t"), only_present=True)
