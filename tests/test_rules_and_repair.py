import pytest
from conftest import tuples
from pyspark.sql import functions as F

import granary as g
from granary import Rule

CASES = [
    (Rule("v", low=0, low_open=True, high=10), [0.5, 10.0]),
    (Rule("v", low=0, high=10, high_open=True), [0.0, 0.5]),
    (Rule("v", low=0, nullable=True), [0.0, 0.5, 10.0, 11.0, None]),
    (Rule("v"), [-1.0, 0.0, 0.5, 10.0, 11.0]),
]


@pytest.mark.parametrize(("rule", "expected"), CASES)
def test_rule_bounds(rows, rule, expected):
    df = rows("v double", *[(v,) for v in (-1.0, 0.0, 0.5, 10.0, 11.0, None)])
    kept = [r[0] for r in g.keep_valid(df, [rule]).collect()]
    assert kept == expected
    rejected = {r["metric"]: r["rows"] for r in g.reject_counts(df, [rule]).collect()}
    assert rejected == {rule.label: 6 - len(expected)}


def test_rule_labels():
    assert Rule("x", low=0, low_open=True, high=5).label == "x > 0 <= 5 not null"
    assert Rule("x", non_blank=True, nullable=True).label == "x not blank or null"


def test_blank_rows(rows):
    df = rows("a string, b string", ("x", "y"), (" ", "y"), ("x", None), ("", ""))
    assert tuples(g.drop_blank_rows(df, ["a", "b"])) == [("x", "y")]


def test_metric_counts(rows):
    df = rows("v int", (1,), (2,), (None,))
    counts = g.metric_counts(df, {"big": F.col("v") > 1, "none": F.col("v").isNull()})
    assert tuples(counts) == [("big", 1), ("none", 1)]
    empty = g.metric_counts(df.filter("false"), {"big": F.col("v") > 1})
    assert tuples(empty) == [("big", 0)]


def test_require(rows):
    df = rows("a int", (1,), (2,), (3,))
    assert g.require(df, ["a"], 3)
    assert not g.require(df, ["a"], 4)
    assert not g.require(df, ["a", "b"], 1)


def test_filters_on_stored_columns_reach_the_scan(rows, tmp_path):
    path = str(tmp_path / "t")
    rows("a int, b int, c int", (1, 2, 3)).write.parquet(path)
    stored = rows("a int", (1,)).sparkSession.read.parquet(path)
    kept = g.keep_valid(stored, [Rule("a", low=0, high=5)]).select("a")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(a,0)" in plan.replace(" ", "")
    assert "ReadSchema: struct<a:int>" in plan


def test_unpack_short_lines(rows):
    df = rows("`a;b` string", ("1;2;3",), ("1",), (None,))
    out = g.unpack_delimited(df, "a;b", ";", {"x": 0, "y": 2})
    assert tuples(out) == sorted([("1", "3"), ("1", None), (None, None)], key=repr)


def test_unpack_escapes_the_separator(rows):
    df = rows("v string", ("a|b",))
    assert tuples(g.unpack_delimited(df, "v", "|", {"x": 1})) == [("b",)]


PATTERNS = {
    "item": r"^([^,]+)",
    "day": r",([0-9/]+),",
    "price": r',"([0-9,]+)"',
}


def test_repair_rows(rows):
    df = rows(
        "item string, day string, price string",
        ("Rice", "02/01/2018", "12,000"),
        ('Rice,03/01/2018,"12,500"', None, None),
        ("Salt, fine", "04/01/2018", "1"),  # a comma, but not packed
        ("Sugar", None, "5"),  # neither packed nor dated
        (',03/01/2018,"1"', None, None),  # packed without an item
        ("Tea,soon", None, None),  # packed, fields unreadable
        (None, None, None),
    )
    assert tuples(g.repair_rows(df, "item", "day", PATTERNS)) == [
        ("Rice", "02/01/2018", "12,000"),
        ("Rice", "03/01/2018", "12,500"),
        ("Salt, fine", "04/01/2018", "1"),
        ("Tea", "", ""),
    ]
