from datetime import date

import pytest
from conftest import tuples
from pyspark.sql import functions as F
from pyspark.sql import types as T

import granary as g
from granary.functions import (
    date_from,
    label_by_threshold,
    literal,
    named,
    parse_integer,
    parse_number,
    score_by_threshold,
    year_from,
)

MARKERS = ("#N/A", "8888", "9999", "-", "")


def evaluate(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


def test_null_markers_by_type(rows):
    df = rows(
        "s string, i int, d double, b boolean",
        ("8888", 8888, 8888.0, True),
        ("8888.0", 1, 1.5, None),
        ("", None, None, False),
        ("-", 9999, 9999.0, True),
    )
    assert tuples(g.null_markers(df, MARKERS)) == sorted(
        [
            (None, None, None, True),
            ("8888.0", 1, 1.5, None),
            ("", None, None, False),
            (None, None, None, True),
        ],
        key=repr,
    )


def test_null_markers_per_column(rows):
    df = rows("a string, b string", ("-", "-"), ("x", "8888"))
    assert tuples(g.null_markers(df, MARKERS, ["b"])) == [("-", None), ("x", None)]
    assert tuples(g.null_markers(df, MARKERS, {"a": ["x"]})) == [("-", "-"), (None, "8888")]


def test_null_sentinels(rows):
    df = rows("rain double", (8888.0,), (8888.5,), (None,))
    assert tuples(g.null_sentinels(df, {"rain": [8888]})) == [(8888.5,), (None,), (None,)]


@pytest.mark.parametrize(
    ("text", "cleaned", "name", "key"),
    [
        (" Kab.  Way\tKanan ", " Kab Way Kanan ", "Kab Way Kanan", " kab  way\tkanan "),
        ("a - b", "a b", "a b", "a  b"),
        ("Città X", "CittX", "CittX", "cittx"),
        ("a\x0bb\r\nc", "a b c", "a b c", "a\x0bb\r\nc"),
        ("***", "", "", ""),
        (None, None, None, None),
    ],
)
def test_text(spark, text, cleaned, name, key):
    df = spark.createDataFrame([(text,)], "v string")
    assert g.clean_text(df, "v").first()[0] == cleaned
    assert g.standardize_name(df, "v").first()[0] == name
    assert g.normalize_key(df, "v").first()[0] == key


def test_cleaning_text_twice_changes_nothing(rows):
    df = rows("v string", (" a -- b ",), ("x\n\n y!",))
    once = g.clean_text(df, "v")
    assert tuples(g.clean_text(once, "v")) == tuples(once)


def test_standardize_name_without_the_column(rows):
    df = rows("v string", ("a!",))
    assert g.standardize_name(df, "absent") is df


def test_standardize_name_aliases(rows):
    df = rows("v string", ("Kota Metro",), ("Metro",), (None,))
    named_one = g.standardize_name(df, "v", {"Kota Metro": "Metro"})
    assert tuples(named_one) == [("Metro",), ("Metro",), (None,)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('"12,000"', 12000.0),
        (' " 1,234,567.5 "', 1234567.5),
        ("-", None),
        ("", None),
        ("  ", None),
        ("abc", None),
        (None, None),
    ],
)
def test_parse_thousands(spark, text, expected):
    assert evaluate(spark, text, lambda c: parse_number(c, thousands=",")) == expected


@pytest.mark.parametrize(
    ("text", "expected"), [("125,89", 125.89), ("1.234,5", None), ("7", 7.0), ("x", None)]
)
def test_parse_decimal_comma(spark, text, expected):
    assert evaluate(spark, text, lambda c: parse_number(c, decimal=",", nulls=())) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("2018", 2018), (" 2018 ", 2018), ("2018.0", 2018), ("2018.9", 2018), ("-3.", -3),
     ("n.a.", None), ("99999999999", None), ("1.2.3", None), (None, None)],
)
def test_parse_integer(spark, text, expected):
    assert evaluate(spark, text, parse_integer) == expected


@pytest.mark.parametrize(
    ("text", "fmt", "allow_time", "expected"),
    [
        ("02/01/2018", "dd/MM/yyyy", False, date(2018, 1, 2)),
        (" 02/01/2018 ", "dd/MM/yyyy", False, date(2018, 1, 2)),
        ("02/01/2018 10:00", "dd/MM/yyyy", False, None),
        ("02/01/2018 10:00", "dd/MM/yyyy", True, date(2018, 1, 2)),
        ("99/99/2018", "dd/MM/yyyy", False, None),
        ("31-02-2020", "dd-MM-yyyy", False, None),
        ("29-02-2020", "dd-MM-yyyy", False, date(2020, 2, 29)),
        ("2020-02-29", "dd-MM-yyyy", False, None),
        ("1/2/2018", "dd/MM/yyyy", False, None),
        ("2018.12.31", "yyyy.MM.dd", False, date(2018, 12, 31)),
        ("", "dd/MM/yyyy", False, None),
        ("a\nb", "dd/MM/yyyy", False, None),
        (None, "dd/MM/yyyy", False, None),
    ],
)
def test_dates(spark, text, fmt, allow_time, expected):
    assert evaluate(spark, text, lambda c: date_from(c, fmt, allow_time)) == expected
    year = evaluate(spark, text, lambda c: year_from(c, fmt, allow_time))
    assert year == (expected.year if expected else None)


def test_unknown_date_format():
    with pytest.raises(ValueError, match="format"):
        date_from(None, "d MMM yyyy")


def test_cast_columns(rows):
    df = rows("a string, b string, c double", ("1.0", "x", 1.0), ("7", "2.5", 3e9))
    cast = g.cast_columns(df, {"a": "int", "b": "double", "c": "int"})
    assert cast.dtypes == [("a", "int"), ("b", "double"), ("c", "int")]
    assert tuples(cast) == [(1, None, 1), (7, 2.5, None)]


def test_conform(rows):
    schema = T.StructType(
        [
            T.StructField("region", T.StringType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("copy", T.DoubleType()),
            T.StructField("gap", T.DoubleType()),
        ]
    )
    df = rows("n string, price double, extra int", ("5", 2.5, 1))
    out = g.conform(df, schema, {"region": "R", "copy": F.col("price")})
    assert out.schema.simpleString() == schema.simpleString()
    assert tuples(out) == [("R", 5, 2.5, None)]


def test_add_ratio(rows):
    df = rows("a double, b int", (1.0, 3), (1.0, 0), (1.0, -2), (None, 1))
    plain = g.add_ratio(df, "r", "a", "b", digits=4)
    assert [r["r"] for r in plain.collect()] == [0.3333, None, -0.5, None]
    guarded = g.add_ratio(df, "r", "a", "b", guard=True)
    assert [r["r"] for r in guarded.collect()] == [1 / 3, None, None, None]
    fallback = g.add_ratio(df, "r", "b", "absent", without_denominator="numerator")
    assert [r["r"] for r in fallback.collect()] == [3.0, 0.0, -2.0, 1.0]
    nulls = g.add_ratio(df, "r", "b", "absent", without_denominator="null")
    assert {r["r"] for r in nulls.collect()} == {None}
    with pytest.raises(ValueError, match="absent"):
        g.add_ratio(df, "r", "a", "absent")


def test_handle_missing(rows):
    df = rows("a int, b string", (1, "x"), (None, "y"), (2, None))
    assert tuples(g.handle_missing(df)) == [(1, "x")]
    assert tuples(g.handle_missing(df, "fill", {"a": 0, "b": "-"})) == [(0, "y"), (1, "x"), (2, "-")]
    for bad in ({"strategy": "guess"}, {"strategy": "fill"}):
        assert g.handle_missing(df, **bad) is df


def test_dedupe(rows):
    df = rows("k int, v string, w double", *[(1, "b", 1.0)] * 50, (1, "a", 2.0), (None, "c", None),
              (None, "c", None))
    assert tuples(g.dedupe(df)) == [(1, "a", 2.0), (1, "b", 1.0), (None, "c", None)]
    kept = g.dedupe(df, ["k"])
    assert kept.columns == df.columns
    assert tuples(kept) == [(1, "a", 2.0), (None, "c", None)]
    assert tuples(g.dedupe(df.select("k"), ["k"])) == [(1,), (None,)]


def test_evaluate_once_keeps_filters_above(rows, spark):
    df = rows("v string", ("1",), ("x",))
    parsed = g.evaluate_once(df.select(F.col("v").try_cast("int").alias("n")))
    assert tuples(parsed.filter("n > 0")) == [(1,)]
    plan = parsed.filter("n > 0 AND n < 9")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as int") == 1


def test_odd_names(rows):
    df = rows("`a.b` string, `x;y` string, `q``r` string", ("-", "1", "z!"))
    out = g.clean_text(g.null_markers(df, MARKERS), "q`r")
    assert tuples(out) == [(None, "1", "z")]
    assert df.select(named("a.b")).first()[0] == "-"


@pytest.mark.parametrize("value", ["it's", "back\\slash", "", 1, -2.5, 1e300, None])
def test_literal(spark, value):
    assert spark.sql(f"SELECT {literal(value)}").first()[0] == value


def test_bands_at_their_limits(rows):
    df = rows("v double", (50000.0,), (50000.01,), (20000.0,), (None,))
    score = score_by_threshold(F.col("v"), ((50000, 80), (20000, 60)), 40)
    scored = df.withColumn("score", score)
    label = label_by_threshold(F.col("score"), ((70, "Tahan"), (50, "Sedang")), "Rentan")
    assert [tuple(r) for r in scored.withColumn("label", label).collect()] == [
        (50000.0, 60, "Sedang"),
        (50000.01, 80, "Tahan"),
        (20000.0, 40, "Rentan"),
        (None, 40, "Rentan"),
    ]
