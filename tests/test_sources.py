import csv
import os
import random

import pytest
from conftest import tuples
from pyspark.sql import types as T

import granary as g
from granary import SourceSpec
from granary.sources.delimited import kind_measures


def write(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def test_bom_and_windows_line_ends(spark, tmp_path):
    path = write(tmp_path, "﻿a;b\r\n1;x\r\n2;\r\n")
    df = g.read_delimited(spark, path, ";")
    assert df.columns == ["a", "b"]
    assert tuples(df) == [("1", "x"), ("2", None)]


def test_lines_quoted_as_a_whole(spark, tmp_path):
    df = g.read_delimited(spark, write(tmp_path, '"a;b"\n"1;2"\n'), ";")
    assert df.columns == ["a;b"]
    assert tuples(df) == [("1;2",)]


def test_records_over_several_lines(spark, tmp_path):
    plain = write(tmp_path, 'a,b\n"say ""hi""",2\n', "plain.csv")
    broken = write(tmp_path, 'a,b\n"one\ntwo",2\n', "broken.csv")
    assert not g.has_multi_line_records(spark, plain)
    assert g.has_multi_line_records(spark, broken)
    assert tuples(g.read_delimited(spark, plain)) == [('say "hi"', "2")]
    assert tuples(g.read_delimited(spark, broken, multi_line=True)) == [("one\ntwo", "2")]


CELLS = ["", "plain", "two\nlines", 'a "word"', "win\r\ndows", ",", "\n", '"\n"', "end\r", "long " * 400, "é\n\nß"]


@pytest.fixture(params=[1 << 27, 4096, 97])
def split_bytes(spark, request):
    """Reads files in splits of so many bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": 1}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


def test_records_put_together_from_splits(spark, tmp_path, split_bytes):
    rnd = random.Random(split_bytes)
    expected = []
    for file in range(2):
        rows = [(f"{file}-{k}", rnd.choice(CELLS), rnd.choice(CELLS)) for k in range(300)]
        with open(tmp_path / f"{file}.csv", "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator="\r\n" if file else "\n", quoting=csv.QUOTE_MINIMAL)
            writer.writerows([("id", "a", "b\nc"), *rows])
            out.write("\n")
        expected += [(a, b or None, c or None) for a, b, c in rows]
    df = g.read_records(spark, str(tmp_path))
    assert df.columns == ["id", "a", "b\nc"]
    assert tuples(df) == sorted(expected, key=repr)
    if split_bytes < 1 << 20:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 1


def test_put_together_records_keep_their_shape(spark, tmp_path, split_bytes):
    path = write(tmp_path, '\ufeffa;b\n1;"x\ny"\n\n2;"p\nq";z\n3\n4;"s""\n\n""t"\n')
    df = g.read_records(spark, path, ";", corrupt_column="_bad").cache()
    good, bad = g.split_corrupt(df, "_bad")
    assert tuples(good) == [("1", "x\ny"), ("4", 's"\n\n"t')]
    assert tuples(bad.select("_bad")) == [('2;"p\nq";z',), ("3",)]
    spec = SourceSpec("s", ";", renames={"b": "c"}, split=True)
    assert g.read_source(spark, path, spec).columns[1] == "c"


def test_a_quote_left_open_does_not_gather_the_rest_of_the_file(spark, tmp_path, split_bytes):
    path = write(tmp_path, "a,b\n1,x\n" + '2,"open\n' + "".join(f"{k},y\n" for k in range(3, 200)))
    df = g.read_records(spark, path, corrupt_column="_bad", longest=500).cache()
    good, bad = g.split_corrupt(df, "_bad")
    assert bad.count() == 0 and tuples(good) == sorted([("1", "x"), ("2", "open"), *((str(k), "y") for k in range(3, 200))], key=repr)


def test_records_are_put_together_without_a_shuffle_of_lines(spark, tmp_path, capsys):
    path = write(tmp_path, "a,b\n" + "".join(f'{k},"x\ny"\n' for k in range(50)))
    g.read_records(spark, path, schema=T.StructType([T.StructField(name, T.StringType()) for name in "ab"])).explain("formatted")
    nodes = capsys.readouterr().out.split("\n\n")
    shuffled = [node for node in nodes if ") Exchange" in node]
    # Only pieces of records that splits cut, which bear the split of their origin, hold text.
    assert shuffled and all("origin#" in node for node in shuffled if "value#" in node)


def test_first_records_cut_by_splits(spark, tmp_path, split_bytes):
    path = write(tmp_path, "\n \n\ufeff" + '"a\n' + "w\n" * 60 + '",b\n1,x\n2,"' + "y\n" * 60 + '"\n')
    schema = T.StructType([T.StructField(name, T.StringType()) for name in "ab"])
    rest = [("1", "x"), ("2", "y\n" * 60)]
    assert tuples(g.read_records(spark, path, schema=schema)) == rest
    assert tuples(g.read_records(spark, path, schema=schema, header=False)) == sorted([("a\n" + "w\n" * 60, "b"), *rest], key=repr)
    # Too long to be put together: no line of the header is a record, the others are their lines.
    lines = g.read_records(spark, path, schema=schema, longest=50).collect()
    assert len(lines) == 62 and sum(row["a"] == "y" for row in lines) == 59


def test_records_of_nothing(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    assert g.read_records(spark, write(tmp_path, "a,b\n"), schema=schema).collect() == []
    assert tuples(g.read_records(spark, write(tmp_path, '\ufeff"x\ny",2'), schema=schema, header=False)) == [("x\ny", 2)]
    with pytest.raises(ValueError, match="doubled"):
        g.read_records(spark, str(tmp_path), options={"escape": "\\"})


def test_schema_wins_over_inference(spark, tmp_path):
    path = write(tmp_path, "a,b\n1,2.5\n")
    inferred = g.read_delimited(spark, path, infer_schema=True)
    assert inferred.dtypes == [("a", "int"), ("b", "double")]
    schema = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.StringType())])
    assert g.read_delimited(spark, path, schema=schema, infer_schema=True).dtypes == [
        ("x", "bigint"),
        ("y", "string"),
    ]


def test_spec_renames_and_options(spark, tmp_path):
    spec = SourceSpec("s", ";", renames={"b c": "b", "none": "x"}, options={"nullValue": "-"})
    df = g.read_source(spark, write(tmp_path, "a;b c\n-;2\n"), spec)
    assert df.columns == ["a", "b"]
    assert tuples(df) == [(None, "2")]
    plain = g.read_source(spark, write(tmp_path, "a;b\n", "plain.csv"))
    assert plain.columns == ["a;b"]


@pytest.fixture
def corrupt(spark, tmp_path):
    path = write(tmp_path, "a,b\n1,x\n2,y,z\n3\n")
    return g.read_delimited(spark, path, corrupt_column="_bad")


def test_corrupt_rows(corrupt):
    good, bad = g.split_corrupt(corrupt, "_bad")
    assert good.columns == ["a", "b"]
    assert tuples(good) == [("1", "x")]
    assert tuples(bad.select("_bad")) == [("2,y,z",), ("3",)]


def test_corrupt_rows_stay_corrupt_in_any_projection(corrupt):
    good, bad = g.split_corrupt(corrupt, "_bad")
    assert (good.count(), bad.count()) == (1, 2)
    assert tuples(good.select("a")) == [("1",)]


@pytest.fixture
def years(rows):
    return rows("v int, tahun int", (1, 2000), (2, 2000), (3, 2001))


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_partitioned_round_trip(spark, years, tmp_path, fmt):
    path = str(tmp_path / "t")
    g.write_table(years, path, "tahun", fmt=fmt)
    assert sorted(p.name for p in (tmp_path / "t").glob("tahun=*")) == ["tahun=2000", "tahun=2001"]
    assert all(len(list(d.glob("part-*"))) == 1 for d in (tmp_path / "t").glob("tahun=*"))
    back = spark.read.schema(years.schema).format(fmt).load(path)
    assert tuples(back) == tuples(years)


def test_overwrite_and_append(spark, years, tmp_path):
    path = str(tmp_path / "t")
    g.write_table(years, path)
    g.write_table(years.limit(1), path, mode="append", rebalance=False)
    assert spark.read.parquet(path).count() == 4
    g.write_table(years.limit(1), path)
    assert spark.read.parquet(path).count() == 1


def test_registered_table_follows_its_files(spark, years, tmp_path):
    path = str(tmp_path / "it's here")
    g.write_table(years, path, "tahun")
    for _ in range(2):  # registering again is harmless
        g.register_table(spark, "shelf.years", years.schema, path, ["tahun"])
    table = spark.table("shelf.years")
    assert table.dtypes == [("v", "int"), ("tahun", "int")]
    assert tuples(table.filter("tahun = 2000")) == [(1, 2000), (2, 2000)]
    changed = years.selectExpr("v + 1L AS w", "tahun").filter("tahun = 2001")
    g.write_table(changed, path, "tahun")
    g.register_table(spark, "shelf.years", changed.schema, path, ["tahun"])
    assert tuples(spark.table("shelf.years")) == [(4, 2001)]
    spark.sql("DROP DATABASE shelf CASCADE")


def test_managed_tables_are_not_dropped(spark, years, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    years.write.saveAsTable("kept.years")
    path = str(tmp_path / "elsewhere")
    g.write_table(years, path, "tahun")
    for location in (path, None):
        with pytest.raises(ValueError, match="not replaced"):
            g.register_table(spark, "kept.years", years.schema, location, ["tahun"])
    assert spark.table("kept.years").count() == 3
    g.register_table(spark, "kept.outside", years.schema, path, ["tahun"])
    with pytest.raises(ValueError, match="external"):
        g.register_table(spark, "kept.outside", years.schema)
    assert spark.table("kept.outside").count() == 3
    spark.sql("DROP DATABASE kept CASCADE")


def test_open_quotes_end_with_their_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text('key,name\n1,good\n"2,open\n3,5" pipe\n4,last\n')
    read = g.read_delimited(spark, str(tmp_path), corrupt_column="_bad")
    good, bad = g.split_corrupt(read, "_bad")
    assert tuples(good) == [("1", "good"), ("3", '5" pipe'), ("4", "last")]
    assert [r["_bad"] for r in bad.collect()] == ['"2,open']
    assert read.rdd.getNumPartitions() >= 1 and g.SourceSpec("x").multi_line is False


def test_failed_staging_leaves_nothing(spark, tmp_path):
    broken = spark.sql("SELECT raise_error('no') AS a")
    with pytest.raises(Exception, match="no"):
        g.stage(broken, str(tmp_path / "stages"))
    assert not list((tmp_path / "stages").glob("*"))


def test_relative_locations(spark, years, tmp_path):
    path = os.path.relpath(tmp_path / "t", spark._jvm.System.getProperty("user.dir"))
    g.write_table(years, path, "tahun")
    g.register_table(spark, "nearby.years", years.schema, path, ["tahun"])
    assert tuples(spark.table("nearby.years")) == tuples(years)
    spark.sql("DROP DATABASE nearby CASCADE")


def test_table_counts(spark, years, tmp_path):
    assert g.table_counts(spark, "default").columns == ["table", "rows"]
    for name in ("one", "two"):
        path = str(tmp_path / name)
        g.write_table(years, path, "tahun")
        g.register_table(spark, f"counted.{name}", years.schema, path, ["tahun"])
    assert tuples(g.table_counts(spark, "counted")) == [("one", 3), ("two", 3)]
    spark.sql("DROP DATABASE counted CASCADE")


def test_load_table(spark, years):
    years.createOrReplaceTempView("some_years")
    assert g.load_table(spark, "some_years").count() == 3
    assert g.load_table(spark, "no_such_table", required=False) is None
    with pytest.raises(RuntimeError, match="no_such_table"):
        g.load_table(spark, "no_such_table")


def test_stage_reads_back_what_it_wrote(spark, years, tmp_path):
    frame, path = g.stage(years, str(tmp_path))
    assert path.startswith(str(tmp_path))
    assert frame.schema == years.schema
    assert tuples(frame) == tuples(years)


def test_staging_folder_is_the_one_the_session_names(spark):
    assert g.staging_folder(spark, "other") == spark.conf.get("spark.checkpoint.dir")


def test_run_summary(years):
    summary = g.run_summary(years, years.filter("v > 1")).first()
    assert summary["rows_in"] == 3
    assert summary["rows_out"] == 2
    assert summary["reduction_percent"] == pytest.approx(100 / 3)
    nothing = g.run_summary(years.filter("false"), years.filter("false")).first()
    assert nothing["reduction_percent"] is None


def test_kinds_of_odd_numbers_in_text(spark):
    cells = [" 1e3 ", "+.5", "-Infinity", "nan", "1.5d", "0x1p3", "Kab 5", "N / O", "n.a.", "inferior", "", "-", "\t7"]
    df = spark.createDataFrame([(cell,) for cell in cells], "a string")
    measures = kind_measures(df)
    tested = df.selectExpr(f"{measures['double_0']} AS n", "count(CASE WHEN try_cast(a AS DOUBLE) IS NOT NULL THEN 1 END) AS all").first()
    assert tested["n"] == tested["all"] >= 6
    # What cannot be a number is told by its beginning, before a cast that would fail at a high price.
    assert measures["double_0"].index("RLIKE") < measures["double_0"].index("try_cast")
