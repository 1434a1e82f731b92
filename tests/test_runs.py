"""What passes from run to run: stored rows, streams of files, bucketed summaries."""

import pytest
from conftest import tuples

import granary as g
from granary.plans import presets, streams
from granary.plans.jobs import mart_bucketed
from granary.sources import rowstore

SCHEMA = "a int, b string, c double"


def test_only_new_rows_are_added(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    first = [(1, "x", 1.0), (1, "x", 1.0), (None, "1", None), (2, None, float("nan"))]
    assert g.append_new(rows(SCHEMA, *first), path) == 3
    second = [(1, "x", 1.0), (1, None, None), (None, None, None), (2, None, float("nan")), (None, "1", None)]
    assert g.append_new(rows(SCHEMA, *second), path) == 2
    assert g.append_new(rows(SCHEMA, *first, *second), path) == 0
    assert repr(tuples(g.stored_rows(spark, path))) == repr(tuples(rows(SCHEMA, *first, *second).distinct()))  # NaN


def test_rows_of_equal_hashes_stay_apart(spark, rows, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(rowstore, "_hashed", lambda df: df.withColumns({name: F.lit(7).cast("long") for name in rowstore.HASHES}))
    path = str(tmp_path / "table")
    assert g.append_new(rows(SCHEMA, (1, "x", 1.0)), path) == 1
    assert g.append_new(rows(SCHEMA, (1, "x", 1.0), (2, "x", 1.0), (1, None, 1.0)), path) == 2


def test_filters_let_few_new_rows_through(spark, tmp_path):
    path = str(tmp_path / "table")
    g.append_new(spark.range(20_000), path, expected_rows=20_000)
    batch = rowstore._hashed(spark.range(10_000, 40_000))
    filters = spark.read.parquet(f"{path}/filters")
    assert filters.count() == filters.select("_buckets").first()[0] == 8
    asked = rowstore._ask_filters(batch, filters, 8).filter(rowstore.MAYBE)
    assert asked.filter("id < 20000").count() == 10_000
    assert asked.filter("id >= 20000").count() < 600


def test_a_run_that_ended_before_its_rows_is_repeated(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    g.append_new(rows("a int", (1,)), path)

    def failing(df, place, *args, **options):
        if place.endswith("rows"):
            raise OSError("lost")
        g.write_table(df, place, *args, **options)

    monkeypatch.setattr(rowstore, "write_table", failing)
    with pytest.raises(OSError, match="lost"):
        g.append_new(rows("a int", (1,), (2,)), path)
    monkeypatch.undo()
    assert g.append_new(rows("a int", (1,), (2,)), path) == 1
    assert tuples(g.stored_rows(spark, path)) == [(1,), (2,)]


def test_an_empty_batch_and_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    assert g.append_new(rows(SCHEMA), path, partition_by=["a"]) == 0
    assert g.append_new(rows(SCHEMA, (1, "x", 1.0), (2, "y", None)), path, partition_by=["a"]) == 2
    assert g.append_new(rows(SCHEMA, (2, "y", None), (2, "z", None)), path, partition_by=["a"]) == 1
    assert g.stored_rows(spark, path).count() == 3


def test_streamed_files_equal_a_batch(spark, tmp_path):
    raw, path, state = (tmp_path / name for name in ("raw", "table", "state"))
    raw.mkdir()
    header = "TANGGAL;suhu;curah_hujan\n"
    (raw / "one.csv").write_text(header + "01-02-2018;27;1\n01-02-2018;27;1;234\n02-02-2018;-;8888\n")
    (raw / "two.csv").write_text(header + "01-02-2018;27;1\n03-02-2018;99;1\n04-02-2018;28;2\n")
    assert streams.stream_silver(spark, "cuaca", str(raw), str(path), str(state), files_per_batch=1) == [3, 3]
    assert spark.conf.get(streams.STATE_STORE, "") != streams.ROCKS_DB
    (raw / "three.csv").write_text(header + "04-02-2018;28;2\n05-02-2018;29;3\n")
    assert streams.stream_silver(spark, "cuaca", str(raw), str(path), str(state)) == [2]
    source = presets.SOURCES["cuaca"]
    names = presets.SILVER_SCHEMAS["cuaca"].names
    batch = presets.clean_weather(g.read_source(spark, str(raw), source)).select(*names)
    assert tuples(spark.read.parquet(str(path)).select(*names)) == tuples(batch)
    assert batch.count() >= 2


def social(rows, *found):
    return rows("kabupaten_kota string, jumlah_penduduk int, tingkat_kemiskinan double, ipkm double, tahun int", *found)


def production(rows):
    found = [(f"R{at % 40}", "rice", 4.0, 2.0, 2.0, 2000 + at % 5) for at in range(400)]
    return rows("kabupaten_kota string, komoditas string, produksi double, luas_panen double, produktivitas double, tahun int", *found)


@pytest.mark.parametrize("copies, shuffled", [(2, False), (400, True)])
def test_bucketed_summaries_join_without_a_shuffle(spark, rows, tmp_path, copies, shuffled):
    made = [(f"R{at}", 10 + at, 1.0, 2.0, 2000) for at in range(30)]
    made += [("R1", 1000 + at, 1.0, 2.0, 2000) for at in range(copies)]
    sources = {
        "sosial_ekonomi": social(rows, *made),
        "cuaca": rows("kabupaten_kota string, curah_hujan double, suhu_rata_rata double, tahun int", ("R1", 3.0, 20.0, 2000)),
    }
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        database = f"marts_{copies}"
        mart = mart_bucketed(production(rows), sources, database, str(tmp_path), 4)
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" in plan) == shuffled
        assert tuples(mart) == tuples(presets.mart_enriched(production(rows), sources))
        stored = spark.table(f"{database}.produksi_pangan")
        g.register_table(
            spark, f"{database}.again", stored.schema, str(tmp_path / "produksi_pangan"), bucket_by=presets.KEYS, buckets=4
        )
        joined = spark.table(f"{database}.again").join(stored, presets.KEYS)
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == stored.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_a_managed_table_is_not_replaced_by_buckets(spark, rows, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    rows("a int", (1,)).write.mode("overwrite").saveAsTable("kept.own")
    with pytest.raises(ValueError, match="managed"):
        g.write_bucketed(rows("a int", (2,)), "kept.own", str(tmp_path / "own"), ["a"], 2)
    assert tuples(spark.table("kept.own")) == [(1,)]
    spark.sql("DROP DATABASE kept CASCADE")


def test_state_has_few_partitions_and_stores_changes(spark, tmp_path):
    raw, path, state = (tmp_path / name for name in ("raw", "table", "state"))
    raw.mkdir()
    (raw / "one.csv").write_text("TANGGAL;suhu;curah_hujan\n01-02-2018;27;1\n01-02-2018;27;1\n02-02-2018;28;2\n")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        assert streams.stream_silver(spark, "cuaca", str(raw), str(path), str(state)) == [3]
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
        parts = [part for part in (state / "state" / "0").iterdir() if part.name.isdigit()]
        assert len(parts) == min(50, 3 * spark.sparkContext.defaultParallelism)
        assert list(parts[0].glob("*.changelog"))
        # A later call goes on with the partitions that are there.
        (raw / "two.csv").write_text("TANGGAL;suhu;curah_hujan\n01-02-2018;27;1\n03-02-2018;28;2\n")
        assert streams.stream_silver(spark, "cuaca", str(raw), str(path), str(state), state_partitions=2) == [2]
        assert len([part for part in (state / "state" / "0").iterdir() if part.name.isdigit()]) == len(parts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert spark.read.parquet(str(path)).count() == 3
