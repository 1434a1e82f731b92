import pytest
from conftest import tuples

import granary as g
from granary import Agg, Enrichment
from granary.plans import presets

KEYS = ["region", "year"]


@pytest.fixture
def base(rows):
    return rows(
        "region string, year int, total double", ("a", 1, 10.0), ("b", 1, 20.0), (None, 1, 30.0)
    )


def test_summarize(rows):
    df = rows("k int, v double, s string", (1, 1.0, "x"), (1, 3.0, None), (2, None, "y"))
    aggs = [
        Agg("sum", "v", "total"),
        Agg("avg", "v", "mean"),
        Agg("count", "s", "n"),
        Agg("count_distinct", "s", "kinds"),
        Agg("min", "v", "low"),
        Agg("max", "v", "high"),
    ]
    assert tuples(g.summarize(df, ["k"], aggs)) == [
        (1, 4.0, 2.0, 1, 1, 1.0, 3.0),
        (2, None, None, 1, 1, None, None),
    ]


def test_summarize_through_a_dimension(rows):
    facts = rows(
        "link int, year int, v double, s string",
        *[(1, 1, 2.0, "x")] * 30,  # a heavy link
        (2, 1, 5.0, None),
        (3, 2, None, "y"),
        (9, 1, 7.0, "z"),  # not in the dimension
    )
    home = rows("link int, region string", (1, "a"), (2, "a"), (3, "b"))
    aggs = [
        Agg("sum", "v", "total"),
        Agg("avg", "v", "mean"),
        Agg("count", "s", "n"),
        Agg("min", "v", "low"),
        Agg("max", "v", "high"),
    ]
    direct = g.summarize(facts.join(home, "link"), KEYS, aggs)
    through = g.summarize_through(facts, home, "link", KEYS, aggs)
    assert through.columns == direct.columns
    assert tuples(through) == tuples(direct)
    with pytest.raises(ValueError, match="count_distinct"):
        g.summarize_through(facts, home, "link", KEYS, [Agg("count_distinct", "s", "k")])


def test_summarize_normalized_merges_spellings(rows):
    df = rows("region string, year int, v double", ("Kab. A", 1, 1.0), ("KAB A", 1, 3.0),
              ("kab a", 1, 5.0), (None, 1, 7.0), ("kab a", 2, None))
    aggs = [Agg("sum", "v", "total"), Agg("avg", "v", "mean"), Agg("count", "v", "n")]
    direct = g.summarize(g.normalize_key(df, "region"), KEYS, aggs)
    assert tuples(g.summarize_normalized(df, "region", KEYS, aggs)) == tuples(direct)


def test_enrich_keeps_order_and_skips_absent_sources(base, rows):
    price = rows("region string, year int, p double", ("a", 1, 1.0), ("a", 1, 3.0))
    people = rows("region string, year int, n int", ("a", 1, 5), ("a", 1, 6), ("c", 1, 7))
    rain = rows("year int, mm double", (1, 2.0))
    out = g.enrich(
        base,
        [
            Enrichment("people", people, KEYS),
            Enrichment("price", price, KEYS, (Agg("avg", "p", "price"),)),
            Enrichment("none", None, KEYS, (Agg("avg", "x", "x"),)),
            Enrichment("rain", rain, ["year"], unique=True),
        ],
    )
    assert out.columns == ["region", "year", "total", "n", "price", "mm"]
    assert tuples(out) == sorted(
        [
            ("a", 1, 10.0, 5, 2.0, 2.0),
            ("a", 1, 10.0, 6, 2.0, 2.0),
            ("b", 1, 20.0, None, None, 2.0),
            (None, 1, 30.0, None, None, 2.0),
        ],
        key=repr,
    )


def test_repeating_source_equals_a_left_join(spark):
    base = spark.range(50).selectExpr("id % 7 AS k", "id AS v")
    source = spark.range(400).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 5 END AS k", "id AS w")
    out = g.enrich(base, [Enrichment("s", source, ["k"])])
    assert tuples(out) == tuples(base.join(source, "k", "left").select("k", "v", "w"))


def test_a_heavy_key_is_split(spark, tmp_path):
    base = spark.range(2000).selectExpr("id AS k", "id AS v")
    source = spark.range(0, 300_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 2000 END AS k", "id AS w", "uuid() AS pad"
    )
    source.write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        out = g.enrich(base, [Enrichment("s", source, ["k"])])
        rows = out.groupBy().agg({"w": "count", "pad": "max"})
        assert rows.collect()[0]["count(w)"] == 300_000
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def heavy_rows(spark, path):
    """A third of the rows under one key, some under none, and some twice."""
    spark.range(0, 60_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 11 = 0 THEN NULL ELSE id % 1900 END AS k", "id % 50000 AS w"
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_a_heavy_source_is_read_once_and_split(spark, tmp_path):
    source = heavy_rows(spark, str(tmp_path / "source"))
    base = spark.range(2000).selectExpr("IF(id = 5, NULL, id) AS k", "id AS v")
    out = g.join_heavy(base, source, ["k"], spread=16)
    totals = ["count(*)", "count(w)", "sum(v)", "sum(hash(k, v, w))"]
    expected = base.join(source, "k", "left").selectExpr(*totals).collect()
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    try:
        for threshold in ("-1", before):
            spark.conf.set(setting, threshold)
            total = out.selectExpr(*totals)
            assert total.collect() == expected
            plan = total._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert plan.count("FileScan") == 1
    finally:
        spark.conf.set(setting, before)
    salted = source.filter("k = 7").selectExpr("pmod(xxhash64(k, w), 16) AS salt").groupBy("salt").count()
    assert salted.count() == 16 and salted.agg({"count": "max"}).first()[0] < 20_000 / 8


def test_heavy_join_of_empty_sides(spark, rows):
    base = rows("k string, j int, v int", ("a", 1, 1), (None, 1, 2), ("b", None, 3))
    source = rows("j int, k string, w int", (1, "a", 4), (1, "a", 4), (1, None, 5), (None, "b", 6))
    joined = tuples(base.join(source, ["k", "j"], "left").select("k", "j", "v", "w"))
    assert tuples(g.join_heavy(base, source, ["k", "j"])) == joined
    nothing = tuples(base.selectExpr("*", "CAST(NULL AS INT) AS w"))
    assert tuples(g.join_heavy(base, source.filter("w > 9"), ["k", "j"])) == nothing
    assert g.join_heavy(base.filter("v > 9"), source, ["k", "j"]).count() == 0


def test_two_repeating_sources(base, rows):
    one = rows("region string, year int, x int", ("a", 1, 1), ("a", 1, 2))
    two = rows("region string, year int, y int", ("a", 1, 3), ("a", 1, 4), ("b", 1, 5))
    out = g.enrich(base, [Enrichment("one", one, KEYS), Enrichment("two", two, KEYS)])
    expected = base.join(one, KEYS, "left").join(two, KEYS, "left")
    assert tuples(out) == tuples(expected)


def test_repeated_keys(rows):
    df = rows("k int", (1,), (1,), (2,), (None,), (None,))
    assert tuples(g.repeated_keys(df, ["k"])) == [(1, 2), (None, 2)]


def test_validate_mart(base):
    checked = g.validate_mart(base, ["region", "total"], "region").first()
    assert checked.asDict() == {"row_count": 3, "region_count": 3, "valid": True}
    empty = g.validate_mart(base.filter("false"), ["region"], "region").first()
    assert empty.asDict() == {"row_count": 0, "region_count": 0, "valid": False}
    with pytest.raises(ValueError, match="absent"):
        g.validate_mart(base, ["absent"], "region")


PRODUCTION = (
    "kabupaten_kota string, komoditas string, produksi double, luas_panen double, "
    "produktivitas double, tahun int"
)


@pytest.fixture
def production(rows):
    return rows(
        PRODUCTION,
        ("Kab. A", "rice", 30000.0, 10.0, 1.0, 2020),
        ("Kab A", "rice", 20000.01, 10.0, 3.0, 2020),
        ("B", "corn", 50000.0, 1.0, 1.0, 2020),
        ("C", None, 20000.0, 1.0, 1.0, 2020),
        ("D", "corn", None, 1.0, None, 2021),
    )


def test_indicators(production):
    mart = presets.mart_indicators(production).filter("kabupaten_kota <> 'Kab. A'")
    found = {
        r["kabupaten_kota"]: (r["produksi_per_kapita"], r["skor_ketersediaan"], r["kategori_ketahanan"])
        for r in mart.collect()
    }
    assert found == {
        "Kab A": (20.00001, 60, "Sedang"),
        "B": (50.0, 60, "Sedang"),
        "C": (20.0, 40, "Rentan"),
        "D": (None, 40, "Rentan"),
    }


def test_distinct_items(production):
    merged = g.normalize_key(production, "kabupaten_kota")
    plain = {r[0]: r["jenis_komoditas"] for r in presets.production_summary(merged).collect()}
    distinct = {r[0]: r["jenis_komoditas"] for r in presets.production_summary(merged, True).collect()}
    assert (plain["kab a"], distinct["kab a"]) == (2, 1)
    assert (plain["c"], distinct["c"]) == (0, 0)


def test_enriched_with_production_alone(production):
    mart = presets.mart_enriched(production)
    assert "jumlah_penduduk" not in mart.columns
    row = mart.filter("kabupaten_kota = 'kab a'").first()
    assert row["produksi_per_kapita"] == row["total_produksi"] == pytest.approx(50000.01)
    assert row["kategori_ketahanan"] == "Tahan"


@pytest.fixture
def sources(rows):
    return {
        "harga_pangan": rows(
            "kabupaten_kota string, komoditas string, harga_produsen double, "
            "harga_konsumen double, tahun int, tanggal string",
            ("Lampung", "rice", 1.0, 2.0, 2020, "x"),
        ),
        "cuaca": rows(
            "kabupaten_kota string, curah_hujan double, suhu_rata_rata double, "
            "kelembaban double, tahun int, tanggal string",
            ("Lampung", 4.0, 27.0, None, 2020, "x"),
            ("Lampung", None, 28.0, None, 2020, "y"),
        ),
        "sosial_ekonomi": rows(
            "kabupaten_kota string, jumlah_penduduk int, tingkat_kemiskinan double, "
            "ipkm double, tahun int",
            ("KAB A", 100, 1.0, 2.0, 2020),
            ("Kab A", 200, 1.0, 2.0, 2020),
            ("B", 0, 1.0, 2.0, 2020),
        ),
        "konsumsi_pangan": rows(
            "kabupaten_kota string, komoditas string, konsumsi_per_kapita double, tahun int",
            ("b", "rice", 1.5, 2020),
            ("B.", "corn", 2.5, 2020),
        ),
        "ikp": rows(
            "kabupaten_kota string, skor_ikp double, kategori_ikp int, tahun int",
            ("b", 70.0, 5, 2020),
            ("b", 80.0, 6, 2020),
        ),
    }


def test_enriched_with_everything(production, sources):
    mart = presets.mart_enriched(production, sources)
    assert mart.columns == [
        "kabupaten_kota",
        "tahun",
        "total_produksi",
        "avg_produktivitas",
        "total_luas_panen",
        "jenis_komoditas",
        "avg_harga_produsen",
        "avg_harga_konsumen",
        "avg_curah_hujan",
        "avg_suhu",
        "jumlah_penduduk",
        "tingkat_kemiskinan",
        "ipkm",
        "total_konsumsi_per_kapita",
        "skor_ikp",
        "kategori_ikp",
        "produksi_per_kapita",
        "skor_ketersediaan",
        "kategori_ketahanan",
    ]
    found = {(r["kabupaten_kota"], r["jumlah_penduduk"]): r for r in mart.collect()}
    assert set(found) == {("kab a", 100), ("kab a", 200), ("b", 0), ("c", None), ("d", None)}
    assert found["kab a", 100]["produksi_per_kapita"] == 500.0001
    assert found["b", 0]["produksi_per_kapita"] is None
    assert found["b", 0]["total_konsumsi_per_kapita"] == 4.0
    assert (found["b", 0]["skor_ikp"], found["b", 0]["kategori_ikp"]) == (75.0, 5.5)
    assert found["b", 0]["avg_curah_hujan"] is None  # province rows match no district


def test_province_wide_sources_join_by_year(production, sources):
    mart = presets.mart_enriched(production, sources, province_wide=("harga_pangan", "cuaca"))
    row = mart.filter("kabupaten_kota = 'c'").first()
    assert (row["avg_harga_konsumen"], row["avg_curah_hujan"], row["avg_suhu"]) == (2.0, 4.0, 27.5)


def test_unique_social_rows_give_the_same_mart(production, sources):
    sources["sosial_ekonomi"] = sources["sosial_ekonomi"].filter("jumlah_penduduk <> 200")
    plain = presets.mart_enriched(production, sources)
    assert tuples(presets.mart_enriched(production, sources, unique_social=True)) == tuples(plain)
