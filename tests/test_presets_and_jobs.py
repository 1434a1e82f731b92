"""The six cleaners and both runs on small files in the shapes of the raw data."""

import pytest
from conftest import tuples

import granary as g
from granary.plans import presets
from granary.plans.jobs import arguments, clean_to_table, run, run_gold, run_silver

DISTRICTS = [f"Kab. No-{n}" for n in range(12)]
INDEX_HEADER = (
    "Nomor;Kode Prov;Nama Provinsi;Nama Kabupaten;Kode Kab/Kota;Tipe;Tahun;IKP;"
    "PERINGKAT KAB/KOTA;KELOMPOK IKP"
)


def production_lines():
    yield "kabupaten_kota;komoditas;produksi;luas_panen;produktivitas;tahun"
    for at, name in enumerate(DISTRICTS):
        for year in range(2010, 2020):
            yield f"{name};Padi / Sawah;{1000 + at * 900};{100 + at};9.5;{year}"
    yield f"{DISTRICTS[0]};Padi / Sawah;1000;100;9.5;2010"  # a copy
    yield "X;a;1000000;1;1;2000"
    yield "X;a;1000000.01;1;1;2000"
    yield "X;a;0;1;1;2000"
    yield "X;a;1;0;1;2000"
    yield "X;a;8888;1;1;2000"
    yield "X;a;9999.5;1;1;1999"
    yield "X;a;5;1;1;2030"
    yield "X;a;5;1;1;2031"
    yield "#N/A;a;5;1;1;2000"
    yield "X;;5;1;-;2001"


def price_lines():
    yield "komoditas,tanggal,harga pangan"
    for day in range(1, 29):
        for month in range(1, 6):
            yield f'Beras,{day:02d}/{month:02d}/2018,"12,{day:03d}"'
    yield '"Beras,03/01/2019,""12,500"""'
    yield "Gula,04/01/2018,-"
    yield 'Gula,99/99/2018,"9,000"'
    yield "Gula,05/01/2018,12,000"  # a field too many
    yield ",,"


def weather_lines():
    yield "TANGGAL;suhu;curah_hujan"
    for day in range(1, 29):
        yield f"{day:02d}-01-2020;27.5;{day}"
        yield f"{day:02d}-02-2020;-;-"
        yield f"{day:02d}-03-2020;26;8888"
    yield "31-02-2020;26;1"
    yield "30-01-2020;61;1"
    yield "29-01-2020;26;-1"


def social_lines():
    yield "Kabupaten/Kota;Tahun;Jumlah_Penduduk;Persentase_miskin;pengeluaran_per_kapita"
    for at, name in enumerate(DISTRICTS):
        for year in range(2010, 2016):
            yield f"{name};{year};{200_000 + at};13.5;900000.5"
    for name in DISTRICTS * 3:
        yield f"{name};;;;"
    yield "X;2010;0;1;1"
    yield "X;2010;1;100.5;1"


def consumption_lines():
    yield "Tahun;Kabupaten_Kota;Komoditas;Konsumsi Pangan"
    for name in DISTRICTS:
        for year in range(2010, 2016):
            yield f"{year};{name};Beras;125,89"
    yield "2010;**;Beras;1,5"
    yield "2010;X;Beras;1.234,5"
    yield "2010;X;Beras;-1"
    yield "2010;X;Beras;0"


def index_lines():
    yield f'"{INDEX_HEADER}"'
    for at, name in enumerate(DISTRICTS):
        for year in range(2012, 2018):
            yield f'"{at};18;Prov;{name};1804;Kabupaten;{year};{60 + at}.43;#N/A;{5 + at % 2}"'
    yield '"1;18;Prov;X;1804;Kabupaten;2018;100.5;1;5"'
    yield '"1;18;Prov;X;1804"'


FILES = {
    "produksi_pangan": (production_lines, "\n", ""),
    "harga_pangan": (price_lines, "\n", ""),
    "cuaca": (weather_lines, "\r\n", "﻿"),
    "sosial_ekonomi": (social_lines, "\r\n", "﻿"),
    "konsumsi_pangan": (consumption_lines, "\n", ""),
    "ikp": (index_lines, "\r\n", "﻿"),
}


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, (lines, end, start) in FILES.items():
        text = start + end.join(lines()) + end
        (folder / f"{name}.csv").write_bytes(text.encode())
    return str(folder)


@pytest.fixture(scope="module")
def cleaned(spark, raw_dir):
    def build(name):
        raw = g.read_source(spark, f"{raw_dir}/{name}.csv", presets.SOURCES[name])
        return presets.DATASETS[name].clean(raw)

    return build


@pytest.mark.parametrize("name", list(FILES))
def test_schema_and_idempotence(cleaned, name):
    df = cleaned(name)
    assert df.schema.simpleString() == presets.SILVER_SCHEMAS[name].simpleString()
    assert df.count() == df.dropDuplicates().count()


def test_production(cleaned):
    df = cleaned("produksi_pangan")
    assert df.filter("kabupaten_kota LIKE 'Kab No%'").count() == 120
    row = df.filter("kabupaten_kota = 'Kab No1' AND tahun = 2010").first()
    assert (row["komoditas"], row["produktivitas_per_ha"]) == ("Padi Sawah", round(1900 / 101, 4))
    odd = df.filter("kabupaten_kota = 'X'").select("komoditas", "produksi", "tahun", "produktivitas")
    assert tuples(odd) == sorted(
        [("a", 1e6, 2000, 1.0), ("a", 5.0, 2030, 1.0), (None, 5.0, 2001, None)], key=repr
    )


def test_prices(cleaned):
    df = cleaned("harga_pangan")
    assert df.count() == 141
    assert tuples(df.filter("tahun = 2019")) == [
        ("Lampung", "Beras", 12500.0, 12500.0, 2019, "03/01/2019")
    ]


def test_weather(cleaned):
    df = cleaned("cuaca")
    assert df.count() == 84
    assert df.filter("curah_hujan IS NULL").count() == 56
    assert df.filter("suhu_rata_rata IS NULL").count() == 28
    assert df.filter("kelembaban IS NULL AND tahun = 2020").count() == 84


def test_weather_date_column(spark, raw_dir):
    raw = g.read_source(spark, f"{raw_dir}/cuaca.csv", presets.SOURCES["cuaca"])
    df = presets.clean_weather(raw, with_date=True)
    assert dict(df.dtypes)["tanggal_date"] == "date"
    assert df.filter("date_format(tanggal_date, 'dd-MM-yyyy') <> tanggal").count() == 0


def test_social(cleaned):
    df = cleaned("sosial_ekonomi")
    assert df.count() == 72
    assert df.agg({"jumlah_penduduk": "max"}).first()[0] == 200_011


def test_consumption(cleaned):
    df = cleaned("konsumsi_pangan")
    assert df.count() == 73
    assert {r[0] for r in df.select("konsumsi_per_kapita").distinct().collect()} == {125.89, 0.0}


def test_index(cleaned):
    df = cleaned("ikp")
    assert df.count() == 72
    assert df.filter("kategori_ikp = 5").count() == 36


def test_index_with_proper_columns(spark, rows):
    df = rows("kabupaten_kota string, Tahun string, IKP string, kategori_ikp string",
              ("A!", "2018", "77.5", "5"), ("A", "2018", "-", "5"))
    assert tuples(presets.clean_index(df)) == [("A", 77.5, 5, 2018)]


def test_whole_run(spark, raw_dir, tmp_path):
    silver = run_silver(spark, raw_dir, str(tmp_path / "silver"))
    assert {name: result["rows_out"] for name, result in silver.items()} == {
        "produksi_pangan": 123,
        "harga_pangan": 141,
        "cuaca": 84,
        "sosial_ekonomi": 72,
        "konsumsi_pangan": 73,
        "ikp": 72,
    }
    assert silver["produksi_pangan"]["rows_in"] == 131
    assert silver["produksi_pangan"]["quality"]["status"] in ("PASS", "REVIEW REQUIRED")
    assert silver["cuaca"]["null_rainfall"] == 56
    assert silver["harga_pangan"]["corrupt_rows"] == 1
    assert silver["harga_pangan"]["rows_in"] == 145
    assert silver["ikp"]["category_5"] == 36
    assert not list((tmp_path / "silver").glob("*_staging/stage-*"))
    assert spark.table("silver.cuaca").filter("tahun = 2020").count() == 84

    gold = run_gold(spark, str(tmp_path / "gold"))
    assert gold["ketahanan_pangan_kab"] == {"row_count": 123, "region_count": 13, "valid": True}
    enriched = spark.table("gold.ketahanan_pangan_enriched")
    assert enriched.count() == 123
    row = enriched.filter("kabupaten_kota = 'kab no3' AND tahun = 2013").first()
    assert row["produksi_per_kapita"] == 3700 / 200_003
    assert (row["total_konsumsi_per_kapita"], row["skor_ikp"]) == (125.89, 63.43)

    spark.sql("DROP TABLE silver.ikp")
    fewer = run_gold(spark, str(tmp_path / "gold"))
    assert fewer["ketahanan_pangan_enriched"]["row_count"] == 123
    assert "skor_ikp" not in spark.table("gold.ketahanan_pangan_enriched").columns
    spark.sql("DROP DATABASE silver CASCADE")
    with pytest.raises(RuntimeError, match="produksi_pangan"):
        run_gold(spark, str(tmp_path / "gold"))
    spark.sql("DROP DATABASE gold CASCADE")


def test_failed_gate_leaves_the_table_alone(spark, raw_dir, tmp_path):
    folder = str(tmp_path / "silver")
    run_silver(spark, raw_dir, folder, ["ikp"], "gated")
    short = tmp_path / "short"
    short.mkdir()
    (short / "ikp.csv").write_text(f'"{INDEX_HEADER}"\n"1;18;P;X;1;K;2018;70.5;1;5"\n')
    with pytest.raises(ValueError, match="fewer than 50"):
        run_silver(spark, str(short), folder, ["ikp"], "gated")
    assert spark.table("gated.ikp").count() == 72
    (short / "cuaca.csv").write_text("TANGGAL;suhu\n01-01-2020;1\n")
    with pytest.raises(ValueError, match="curah_hujan"):
        run_silver(spark, str(short), folder, ["cuaca"], "gated")
    spark.sql("DROP DATABASE gated CASCADE")


def test_prices_with_a_field_too_many_are_no_prices(cleaned):
    assert cleaned("harga_pangan").filter("komoditas = 'Gula'").count() == 0


SHAPES = {
    "produksi_pangan": ("Metro;Padi;500;10;2;2018", ["Metro;Padi;500;10;2;1;2018", "Metro;Padi;500;10;2018"]),
    "cuaca": ("01-02-2018;27;1", ["01-02-2018;27;1;234", "01-02-2018;27"]),
    "sosial_ekonomi": ("Metro;2018;100;12;900", ["Metro;2018;100;12;1;900", "Metro;2018;100;12"]),
    "konsumsi_pangan": ("2018;Metro;Beras;12", ["2018;Metro;Beras;12;500", "2018;Metro;Beras"]),
    "ikp": ("Metro;2018;7.5;4", ["Metro;2018;7;1;4", "Metro;2018;7"]),
}


@pytest.mark.parametrize("name", list(SHAPES))
def test_lines_of_the_wrong_shape_are_counted_and_left_out(spark, tmp_path, name):
    sound, wrong = SHAPES[name]
    header = next(FILES[name][0]()) if name != "ikp" else "kabupaten_kota;Tahun;IKP;kategori_ikp"
    path = tmp_path / f"{name}.csv"
    path.write_text("\n".join([header, sound, *wrong]) + "\n")
    dataset = presets.DATASETS[name]
    raw = g.read_source(spark, str(path), dataset.source)
    assert dataset.missing(raw) == []
    assert raw.filter(dataset.corrupt(raw)).count() == 2
    assert dataset.clean(raw).count() == 1


def test_packed_index_lines_of_the_wrong_shape(spark, tmp_path):
    parts = "1;18;Prov;Metro;1804;Kabupaten;2018;70.5;1;5"
    path = tmp_path / "ikp.csv"
    path.write_text("\n".join(f'"{line}"' for line in (INDEX_HEADER, parts, "0;" + parts, parts[2:])) + f"\n{parts}\n")
    dataset = presets.DATASETS["ikp"]
    raw = g.read_source(spark, str(path), dataset.source)
    assert raw.filter(dataset.corrupt(raw)).count() == 3
    assert tuples(dataset.clean(raw)) == [("Metro", 70.5, 5, 2018)]


def test_assessed_run_reads_the_raw_file_once(spark, raw_dir, tmp_path):
    raw = g.read_source(spark, f"{raw_dir}/produksi_pangan.csv", presets.SOURCES["produksi_pangan"])
    seen = spark.sparkContext.accumulator(0)
    counted = raw.rdd.map(lambda row: (seen.add(1), row)[1])
    frame = spark.createDataFrame(counted, raw.schema)
    result = clean_to_table(spark, "produksi_pangan", frame, str(tmp_path / "t"), "watched", assessed=True)
    assert seen.value == result["rows_in"] == raw.count()
    table = spark.table("watched.produksi_pangan")
    spec = presets.quality_spec("produksi_pangan")
    judged = g.quality_report(g.assess(table.select(*presets.SILVER_SCHEMAS["produksi_pangan"].names), spec, checks=g.SCORED_CHECKS))
    assert result["table_quality"] == judged.first().asDict()
    inferred = g.read_source(spark, f"{raw_dir}/produksi_pangan.csv", presets.SOURCES["produksi_pangan"], infer_schema=True)
    typed = inferred.drop(presets.CORRUPT)
    assert result["quality"] == g.quality_report(g.assess(typed, spec, checks=g.SCORED_CHECKS)).first().asDict()
    assert result["suspicious_productivity"] == table.filter("produktivitas_per_ha <= 0 OR produktivitas_per_ha > 100").count()
    spark.sql("DROP DATABASE watched CASCADE")


def test_raw_file_is_scanned_once(spark, raw_dir, tmp_path):
    """Rows of the wrong shape, rows in and the cleaned rows come from one scan."""
    raw = g.read_source(spark, f"{raw_dir}/cuaca.csv", presets.SOURCES["cuaca"])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("scan", "scan")
    seen = spark.sparkContext.accumulator(0)
    counted = raw.rdd.map(lambda row: (seen.add(1), row)[1])
    result = clean_to_table(spark, "cuaca", spark.createDataFrame(counted, raw.schema), str(tmp_path / "t"), "once")
    spark.sparkContext.setJobGroup("rest", "rest")
    assert seen.value == result["rows_in"] == raw.count()
    assert tracker.getJobIdsForGroup("scan")
    spark.sql("DROP DATABASE once CASCADE")


def test_aliases_join_spellings(spark, raw_dir, tmp_path):
    aliases = {"Kab No0": "North", "Kab No1": "North"}
    run_silver(spark, raw_dir, str(tmp_path / "s"), ["produksi_pangan", "cuaca"], "aliased", (), aliases)
    table = spark.table("aliased.produksi_pangan")
    assert table.filter("kabupaten_kota = 'North'").count() == 20
    spark.sql("DROP DATABASE aliased CASCADE")


def test_command_line(spark, raw_dir, tmp_path):
    folder = str(tmp_path / "s")
    args = arguments(["silver", raw_dir, folder, "--only", "produksi_pangan,cuaca", "--assess", "cuaca",
                      "--database", "asked", "--alias", "Kab No0=North"])
    found = run(spark, args)
    assert set(found) == {"produksi_pangan", "cuaca"} and "quality" in found["cuaca"]
    assert spark.table("asked.produksi_pangan").filter("kabupaten_kota = 'North'").count() == 10
    args = arguments(["gold", str(tmp_path / "g"), "--silver", "asked", "--database", "asked_gold",
                      "--province-wide", "cuaca"])
    assert run(spark, args)["ketahanan_pangan_enriched"]["valid"]
    wide = spark.table("asked_gold.ketahanan_pangan_enriched")
    assert wide.filter("avg_curah_hujan IS NOT NULL").count() == wide.filter("tahun = 2020").count()
    with pytest.raises(SystemExit):
        arguments(["silver", raw_dir, folder, "--only", "nothing"])
    with pytest.raises(SystemExit):
        arguments(["silver", raw_dir, folder, "--alias", "nothing"])
    for database in ("asked", "asked_gold"):
        spark.sql(f"DROP DATABASE {database} CASCADE")
