"""The food-security datasets: six raw layouts, their cleaners, and two marts.

Column names, markers, bounds and thresholds are fixed values of the data model.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import (
    date_from,
    label_by_threshold,
    named,
    parse_number,
    score_by_threshold,
    year_from,
)
from granary.operators.cleaning import (
    add_ratio,
    cast_columns,
    clean_text,
    conform,
    dedupe,
    evaluate_once,
    normalize_key,
    null_markers,
    null_sentinels,
    rename_columns,
    standardize_name,
)
from granary.operators.marts import enrich, summarize, summarize_normalized
from granary.operators.repair import is_corrupt, is_packed, repair_rows, unpack_delimited
from granary.operators.rules import drop_blank_rows, keep_valid, missing_columns
from granary.spec import Agg, Enrichment, QualitySpec, RatioCheck, Rule, SourceSpec

REGION = "kabupaten_kota"
YEAR = "tahun"
KEYS = [REGION, YEAR]
PROVINCE = "Lampung"
MARKERS = ("#N/A", "8888", "9999", "-")
YEARS = Rule(YEAR, low=2000, high=2030)
INDEX_SEPARATOR = ";"
CORRUPT = "_corrupt_record"

# Cleaned region spellings and the names they stand for.
Aliases = Mapping[str, str] | None


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType()}


def _schema(columns: str) -> T.StructType:
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns of the cleaned tables.
SILVER_SCHEMAS: dict[str, T.StructType] = {
    "produksi_pangan": _schema(
        "kabupaten_kota string, komoditas string, produksi double, luas_panen double, "
        "produktivitas double, produktivitas_per_ha double, tahun int"
    ),
    "harga_pangan": _schema(
        "kabupaten_kota string, komoditas string, harga_produsen double, "
        "harga_konsumen double, tahun int, tanggal string"
    ),
    "cuaca": _schema(
        "kabupaten_kota string, curah_hujan double, suhu_rata_rata double, "
        "kelembaban double, tahun int, tanggal string"
    ),
    "sosial_ekonomi": _schema(
        "kabupaten_kota string, jumlah_penduduk int, tingkat_kemiskinan double, "
        "ipkm double, tahun int"
    ),
    "konsumsi_pangan": _schema(
        "kabupaten_kota string, komoditas string, konsumsi_per_kapita double, tahun int"
    ),
    "ikp": _schema("kabupaten_kota string, skor_ikp double, kategori_ikp int, tahun int"),
}

# Layouts of the raw files.
SOURCES: dict[str, SourceSpec] = {
    "produksi_pangan": SourceSpec(
        "produksi_pangan",
        ";",
        (REGION, "komoditas", "produksi", "luas_panen", "produktivitas", YEAR),
        corrupt_column=CORRUPT,
    ),
    "harga_pangan": SourceSpec(
        "harga_pangan",
        ",",
        ("komoditas", "tanggal", "harga_pangan"),
        renames={"harga pangan": "harga_pangan"},
        options={"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"},
        corrupt_column=CORRUPT,
    ),
    "cuaca": SourceSpec(
        "cuaca",
        ";",
        ("TANGGAL", "suhu", "curah_hujan"),
        options={"nullValue": "-", "emptyValue": "-"},
        corrupt_column=CORRUPT,
    ),
    "sosial_ekonomi": SourceSpec(
        "sosial_ekonomi",
        ";",
        (
            "Kabupaten/Kota",
            "Tahun",
            "Jumlah_Penduduk",
            "Persentase_miskin",
            "pengeluaran_per_kapita",
        ),
        corrupt_column=CORRUPT,
    ),
    "konsumsi_pangan": SourceSpec(
        "konsumsi_pangan",
        ";",
        ("Tahun", "Kabupaten_Kota", "Komoditas", "Konsumsi Pangan"),
        corrupt_column=CORRUPT,
    ),
    "ikp": SourceSpec(
        "ikp",
        ";",
        (REGION, "Tahun", "IKP", "kategori_ikp"),
        renames={"Nama Kabupaten": REGION, "KELOMPOK IKP": "kategori_ikp"},
        corrupt_column=CORRUPT,
    ),
}

# Which rows of a cleaned table are valid.
RULES: dict[str, tuple[Rule, ...]] = {
    "produksi_pangan": (
        Rule("produksi", low=0, low_open=True, high=1_000_000),
        Rule("luas_panen", low=0, low_open=True),
        YEARS,
        Rule(REGION),
    ),
    "harga_pangan": (
        Rule("harga_pangan", low=0, low_open=True, high=1_000_000_000),
        YEARS,
        Rule("komoditas"),
    ),
    "cuaca": (
        YEARS,
        Rule(REGION),
        Rule("curah_hujan", low=0, nullable=True),
        Rule("suhu_rata_rata", low=-50, high=60, nullable=True),
    ),
    "sosial_ekonomi": (
        YEARS,
        Rule(REGION),
        Rule("jumlah_penduduk", low=0, low_open=True),
        Rule("tingkat_kemiskinan", low=0, high=100),
        Rule("ipkm", low=0, low_open=True),
    ),
    "konsumsi_pangan": (
        YEARS,
        Rule(REGION, non_blank=True),
        Rule("komoditas", non_blank=True),
        Rule("konsumsi_per_kapita", low=0),
    ),
    "ikp": (
        YEARS,
        Rule(REGION, non_blank=True),
        Rule("skor_ikp", low=0, high=100),
        Rule("kategori_ikp", low=1, high=6),
    ),
}


def corrupt_lines(df: DataFrame) -> Column:
    """True for raw lines with a field too many or too few, whose fields may stand in wrong places."""
    return is_corrupt(df, F.lit(False), CORRUPT)


def without_corrupt(df: DataFrame, corrupt: Callable[[DataFrame], Column] = corrupt_lines) -> DataFrame:
    """Raw rows whose lines have the right shape; a reader would cut the others to fit."""
    return df.filter(~corrupt(df)).drop(CORRUPT)


def clean_production(df: DataFrame, aliases: Aliases = None) -> DataFrame:
    """Production and harvested area per region, commodity and year."""
    return (
        df.transform(without_corrupt)
        .transform(null_markers, MARKERS)
        .transform(standardize_name, REGION, aliases)
        .transform(
            cast_columns,
            {YEAR: "int", "produksi": "double", "luas_panen": "double", "produktivitas": "double"},
        )
        .transform(evaluate_once)
        .transform(keep_valid, RULES["produksi_pangan"])
        .transform(clean_text, "komoditas")
        .transform(dedupe)  # the yield follows from the row, so it is added after the shuffle
        .transform(add_ratio, "produktivitas_per_ha", "produksi", "luas_panen", digits=4)
        .transform(conform, SILVER_SCHEMAS["produksi_pangan"])
    )


# Where the fields of a packed price line are.
PACKED_PRICE = {
    "komoditas": r"^([^,]+)",
    "tanggal": r",([0-9/]+),",
    "harga_pangan": r',"([0-9,]+)"',
}


def corrupt_prices(df: DataFrame) -> Column:
    """True for raw price lines of the wrong shape, which hold no price that can be told.

    Packed lines have too few fields as well, but those can be taken apart.
    """
    return is_corrupt(df, is_packed("komoditas", "tanggal"), CORRUPT)


def clean_prices(df: DataFrame) -> DataFrame:
    """Province-wide commodity prices; the one price serves producer and consumer.

    Lines with a field too many are dropped: an unquoted ``12,000`` is not a price of 12.
    The year goes through the shuffle of the copies, which costs four bytes and saves
    reading every date twice.
    """
    price = parse_number(named("harga_pangan"), thousands=",")
    return (
        df.transform(without_corrupt, corrupt_prices)
        .transform(repair_rows, "komoditas", "tanggal", PACKED_PRICE)
        .transform(null_markers, MARKERS)
        .withColumns(
            {
                "harga_pangan": price,
                YEAR: year_from(named("tanggal"), "dd/MM/yyyy", allow_time=True),
            }
        )
        .transform(clean_text, "komoditas")
        .transform(evaluate_once)
        .transform(keep_valid, RULES["harga_pangan"])
        .transform(dedupe)
        .transform(
            conform,
            SILVER_SCHEMAS["harga_pangan"],
            {
                REGION: PROVINCE,
                "harga_produsen": named("harga_pangan"),
                "harga_konsumen": named("harga_pangan"),
            },
        )
    )


def clean_weather(df: DataFrame, with_date: bool = False) -> DataFrame:
    """Daily rain and temperature of the province; ``with_date`` adds a DATE column."""
    cleaned = (
        df.transform(without_corrupt)
        .transform(null_markers, MARKERS)
        .withColumns(
            {
                "curah_hujan": parse_number(named("curah_hujan")),
                "suhu": parse_number(named("suhu"), nulls=()),
                YEAR: year_from(named("TANGGAL"), "dd-MM-yyyy"),
                REGION: F.lit(PROVINCE),
            }
        )
        .transform(rename_columns, {"suhu": "suhu_rata_rata", "TANGGAL": "tanggal"})
        .transform(null_sentinels, {"curah_hujan": [8888]})
        .transform(evaluate_once)
        .transform(keep_valid, RULES["cuaca"])
        .transform(dedupe)
    )
    result = conform(cleaned, SILVER_SCHEMAS["cuaca"])
    if with_date:
        result = result.withColumn("tanggal_date", date_from(named("tanggal"), "dd-MM-yyyy"))
    return result


# Raw names of the socio-economic and consumption columns.
SOCIAL_NAMES = {
    "Kabupaten/Kota": REGION,
    "Tahun": YEAR,
    "Jumlah_Penduduk": "jumlah_penduduk",
    "Persentase_miskin": "tingkat_kemiskinan",
    "pengeluaran_per_kapita": "ipkm",
}
CONSUMPTION_NAMES = {
    "Tahun": YEAR,
    "Kabupaten_Kota": REGION,
    "Komoditas": "komoditas",
    "Konsumsi Pangan": "konsumsi_per_kapita",
}


def clean_social(df: DataFrame, aliases: Aliases = None) -> DataFrame:
    """Population, poverty and spending per region and year."""
    return (
        df.transform(without_corrupt)
        .transform(drop_blank_rows, ["Tahun", "Jumlah_Penduduk", "Persentase_miskin"])
        .transform(rename_columns, SOCIAL_NAMES)
        .transform(null_markers, MARKERS)
        .transform(
            cast_columns,
            {
                YEAR: "int",
                "jumlah_penduduk": "int",
                "tingkat_kemiskinan": "double",
                "ipkm": "double",
            },
        )
        .transform(standardize_name, REGION, aliases)
        .transform(evaluate_once)
        .transform(keep_valid, RULES["sosial_ekonomi"])
        .transform(dedupe)
        .transform(conform, SILVER_SCHEMAS["sosial_ekonomi"])
    )


def clean_consumption(df: DataFrame, aliases: Aliases = None) -> DataFrame:
    """Consumption per head by region, commodity and year; decimal commas."""
    return (
        df.transform(without_corrupt)
        .transform(rename_columns, CONSUMPTION_NAMES)
        .transform(null_markers, MARKERS)
        .withColumn(
            "konsumsi_per_kapita",
            parse_number(named("konsumsi_per_kapita"), decimal=",", nulls=()),
        )
        .transform(cast_columns, {YEAR: "int"})
        .transform(standardize_name, REGION, aliases)
        .transform(clean_text, "komoditas")
        .transform(evaluate_once)
        .transform(keep_valid, RULES["konsumsi_pangan"])
        .transform(dedupe)
        .transform(conform, SILVER_SCHEMAS["konsumsi_pangan"])
    )


# Positions of the fields in a packed index line.
PACKED_INDEX = {REGION: 3, YEAR: 6, "skor_ikp": 7, "kategori_ikp": 9}


def unpack_index(df: DataFrame) -> DataFrame:
    """The four index columns, from packed lines or from proper columns."""
    first = df.columns[0]
    if INDEX_SEPARATOR in first:
        return unpack_delimited(df, first, INDEX_SEPARATOR, PACKED_INDEX)
    return rename_columns(df, {"Tahun": YEAR, "IKP": "skor_ikp"}).select(*PACKED_INDEX)


def corrupt_index(df: DataFrame) -> Column:
    """True for raw index lines of the wrong shape.

    A packed line is one field to the reader, so its parts are counted against those of the header.
    """
    first = df.columns[0]
    if INDEX_SEPARATOR not in first:
        return corrupt_lines(df)
    parts = F.size(F.split(F.coalesce(named(first), F.lit("")), INDEX_SEPARATOR))
    return corrupt_lines(df) | (parts != first.count(INDEX_SEPARATOR) + 1)


def clean_index(df: DataFrame, aliases: Aliases = None) -> DataFrame:
    """Food security index and its category per region and year."""
    return (
        df.transform(without_corrupt, corrupt_index)
        .transform(unpack_index)
        .transform(null_markers, MARKERS)
        .transform(cast_columns, {YEAR: "int", "skor_ikp": "double", "kategori_ikp": "int"})
        .transform(standardize_name, REGION, aliases)
        .transform(evaluate_once)
        .transform(keep_valid, RULES["ikp"])
        .transform(dedupe)
        .transform(conform, SILVER_SCHEMAS["ikp"])
    )


@dataclass(frozen=True)
class Gate:
    """What a cleaned table must offer, and what is counted on it."""

    columns: tuple[str, ...]
    min_rows: int
    counts: Callable[[], Mapping[str, Column]] = field(default=dict)


@dataclass(frozen=True)
class Dataset:
    """How one dataset is read, cleaned and judged; ``regional`` cleaners take region aliases."""

    source: SourceSpec
    clean: Callable[..., DataFrame]
    gate: Gate
    regional: bool = True
    corrupt: Callable[[DataFrame], Column] = corrupt_lines

    def cleaned(self, raw: DataFrame, aliases: Aliases = None) -> DataFrame:
        return self.clean(raw, aliases) if self.regional else self.clean(raw)

    def missing(self, raw: DataFrame) -> list[str]:
        """Raw columns the cleaner needs and the file lacks."""
        packed = self.source.name == "ikp" and INDEX_SEPARATOR in raw.columns[0]
        return [] if packed else missing_columns(raw, self.source.columns)


# The counts that are reported for each cleaned table.


def _production_counts() -> dict[str, Column]:
    value = named("produktivitas_per_ha")
    return {"suspicious_productivity": (value <= 0) | (value > 100)}


def _price_counts() -> dict[str, Column]:
    producer, consumer = named("harga_produsen"), named("harga_konsumen")
    return {
        "zero_prices": (producer <= 0) | (consumer <= 0),
        "high_prices": producer > 500_000,
    }


def _weather_counts() -> dict[str, Column]:
    rain = named("curah_hujan")
    return {
        "null_rainfall": rain.isNull(),
        "null_temperature": named("suhu_rata_rata").isNull(),
        "extreme_rainfall": rain > 500,
    }


def _social_counts() -> dict[str, Column]:
    return {
        "high_poverty": named("tingkat_kemiskinan") > 30,
        "low_population": named("jumlah_penduduk") < 100_000,
        "extreme_spending": named("ipkm") > 5_000_000,
    }


def _consumption_counts() -> dict[str, Column]:
    value = named("konsumsi_per_kapita")
    return {
        "zero_consumption": value == 0,
        "high_consumption": value > 500,
        "extreme_consumption": value > 1000,
    }


def _index_counts() -> dict[str, Column]:
    score, category = named("skor_ikp"), named("kategori_ikp")
    counts = {"low_index": score < 60, "high_index": score > 80}
    return counts | {f"category_{n}": category == n for n in range(1, 7)}


DATASETS: dict[str, Dataset] = {
    "produksi_pangan": Dataset(
        SOURCES["produksi_pangan"],
        clean_production,
        Gate(("produksi", "luas_panen"), 100, _production_counts),
    ),
    "harga_pangan": Dataset(
        SOURCES["harga_pangan"],
        clean_prices,
        Gate((REGION, "komoditas", "harga_produsen", YEAR), 100, _price_counts),
        regional=False,
        corrupt=corrupt_prices,
    ),
    "cuaca": Dataset(
        SOURCES["cuaca"],
        clean_weather,
        Gate((REGION, "curah_hujan", YEAR), 50, _weather_counts),
        regional=False,
    ),
    "sosial_ekonomi": Dataset(
        SOURCES["sosial_ekonomi"],
        clean_social,
        Gate((REGION, "jumlah_penduduk", "tingkat_kemiskinan", YEAR), 50, _social_counts),
    ),
    "konsumsi_pangan": Dataset(
        SOURCES["konsumsi_pangan"],
        clean_consumption,
        Gate((REGION, "komoditas", "konsumsi_per_kapita", YEAR), 50, _consumption_counts),
    ),
    "ikp": Dataset(
        SOURCES["ikp"],
        clean_index,
        Gate((REGION, "skor_ikp", "kategori_ikp", YEAR), 50, _index_counts),
        corrupt=corrupt_index,
    ),
}


# Declared columns per dataset, for the schema check.
DECLARED_COLUMNS = {
    "produksi_pangan": SOURCES["produksi_pangan"].columns,
    "harga_pangan": (REGION, "komoditas", "harga_produsen", "harga_konsumen", YEAR),
    "cuaca": (REGION, "curah_hujan", "suhu_rata_rata", "kelembaban", YEAR),
    "sosial_ekonomi": (REGION, "jumlah_penduduk", "tingkat_kemiskinan", "ipkm", YEAR),
    "konsumsi_pangan": (REGION, "komoditas", "konsumsi_per_kapita", YEAR),
    "ikp": (REGION, "skor_ikp", "kategori_ikp", YEAR),
}


def quality_spec(dataset: str) -> QualitySpec:
    """What the quality checks expect of one of the datasets."""
    by_item = dataset in ("produksi_pangan", "harga_pangan", "konsumsi_pangan")
    return QualitySpec(
        dataset=dataset,
        expected_columns=DECLARED_COLUMNS.get(dataset, ()),
        key_columns=(REGION, YEAR, "komoditas") if by_item else (REGION, YEAR),
        markers=MARKERS,
        non_negative=(
            "produksi",
            "luas_panen",
            "harga_produsen",
            "harga_konsumen",
            "jumlah_penduduk",
        ),
        year_column=YEAR,
        region_column=REGION,
        ratio=RatioCheck("produktivitas", "produksi", "luas_panen"),
    )


# Aggregates, scores and labels of the marts.
PRODUCTION_AGGS = (
    Agg("sum", "produksi", "total_produksi"),
    Agg("avg", "produktivitas", "avg_produktivitas"),
    Agg("sum", "luas_panen", "total_luas_panen"),
    Agg("count", "komoditas", "jenis_komoditas"),
)
DISTINCT_ITEMS = Agg("count_distinct", "komoditas", "jenis_komoditas")
SOURCE_AGGS: dict[str, tuple[Agg, ...]] = {
    "harga_pangan": (
        Agg("avg", "harga_produsen", "avg_harga_produsen"),
        Agg("avg", "harga_konsumen", "avg_harga_konsumen"),
    ),
    "cuaca": (
        Agg("avg", "curah_hujan", "avg_curah_hujan"),
        Agg("avg", "suhu_rata_rata", "avg_suhu"),
    ),
    "sosial_ekonomi": (),
    "konsumsi_pangan": (Agg("sum", "konsumsi_per_kapita", "total_konsumsi_per_kapita"),),
    "ikp": (Agg("avg", "skor_ikp", "skor_ikp"), Agg("avg", "kategori_ikp", "kategori_ikp")),
}
SCORE_BANDS = ((50_000, 80), (20_000, 60))
SCORE_DEFAULT = 40
LABEL_BANDS = ((70, "Tahan"), (50, "Sedang"))
LABEL_DEFAULT = "Rentan"
MART_REQUIRED = (REGION, YEAR, "total_produksi", "kategori_ketahanan")


def production_summary(df: DataFrame, distinct_items: bool = False) -> DataFrame:
    """Totals per region and year. Items are counted as rows unless distinct is asked for."""
    aggs = (*PRODUCTION_AGGS[:-1], DISTINCT_ITEMS) if distinct_items else PRODUCTION_AGGS
    return summarize(df, KEYS, aggs)


def add_scores(df: DataFrame) -> DataFrame:
    """Availability score from total production, and the category from the score."""
    score = score_by_threshold(named("total_produksi"), SCORE_BANDS, SCORE_DEFAULT)
    label = label_by_threshold(named("skor_ketersediaan"), LABEL_BANDS, LABEL_DEFAULT)
    return df.withColumn("skor_ketersediaan", score).withColumn("kategori_ketahanan", label)


def scale_metric(df: DataFrame, name: str, column: str, by: float = 1000) -> DataFrame:
    """Add a column in larger units."""
    return df.withColumn(name, named(column) / F.lit(by))


def finish_indicators(summary: DataFrame) -> DataFrame:
    """Scaled production, score and category on a production summary."""
    return add_scores(scale_metric(summary, "produksi_per_kapita", "total_produksi"))


def mart_indicators(production: DataFrame) -> DataFrame:
    """The indicator mart: production alone, one row per region and year."""
    return finish_indicators(production_summary(production))


def mart_parts(
    production: DataFrame,
    sources: Mapping[str, DataFrame | None] | None = None,
    province_wide: tuple[str, ...] = (),
    unique_social: bool = False,
) -> tuple[DataFrame, list[Enrichment]]:
    """What :func:`mart_enriched` joins: the summary of production, and the sources that are there."""
    sources = sources or {}
    enrichments = []
    for name, aggs in SOURCE_AGGS.items():
        frame = sources.get(name)
        if frame is None:
            continue
        frame = rename_columns(frame, {"nama_kabupaten": REGION})
        if name in province_wide:
            enrichments.append(Enrichment(name, frame.drop(REGION), [YEAR], aggs))
        elif aggs:
            summary = summarize_normalized(frame, REGION, KEYS, aggs)
            enrichments.append(Enrichment(name, summary, KEYS, unique=True))
        else:
            rows = normalize_key(frame, REGION)
            enrichments.append(Enrichment(name, rows, KEYS, unique=unique_social))
    return summarize_normalized(production, REGION, KEYS, PRODUCTION_AGGS), enrichments


def finish_enriched(base: DataFrame, enrichments: Sequence[Enrichment]) -> DataFrame:
    """The enriched mart from its parts."""
    with_ratio = add_ratio(
        enrich(base, enrichments),
        "produksi_per_kapita",
        "total_produksi",
        "jumlah_penduduk",
        guard=True,
        without_denominator="numerator",
    )
    return add_scores(with_ratio)


def mart_enriched(
    production: DataFrame,
    sources: Mapping[str, DataFrame | None] | None = None,
    province_wide: tuple[str, ...] = (),
    unique_social: bool = False,
) -> DataFrame:
    """The enriched mart: production with every other cleaned table that is there.

    Sources named in ``province_wide`` hold one region for all, and join by year
    alone; by default all join by region and year. ``unique_social`` promises
    one socio-economic row per key.
    """
    return finish_enriched(*mart_parts(production, sources, province_wide, unique_social))
