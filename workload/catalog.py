"""Every query of the workload with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import granary as g
from granary.functions import (
    label_by_threshold,
    named,
    parse_number,
    score_by_threshold,
    year_from,
)
from granary.plans import presets
from granary.plans.jobs import mart_bucketed, run_gold, run_silver
from granary.plans.streams import stream_silver
from workload import scratch
from workload.views import INDEX_HEADER, VIEWS, Tables, view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

KEYS = presets.KEYS
DIGITS = 6


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` as a query, with its SQL if it has one."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({name: F.round(named(name), digits) for name in columns})


def rounded_sql(*columns: str, digits: int = DIGITS) -> str:
    return ", ".join(f"round({name}, {digits}) AS {name}" for name in columns)


# ---------------------------------------------------------------- cell cleaning


@query(
    "null_markers",
    with_views(
        "SELECT "
        + ", ".join(
            f"CASE WHEN {name} IN ('#N/A', '8888', '9999', '-') THEN NULL ELSE {name} END AS {name}"
            for name in ("kabupaten_kota", "komoditas", "produksi", "luas_panen", "produktivitas", "tahun")
        )
        + " FROM raw_production",
        "raw_production",
    ),
)
def _null_markers(t: Tables) -> DataFrame:
    return g.null_markers(view(t, "raw_production"), presets.MARKERS)


@query(
    "null_markers_typed",
    "SELECT CASE WHEN o_orderkey IN (8888, 9999) THEN NULL ELSE o_orderkey END AS o_orderkey, "
    "CASE WHEN o_custkey IN (7, 11) THEN NULL ELSE o_custkey END AS o_custkey, "
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders",
)
def _null_markers_typed(t: Tables) -> DataFrame:
    own = {
        "o_orderkey": presets.MARKERS,
        "o_custkey": ["7", "11", "7.5"],
        "o_orderstatus": ["P", ""],
    }
    return g.null_markers(t.orders.select(*own), presets.MARKERS, own)


@query(
    "null_sentinels",
    with_views(
        "SELECT NULLIF(TRY_CAST(NULLIF(NULLIF(curah_hujan, '-'), '') AS DOUBLE), 8888) AS rain "
        "FROM raw_weather",
        "raw_weather",
    ),
)
def _null_sentinels(t: Tables) -> DataFrame:
    rain = view(t, "raw_weather").select(parse_number(F.col("curah_hujan")).alias("rain"))
    return g.null_sentinels(rain, {"rain": [8888]})


TIDY_TEXT_SQL = r"regexp_replace(regexp_replace(text, '[^a-zA-Z0-9\s]', '', 'g'), '\s+', ' ', 'g')"


@query("clean_text", f"SELECT doc_id, {TIDY_TEXT_SQL} AS text FROM documents")
def _clean_text(t: Tables) -> DataFrame:
    return g.clean_text(t.documents.select("doc_id", "text"), "text")


@query("standardize_name", f"SELECT doc_id, trim({TIDY_TEXT_SQL}) AS text FROM documents")
def _standardize_name(t: Tables) -> DataFrame:
    return g.standardize_name(t.documents.select("doc_id", "text"), "text")


@query(
    "normalize_key",
    r"SELECT doc_id, lower(regexp_replace(text, '[^a-zA-Z0-9\s]', '', 'g')) AS text FROM documents",
)
def _normalize_key(t: Tables) -> DataFrame:
    return g.normalize_key(t.documents.select("doc_id", "text"), "text")


@query(
    "standardize_aliases",
    with_views(
        "SELECT CASE name WHEN 'Kab North1' THEN 'North One' ELSE name END AS kabupaten_kota FROM "
        r"(SELECT trim(regexp_replace(regexp_replace(kabupaten_kota, '[^a-zA-Z0-9\s]', '', 'g'), "
        r"'\s+', ' ', 'g')) AS name FROM raw_production)",
        "raw_production",
    ),
)
def _standardize_aliases(t: Tables) -> DataFrame:
    raw = view(t, "raw_production").select("kabupaten_kota")
    return g.standardize_name(raw, "kabupaten_kota", {"Kab North1": "North One"})


@query(
    "parse_thousands",
    with_views(
        "SELECT harga_pangan, TRY_CAST(NULLIF(NULLIF(trim(replace(replace(harga_pangan, '\"', ''), "
        "',', '')), '-'), '') AS DOUBLE) AS price FROM raw_price",
        "raw_price",
    ),
)
def _parse_thousands(t: Tables) -> DataFrame:
    price = parse_number(F.col("harga_pangan"), thousands=",").alias("price")
    return view(t, "raw_price").select("harga_pangan", price)


@query(
    "parse_decimal_comma",
    with_views(
        "SELECT \"Konsumsi Pangan\" AS written, "
        "TRY_CAST(replace(\"Konsumsi Pangan\", ',', '.') AS DOUBLE) AS consumption "
        "FROM raw_consumption",
        "raw_consumption",
    ),
)
def _parse_decimal_comma(t: Tables) -> DataFrame:
    written = F.col("Konsumsi Pangan")
    value = parse_number(written, decimal=",", nulls=()).alias("consumption")
    return view(t, "raw_consumption").select(written.alias("written"), value)


@query(
    "parse_weather_numeric",
    with_views(
        "SELECT TRY_CAST(NULLIF(NULLIF(curah_hujan, '-'), '') AS DOUBLE) AS rain, "
        "TRY_CAST(suhu AS DOUBLE) AS temperature FROM raw_weather",
        "raw_weather",
    ),
)
def _parse_weather_numeric(t: Tables) -> DataFrame:
    return view(t, "raw_weather").select(
        parse_number(F.col("curah_hujan")).alias("rain"),
        parse_number(F.col("suhu"), nulls=()).alias("temperature"),
    )


@query(
    "year_from_slash",
    with_views(
        "SELECT o_orderkey, CAST(year(CASE WHEN regexp_full_match(slash, '\\d{2}/\\d{2}/\\d{4}') "
        "THEN try_strptime(slash, '%d/%m/%Y') END) AS INTEGER) AS tahun FROM dated_orders",
        "dated_orders",
    ),
)
def _year_from_slash(t: Tables) -> DataFrame:
    year = year_from(F.col("slash"), "dd/MM/yyyy", allow_time=True).alias("tahun")
    return view(t, "dated_orders").select("o_orderkey", year)


@query(
    "year_from_dash",
    with_views(
        "SELECT o_orderkey, CAST(year(CASE WHEN regexp_full_match(dash, '\\d{2}-\\d{2}-\\d{4}') "
        "THEN try_strptime(dash, '%d-%m-%Y') END) AS INTEGER) AS tahun FROM dated_orders",
        "dated_orders",
    ),
)
def _year_from_dash(t: Tables) -> DataFrame:
    year = year_from(F.col("dash"), "dd-MM-yyyy").alias("tahun")
    return view(t, "dated_orders").select("o_orderkey", year)


@query(
    "cast_columns",
    with_views(
        "SELECT CAST(TRY_CAST(tahun AS DOUBLE) AS INTEGER) AS tahun, "
        "TRY_CAST(produksi AS DOUBLE) AS produksi, "
        "TRY_CAST(NULLIF(produktivitas, '') AS DOUBLE) AS produktivitas FROM raw_production",
        "raw_production",
    ),
)
def _cast_columns(t: Tables) -> DataFrame:
    raw = view(t, "raw_production").select("tahun", "produksi", "produktivitas")
    return g.cast_columns(raw, {"tahun": "int", "produksi": "double", "produktivitas": "double"})


@query(
    "conform_schema",
    "SELECT 'Lampung' AS kabupaten_kota, o_orderpriority AS komoditas, "
    "o_totalprice AS harga_produsen, o_totalprice AS harga_konsumen, NULL::DOUBLE AS kelembaban, "
    "CAST(o_orderkey AS INTEGER) AS nomor, strftime(o_orderdate, '%Y-%m-%d') AS tanggal FROM orders",
)
def _conform_schema(t: Tables) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("kabupaten_kota", T.StringType()),
            T.StructField("komoditas", T.StringType()),
            T.StructField("harga_produsen", T.DoubleType()),
            T.StructField("harga_konsumen", T.DoubleType()),
            T.StructField("kelembaban", T.DoubleType()),
            T.StructField("nomor", T.IntegerType()),
            T.StructField("tanggal", T.StringType()),
        ]
    )
    renamed = g.rename_columns(
        t.orders, {"o_orderpriority": "komoditas", "o_orderkey": "nomor", "absent": "x"}
    )
    defaults = {
        "kabupaten_kota": "Lampung",
        "harga_produsen": F.col("o_totalprice"),
        "harga_konsumen": F.col("o_totalprice"),
        "tanggal": F.to_date("o_orderdate").cast("string"),
    }
    return g.conform(renamed, schema, defaults)


@query(
    "add_ratio",
    with_views(
        "SELECT produksi, luas_panen, round(produksi / luas_panen, 4) AS produktivitas_per_ha "
        "FROM production WHERE luas_panen > 0",
        "production",
    ),
)
def _add_ratio(t: Tables) -> DataFrame:
    rows = view(t, "production").select("produksi", "luas_panen").filter("luas_panen > 0")
    return g.add_ratio(rows, "produktivitas_per_ha", "produksi", "luas_panen", digits=4)


@query(
    "scale_metric",
    with_views("SELECT produksi, produksi / 1000 AS scaled FROM production", "production"),
)
def _scale_metric(t: Tables) -> DataFrame:
    rows = view(t, "production").select("produksi")
    return presets.scale_metric(rows, "scaled", "produksi")


@query(
    "per_capita",
    with_views(
        "SELECT ipkm, jumlah_penduduk, "
        "CASE WHEN jumlah_penduduk > 0 THEN ipkm / jumlah_penduduk END AS per_capita, "
        "CAST(ipkm AS DOUBLE) AS fallback FROM social",
        "social",
    ),
)
def _per_capita(t: Tables) -> DataFrame:
    rows = view(t, "social").select("ipkm", "jumlah_penduduk")
    guarded = g.add_ratio(rows, "per_capita", "ipkm", "jumlah_penduduk", guard=True)
    return g.add_ratio(
        guarded, "fallback", "ipkm", "absent", guard=True, without_denominator="numerator"
    )


@query(
    "handle_missing_drop",
    with_views(
        "SELECT * FROM gappy_orders WHERE status IS NOT NULL AND amount IS NOT NULL",
        "gappy_orders",
    ),
)
def _handle_missing_drop(t: Tables) -> DataFrame:
    return g.handle_missing(view(t, "gappy_orders"))


@query(
    "handle_missing_fill",
    with_views(
        "SELECT o_orderkey, coalesce(status, 'none') AS status, coalesce(amount, 0.5) AS amount "
        "FROM gappy_orders",
        "gappy_orders",
    ),
)
def _handle_missing_fill(t: Tables) -> DataFrame:
    return g.handle_missing(view(t, "gappy_orders"), "fill", {"status": "none", "amount": 0.5})


# ---------------------------------------------------------------- row repair


@query(
    "unpack_delimited",
    with_views(
        "SELECT "
        + ", ".join(
            f"list_extract(string_split(\"{INDEX_HEADER}\", ';'), {at + 1}) AS {name}"
            for name, at in presets.PACKED_INDEX.items()
        )
        + " FROM raw_index",
        "raw_index",
    ),
)
def _unpack_delimited(t: Tables) -> DataFrame:
    return g.unpack_delimited(view(t, "raw_index"), INDEX_HEADER, ";", presets.PACKED_INDEX)


REPAIR_SQL = (
    "SELECT komoditas, tanggal, harga_pangan FROM raw_price WHERE tanggal IS NOT NULL UNION ALL "
    "SELECT regexp_extract(komoditas, '^([^,]+)', 1), regexp_extract(komoditas, ',([0-9/]+),', 1), "
    "regexp_extract(komoditas, ',\"([0-9,]+)\"', 1) FROM raw_price "
    "WHERE tanggal IS NULL AND contains(komoditas, ',') "
    "AND regexp_extract(komoditas, '^([^,]+)', 1) <> ''"
)


@query("repair_rows", with_views(REPAIR_SQL, "raw_price"))
def _repair_rows(t: Tables) -> DataFrame:
    raw = view(t, "raw_price")
    return g.repair_rows(raw, "komoditas", "tanggal", presets.PACKED_PRICE)


# ---------------------------------------------------------------- files and tables


@query(
    "csv_roundtrip",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, "
    "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice, "
    "'line one' || chr(10) || o_orderpriority AS note FROM orders",
)
def _csv_roundtrip(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("o_totalprice"),
        F.concat(F.lit("line one\n"), F.col("o_orderpriority")).alias("note"),
    )
    path = scratch.write_csv(rows, scratch.folder(t.spark, "csv_roundtrip"), ";")
    return g.read_delimited(t.spark, path, ";", multi_line=True)


MULTI_LINE = {
    "l_orderkey": "CAST(l_orderkey AS STRING)",
    "l_linenumber": "CAST(l_linenumber AS STRING)",
    "note": "'part ' || CAST(l_partkey AS STRING) || '\n' || 'of ' || CAST(l_suppkey AS STRING)",
    "remark": "'say \"' || l_returnflag || '\",\n\nthen; ' || l_linestatus",
    "amount": "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING)",
}


@query(
    "csv_multiline_split",
    "SELECT " + ", ".join(f"{text.replace(chr(92) + 'n', chr(10))} AS {name}" for name, text in MULTI_LINE.items()) + " FROM lineitem",
)
def _csv_multiline_split(t: Tables) -> DataFrame:
    """Every record spans four lines; files are read in splits, which cut records anywhere."""
    rows = t.lineitem.select(*[F.expr(text).alias(name) for name, text in MULTI_LINE.items()])
    path = scratch.write_csv(rows, scratch.folder(t.spark, "csv_multiline_split"), ";")
    return g.read_records(t.spark, path, ";")


@query(
    "table_years_replaced",
    with_views(
        "SELECT kabupaten_kota, komoditas, CASE WHEN tahun = 2000 THEN 2 * konsumsi_per_kapita "
        "ELSE konsumsi_per_kapita END AS konsumsi_per_kapita, tahun FROM consumption WHERE tahun <> 1999 OR komoditas <> ' '",
        "consumption",
    ),
)
def _table_years_replaced(t: Tables) -> DataFrame:
    """A table of all years, of which two are written anew; the others stay as they were."""
    frame = view(t, "consumption")
    path = scratch.folder(t.spark, "table_years_replaced")
    g.write_table(frame, path, "tahun")
    name = f"{scratch.database(t.spark)}.consumption"
    g.register_table(t.spark, name, frame.schema, path, ["tahun"])
    doubled = F.when(F.col("tahun") == 2000, 2 * F.col("konsumsi_per_kapita")).otherwise(F.col("konsumsi_per_kapita"))
    anew = frame.filter("tahun = 2000 OR tahun = 1999 AND komoditas <> ' '").withColumn("konsumsi_per_kapita", doubled)
    g.write_table(anew, path, "tahun", only_present=True)
    g.register_table(t.spark, name, frame.schema, path, ["tahun"])
    return t.spark.table(name)


@query(
    "csv_inferred_schema",
    "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_totalprice, o_orderpriority FROM orders",
)
def _csv_inferred_schema(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = scratch.write_csv(rows, scratch.folder(t.spark, "csv_inferred_schema"), ",")
    return g.read_delimited(t.spark, path, infer_schema=True)


@query(
    "csv_source_spec",
    with_views(
        "SELECT TANGGAL AS hari, NULLIF(suhu, '-') AS suhu, "
        "NULLIF(NULLIF(curah_hujan, '-'), '') AS curah_hujan FROM raw_weather",
        "raw_weather",
    ),
)
def _csv_source_spec(t: Tables) -> DataFrame:
    path = scratch.folder(t.spark, "csv_source_spec")
    scratch.write_csv(view(t, "raw_weather"), path, ";")
    spec = g.SourceSpec(
        "weather", ";", renames={"TANGGAL": "hari", "absent": "x"}, options={"nullValue": "-"}
    )
    read = g.read_source(t.spark, path, spec)
    return read.withColumns({name: F.nullif(name, F.lit("")) for name in ("suhu", "curah_hujan")})


@query(
    "csv_corrupt_rows",
    "SELECT CAST(s_suppkey AS VARCHAR) || ',' || s_name || ',extra' AS line, "
    "'corrupt' AS kind FROM supplier WHERE s_suppkey % 5 = 0 UNION ALL "
    "SELECT CAST(s_suppkey AS VARCHAR) || ',' || s_name, 'good' FROM supplier "
    "WHERE s_suppkey % 5 <> 0",
)
def _csv_corrupt_rows(t: Tables) -> DataFrame:
    line = F.concat_ws(
        ",", "s_suppkey", "s_name", F.when(F.col("s_suppkey") % 5 == 0, F.lit("extra"))
    )
    path = scratch.write_text(t.supplier.select(line), "csv_corrupt_rows")
    schema = T.StructType(
        [T.StructField("key", T.StringType()), T.StructField("name", T.StringType())]
    )
    read = g.read_delimited(
        t.spark, path, schema=schema, header=False, corrupt_column="_corrupt_record"
    )
    good, bad = g.split_corrupt(read)
    return good.select(F.concat_ws(",", "key", "name").alias("line"), F.lit("good").alias("kind")).unionByName(
        bad.select(F.col("_corrupt_record").alias("line"), F.lit("corrupt").alias("kind"))
    )


@query(
    "csv_unclosed_quote",
    "SELECT CASE WHEN s_suppkey % 4 = 0 THEN chr(34) ELSE '' END || CAST(s_suppkey AS VARCHAR) || "
    "',' || s_name AS line, CASE WHEN s_suppkey % 4 = 0 THEN 'corrupt' ELSE 'good' END AS kind "
    "FROM supplier",
)
def _csv_unclosed_quote(t: Tables) -> DataFrame:
    """A quote left open ends with its line, which is kept whole, and harms no other line."""
    quote = F.when(F.col("s_suppkey") % 4 == 0, F.lit('"')).otherwise("")
    line = F.concat(quote, F.concat_ws(",", "s_suppkey", "s_name"))
    path = scratch.write_text(t.supplier.select(line), "csv_unclosed_quote")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in ("key", "name")])
    read = g.read_delimited(t.spark, path, schema=schema, header=False, corrupt_column="_bad")
    good, bad = g.split_corrupt(read, "_bad")
    sound = good.select(F.concat_ws(",", "key", "name").alias("line"), F.lit("good").alias("kind"))
    return sound.unionByName(bad.select(F.col("_bad").alias("line"), F.lit("corrupt").alias("kind")))


@query("parquet_partition_roundtrip", with_views("SELECT * FROM price", "price"))
def _parquet_partition_roundtrip(t: Tables) -> DataFrame:
    frame = view(t, "price")
    path = scratch.folder(t.spark, "parquet_partition_roundtrip")
    g.write_table(frame, path, "tahun")
    return t.spark.read.schema(frame.schema).parquet(path)


@query(
    "orc_partition_roundtrip",
    with_views("SELECT * FROM weather", "weather"),
)
def _orc_partition_roundtrip(t: Tables) -> DataFrame:
    frame = view(t, "weather")
    path = scratch.folder(t.spark, "orc_partition_roundtrip")
    g.write_table(frame, path, ["tahun"], fmt="orc")
    return t.spark.read.schema(frame.schema).orc(path)


@query("register_external_table", with_views("SELECT * FROM index", "index"))
def _register_external_table(t: Tables) -> DataFrame:
    frame = view(t, "index")
    path = scratch.folder(t.spark, "register_external_table")
    g.write_table(frame, path, "tahun")
    name = f"{scratch.database(t.spark)}.index_mart"
    g.register_table(t.spark, name, frame.schema, path, ["tahun"])
    return t.spark.table(name)


@query(
    "table_counts",
    with_views(
        "SELECT 'prices' AS \"table\", count(*) AS rows FROM price UNION ALL "
        "SELECT 'rain', count(*) FROM weather",
        "price",
        "weather",
    ),
)
def _table_counts(t: Tables) -> DataFrame:
    database = scratch.database(t.spark)
    for name, source, fmt in (("prices", "price", "parquet"), ("rain", "weather", "orc")):
        frame = view(t, source)
        path = scratch.folder(t.spark, name)
        g.write_table(frame, path, "tahun", fmt=fmt)
        g.register_table(t.spark, f"{database}.{name}", frame.schema, path, ["tahun"], fmt=fmt)
    return g.table_counts(t.spark, database)


@query("load_optional_table", "SELECT n_name, CAST(1 AS INTEGER) AS found FROM nation")
def _load_optional_table(t: Tables) -> DataFrame:
    t.nation.createOrReplaceTempView("granary_nations")
    present = g.load_table(t.spark, "granary_nations")
    absent = g.load_table(t.spark, "granary_absent", required=False)
    return present.select("n_name", F.lit(1 if absent is None else 2).alias("found"))


# ---------------------------------------------------------------- filters

FILTERS = {
    "production": (
        presets.RULES["produksi_pangan"],
        "produksi > 0 AND produksi <= 1000000 AND luas_panen > 0 AND tahun BETWEEN 2000 AND 2030 "
        "AND kabupaten_kota IS NOT NULL",
    ),
    "price": (
        (
            presets.Rule("harga_produsen", low=0, low_open=True, high=300_000),
            presets.YEARS,
            presets.Rule("komoditas"),
        ),
        "harga_produsen > 0 AND harga_produsen <= 300000 AND tahun BETWEEN 2000 AND 2030 "
        "AND komoditas IS NOT NULL",
    ),
    "weather": (
        (
            presets.YEARS,
            presets.Rule("kabupaten_kota"),
            presets.Rule("curah_hujan", low=5, nullable=True),
            presets.Rule("suhu_rata_rata", low=-50, high=60, nullable=True),
        ),
        "tahun BETWEEN 2000 AND 2030 AND (curah_hujan IS NULL OR curah_hujan >= 5) "
        "AND (suhu_rata_rata IS NULL OR suhu_rata_rata BETWEEN -50 AND 60)",
    ),
    "social": (
        presets.RULES["sosial_ekonomi"],
        "tahun BETWEEN 2000 AND 2030 AND kabupaten_kota IS NOT NULL AND jumlah_penduduk > 0 "
        "AND tingkat_kemiskinan BETWEEN 0 AND 100 AND ipkm > 0",
    ),
    "consumption": (
        presets.RULES["konsumsi_pangan"],
        "tahun BETWEEN 2000 AND 2030 AND trim(kabupaten_kota) <> '' AND trim(komoditas) <> '' "
        "AND konsumsi_per_kapita >= 0",
    ),
    "index": (
        presets.RULES["ikp"],
        "tahun BETWEEN 2000 AND 2030 AND trim(kabupaten_kota) <> '' "
        "AND skor_ikp BETWEEN 0 AND 100 AND kategori_ikp BETWEEN 1 AND 6",
    ),
}

for _name, (_rules, _where) in FILTERS.items():

    @query(f"filter_{_name}", with_views(f"SELECT * FROM {_name} WHERE {_where}", _name))
    def _filter(t: Tables, name=_name, rules=_rules) -> DataFrame:
        return g.keep_valid(view(t, name), rules)


# The presets' own rules where a cleaner applies them, before columns get their final names.
PRESET_FILTERS = {
    "price": (
        "harga_pangan",
        {"harga_pangan": "harga_produsen * 10000"},
        "harga_pangan > 0 AND harga_pangan <= 1000000000 AND tahun BETWEEN 2000 AND 2030 "
        "AND komoditas IS NOT NULL",
    ),
    "weather": (
        "cuaca",
        {"curah_hujan": "curah_hujan - 3"},
        "tahun BETWEEN 2000 AND 2030 AND kabupaten_kota IS NOT NULL AND (curah_hujan IS NULL OR "
        "curah_hujan >= 0) AND (suhu_rata_rata IS NULL OR suhu_rata_rata BETWEEN -50 AND 60)",
    ),
}


def _shifted(name: str, changes: Mapping[str, str]) -> str:
    cells = [f"{expression} AS {column}" for column, expression in changes.items()]
    kept = [c for c in VIEWS[name].columns if c not in changes]
    return f"SELECT {', '.join([*kept, *cells])} FROM {name}"


for _name, (_dataset, _changes, _where) in PRESET_FILTERS.items():

    @query(
        f"filter_{_name}_preset",
        with_views(f"SELECT * FROM ({_shifted(_name, _changes)}) WHERE {_where}", _name),
    )
    def _filter_preset(t: Tables, name=_name, dataset=_dataset, changes=_changes) -> DataFrame:
        shifted = view(t, name).withColumns({c: F.expr(e) for c, e in changes.items()})
        return g.keep_valid(shifted, presets.RULES[dataset])


BLANK_COLUMNS = ["Tahun", "Jumlah_Penduduk", "Persentase_miskin"]


@query(
    "drop_blank_rows",
    with_views(
        "SELECT * FROM raw_social WHERE "
        + " AND ".join(f"{name} IS NOT NULL AND trim({name}) <> ''" for name in BLANK_COLUMNS),
        "raw_social",
    ),
)
def _drop_blank_rows(t: Tables) -> DataFrame:
    return g.drop_blank_rows(view(t, "raw_social"), BLANK_COLUMNS)


REJECTS = {
    "tahun >= 2000 <= 2030 not null": "NOT coalesce(tahun BETWEEN 2000 AND 2030, false)",
    "curah_hujan >= 5 or null": "curah_hujan < 5",
    "suhu_rata_rata >= -50 <= 60 or null": "NOT coalesce(suhu_rata_rata BETWEEN -50 AND 60, true)",
    "kabupaten_kota not null": "kabupaten_kota IS NULL",
}


def counts_sql(source: str, predicates: Mapping[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric, count(*) FILTER ({predicate}) AS rows FROM {source}"
        for name, predicate in predicates.items()
    )


@query("reject_counts", with_views(counts_sql("weather", REJECTS), "weather"))
def _reject_counts(t: Tables) -> DataFrame:
    return g.reject_counts(view(t, "weather"), FILTERS["weather"][0])


METRICS = {
    "production": (
        "produksi_pangan",
        {"suspicious_productivity": "produktivitas_per_ha <= 0 OR produktivitas_per_ha > 100"},
    ),
    "price": (
        "harga_pangan",
        {
            "zero_prices": "harga_produsen <= 0 OR harga_konsumen <= 0",
            "high_prices": "harga_produsen > 500000",
        },
    ),
    "weather": (
        "cuaca",
        {
            "null_rainfall": "curah_hujan IS NULL",
            "null_temperature": "suhu_rata_rata IS NULL",
            "extreme_rainfall": "curah_hujan > 500",
        },
    ),
    "social": (
        "sosial_ekonomi",
        {
            "high_poverty": "tingkat_kemiskinan > 30",
            "low_population": "jumlah_penduduk < 100000",
            "extreme_spending": "ipkm > 5000000",
        },
    ),
    "consumption": (
        "konsumsi_pangan",
        {
            "zero_consumption": "konsumsi_per_kapita = 0",
            "high_consumption": "konsumsi_per_kapita > 500",
            "extreme_consumption": "konsumsi_per_kapita > 1000",
        },
    ),
    "index": (
        "ikp",
        {
            "low_index": "skor_ikp < 60",
            "high_index": "skor_ikp > 80",
            **{f"category_{n}": f"kategori_ikp = {n}" for n in range(1, 7)},
        },
    ),
}
PER_HECTARE = "(SELECT *, produksi / luas_panen AS produktivitas_per_ha FROM production)"

for _name, (_dataset, _predicates) in METRICS.items():
    _source = PER_HECTARE if _name == "production" else _name

    @query(f"metric_counts_{_name}", with_views(counts_sql(_source, _predicates), _name))
    def _metric_counts(t: Tables, name=_name, dataset=_dataset) -> DataFrame:
        frame = view(t, name)
        if name == "production":
            frame = g.add_ratio(frame, "produktivitas_per_ha", "produksi", "luas_panen")
        return g.metric_counts(frame, presets.DATASETS[dataset].gate.counts())


# ---------------------------------------------------------------- deduplication


@query("dedupe_rows", with_views("SELECT DISTINCT * FROM doubled_lines", "doubled_lines"))
def _dedupe_rows(t: Tables) -> DataFrame:
    return g.dedupe(view(t, "doubled_lines"))


LINE_KEYS = ["l_orderkey", "l_linenumber"]


@query(
    "dedupe_keys",
    with_views(
        "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag FROM "
        "(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        "ORDER BY l_partkey, l_suppkey, l_quantity, l_returnflag) AS place FROM doubled_lines) "
        "WHERE place = 1",
        "doubled_lines",
    ),
)
def _dedupe_keys(t: Tables) -> DataFrame:
    return g.dedupe(view(t, "doubled_lines"), LINE_KEYS)


@query(
    "distinct_regions",
    with_views("SELECT DISTINCT kabupaten_kota FROM production", "production"),
)
def _distinct_regions(t: Tables) -> DataFrame:
    return g.dedupe(view(t, "production").select("kabupaten_kota"))


@query("rows_across_runs", with_views("SELECT DISTINCT * FROM doubled_lines", "doubled_lines"))
def _rows_across_runs(t: Tables) -> DataFrame:
    """Two runs, of whose rows the second one brings many that the first one stored."""
    lines, path = view(t, "doubled_lines"), scratch.folder(t.spark, "rows_across_runs")
    g.append_new(lines.filter("l_linenumber <= 4"), path)
    g.append_new(lines.filter("l_linenumber >= 3"), path)
    return g.stored_rows(t.spark, path)


# ---------------------------------------------------------------- summaries and joins

AGG_SQL = {
    "production": "sum(produksi) AS total_produksi, avg(produktivitas) AS avg_produktivitas, "
    "sum(luas_panen) AS total_luas_panen, count(komoditas) AS jenis_komoditas",
    "price": "avg(harga_produsen) AS avg_harga_produsen, avg(harga_konsumen) AS avg_harga_konsumen",
    "weather": "avg(curah_hujan) AS avg_curah_hujan, avg(suhu_rata_rata) AS avg_suhu",
    "consumption": "sum(konsumsi_per_kapita) AS total_konsumsi_per_kapita",
    "index": "avg(skor_ikp) AS skor_ikp, avg(kategori_ikp) AS kategori_ikp",
}
SOURCE_NAMES = {
    "price": "harga_pangan",
    "weather": "cuaca",
    "social": "sosial_ekonomi",
    "consumption": "konsumsi_pangan",
    "index": "ikp",
}


def measures(name: str) -> list[str]:
    """The summed or averaged columns of a source, which need rounding."""
    aggs = presets.PRODUCTION_AGGS if name == "production" else presets.SOURCE_AGGS[SOURCE_NAMES[name]]
    return [agg.alias for agg in aggs if agg.function in ("sum", "avg")]


def grouped_sql(name: str) -> str:
    return f"SELECT kabupaten_kota, tahun, {AGG_SQL[name]} FROM {name} GROUP BY ALL"


def with_rounding(sql: str, columns: Sequence[str]) -> str:
    return f"SELECT * REPLACE ({rounded_sql(*columns)}) FROM ({sql})"


@query(
    "agg_production",
    with_views(with_rounding(grouped_sql("production"), measures("production")), "production"),
)
def _agg_production(t: Tables) -> DataFrame:
    return rounded(presets.production_summary(view(t, "production")), *measures("production"))


@query(
    "agg_production_distinct",
    with_views(
        "SELECT kabupaten_kota, tahun, count(DISTINCT komoditas) AS jenis_komoditas "
        "FROM production GROUP BY ALL",
        "production",
    ),
)
def _agg_production_distinct(t: Tables) -> DataFrame:
    summary = presets.production_summary(view(t, "production"), distinct_items=True)
    return summary.select(*KEYS, "jenis_komoditas")


@query(
    "agg_production_through",
    with_views(with_rounding(grouped_sql("production"), measures("production")), "production"),
)
def _agg_production_through(t: Tables) -> DataFrame:
    return rounded(_production_through(t), *measures("production"))


def _production_through(t: Tables) -> DataFrame:
    """The production summary straight from the lines, aggregated per supplier before the join."""
    lines = t.lineitem.select(
        F.col("l_suppkey").alias("supplier"),
        F.expr("CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag || l_linestatus END").alias(
            "komoditas"
        ),
        F.expr("l_quantity * 4").alias("produksi"),
        F.expr("l_extendedprice / 1001").alias("luas_panen"),
        F.expr("l_quantity * 4 / (l_extendedprice / 1001) + l_tax * 1.9").alias("produktivitas"),
        F.expr("cast(year(l_shipdate) + 3 as int)").alias("tahun"),
    )
    home = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("supplier"), F.col("n_name").alias("kabupaten_kota")
    )
    return g.summarize_through(lines, home, "supplier", KEYS, presets.PRODUCTION_AGGS)


for _name in ("price", "weather", "consumption", "index"):

    @query(f"agg_{_name}", with_views(with_rounding(grouped_sql(_name), measures(_name)), _name))
    def _agg(t: Tables, name=_name) -> DataFrame:
        summary = g.summarize(view(t, name), KEYS, presets.SOURCE_AGGS[SOURCE_NAMES[name]])
        return rounded(summary, *measures(name))


def joined_sql(*names: str, keys: str = "kabupaten_kota, tahun") -> str:
    sql = f"SELECT * FROM ({grouped_sql('production')}) AS base"
    for name in names:
        source = name if name == "social" else f"({grouped_sql(name)})"
        sql += f" LEFT JOIN {source} AS {name}_side USING ({keys})"
    return sql


for _name in SOURCE_NAMES:

    @query(
        f"join_{_name}",
        with_views(
            with_rounding(
                joined_sql(_name),
                measures("production") + ([] if _name == "social" else measures(_name)),
            ),
            "production",
            _name,
        ),
    )
    def _join(t: Tables, name=_name) -> DataFrame:
        base = presets.production_summary(view(t, "production"))
        aggs = presets.SOURCE_AGGS[SOURCE_NAMES[name]]
        joined = g.enrich(base, [g.Enrichment(name, view(t, name), KEYS, aggs)])
        return rounded(joined, *measures("production"), *([] if name == "social" else measures(name)))


@query(
    "join_social_heavy",
    with_views(
        with_rounding(
            f"SELECT * FROM ({grouped_sql('production')}) AS base LEFT JOIN heavy_social USING (kabupaten_kota, tahun)",
            measures("production"),
        ),
        "production",
        "heavy_social",
    ),
)
def _join_social_heavy(t: Tables) -> DataFrame:
    base = presets.production_summary(view(t, "production"))
    return rounded(g.join_heavy(base, view(t, "heavy_social"), KEYS), *measures("production"))


@query(
    "join_by_year",
    with_views(
        with_rounding(
            f"SELECT * FROM ({grouped_sql('production')}) LEFT JOIN "
            f"(SELECT tahun, {AGG_SQL['weather']} FROM weather GROUP BY ALL) USING (tahun)",
            measures("production") + measures("weather"),
        ),
        "production",
        "weather",
    ),
)
def _join_by_year(t: Tables) -> DataFrame:
    base = presets.production_summary(view(t, "production"))
    source = g.Enrichment("cuaca", view(t, "weather"), ["tahun"], presets.SOURCE_AGGS["cuaca"])
    return rounded(g.enrich(base, [source]), *measures("production"), *measures("weather"))


@query(
    "repeated_keys",
    with_views(
        "SELECT kabupaten_kota, tahun, count(*) AS rows FROM social GROUP BY ALL "
        "HAVING count(*) > 1",
        "social",
    ),
)
def _repeated_keys(t: Tables) -> DataFrame:
    return g.repeated_keys(view(t, "social"), KEYS)


# ---------------------------------------------------------------- cleaners, end to end


def text_sql(column: str) -> str:
    return rf"regexp_replace(regexp_replace({column}, '[^a-zA-Z0-9\s]', '', 'g'), '\s+', ' ', 'g')"


def marked_sql(column: str) -> str:
    return f"CASE WHEN {column} IN ('#N/A', '8888', '9999', '-') THEN NULL ELSE {column} END"


def year_sql(column: str) -> str:
    return f"CAST(TRY_CAST({column} AS DOUBLE) AS INTEGER)"


SILVER_SQL = {
    "production": "SELECT DISTINCT kabupaten_kota, komoditas, produksi, luas_panen, produktivitas, "
    "round(produksi / luas_panen, 4) AS produktivitas_per_ha, tahun FROM ("
    f"SELECT trim({text_sql(marked_sql('kabupaten_kota'))}) AS kabupaten_kota, "
    f"{text_sql(marked_sql('komoditas'))} AS komoditas, "
    f"TRY_CAST({marked_sql('produksi')} AS DOUBLE) AS produksi, "
    f"TRY_CAST({marked_sql('luas_panen')} AS DOUBLE) AS luas_panen, "
    f"TRY_CAST(NULLIF({marked_sql('produktivitas')}, '') AS DOUBLE) AS produktivitas, "
    f"{year_sql(marked_sql('tahun'))} AS tahun FROM raw_production) "
    "WHERE produksi > 0 AND produksi <= 1000000 AND luas_panen > 0 "
    "AND kabupaten_kota IS NOT NULL AND tahun BETWEEN 2000 AND 2030",
    "price": "SELECT DISTINCT 'Lampung' AS kabupaten_kota, komoditas, price AS harga_produsen, "
    "price AS harga_konsumen, tahun, tanggal FROM ("
    f"SELECT {text_sql(marked_sql('komoditas'))} AS komoditas, {marked_sql('tanggal')} AS tanggal, "
    f"TRY_CAST(NULLIF(trim(replace(replace({marked_sql('harga_pangan')}, '\"', ''), ',', '')), '') "
    "AS DOUBLE) AS price, CAST(year(CASE WHEN regexp_full_match(tanggal, '\\d{2}/\\d{2}/\\d{4}') "
    f"THEN try_strptime(tanggal, '%d/%m/%Y') END) AS INTEGER) AS tahun FROM ({REPAIR_SQL})) "
    "WHERE price > 0 AND price <= 1000000000 AND komoditas IS NOT NULL "
    "AND tahun BETWEEN 2000 AND 2030",
    "weather": "SELECT DISTINCT 'Lampung' AS kabupaten_kota, curah_hujan, suhu_rata_rata, "
    "NULL::DOUBLE AS kelembaban, tahun, tanggal FROM ("
    f"SELECT NULLIF(TRY_CAST(NULLIF({marked_sql('curah_hujan')}, '') AS DOUBLE), 8888) AS curah_hujan, "
    f"TRY_CAST({marked_sql('suhu')} AS DOUBLE) AS suhu_rata_rata, TANGGAL AS tanggal, "
    "CAST(year(try_strptime(TANGGAL, '%d-%m-%Y')) AS INTEGER) AS tahun FROM raw_weather) "
    "WHERE tahun BETWEEN 2000 AND 2030 AND (curah_hujan IS NULL OR curah_hujan >= 0) "
    "AND (suhu_rata_rata IS NULL OR suhu_rata_rata BETWEEN -50 AND 60)",
    "social": "SELECT DISTINCT kabupaten_kota, jumlah_penduduk, tingkat_kemiskinan, ipkm, tahun "
    f"FROM (SELECT trim({text_sql(marked_sql('\"Kabupaten/Kota\"'))}) AS kabupaten_kota, "
    f"{year_sql(marked_sql('Jumlah_Penduduk'))} AS jumlah_penduduk, "
    f"TRY_CAST({marked_sql('Persentase_miskin')} AS DOUBLE) AS tingkat_kemiskinan, "
    f"TRY_CAST({marked_sql('pengeluaran_per_kapita')} AS DOUBLE) AS ipkm, "
    f"{year_sql(marked_sql('Tahun'))} AS tahun FROM raw_social "
    "WHERE trim(Tahun) <> '' AND trim(Jumlah_Penduduk) <> '' AND trim(Persentase_miskin) <> '') "
    "WHERE tahun BETWEEN 2000 AND 2030 AND jumlah_penduduk > 0 "
    "AND tingkat_kemiskinan BETWEEN 0 AND 100 AND ipkm > 0",
    "consumption": "SELECT DISTINCT kabupaten_kota, komoditas, konsumsi_per_kapita, tahun FROM ("
    f"SELECT trim({text_sql(marked_sql('Kabupaten_Kota'))}) AS kabupaten_kota, "
    f"{text_sql(marked_sql('Komoditas'))} AS komoditas, "
    f"TRY_CAST(replace({marked_sql('\"Konsumsi Pangan\"')}, ',', '.') AS DOUBLE) "
    f"AS konsumsi_per_kapita, {year_sql(marked_sql('Tahun'))} AS tahun FROM raw_consumption) "
    "WHERE tahun BETWEEN 2000 AND 2030 AND kabupaten_kota <> '' AND trim(komoditas) <> '' "
    "AND konsumsi_per_kapita >= 0",
    "index": "SELECT DISTINCT kabupaten_kota, skor_ikp, kategori_ikp, tahun FROM ("
    f"SELECT trim({text_sql('part[4]')}) AS kabupaten_kota, {year_sql('part[7]')} AS tahun, "
    f"TRY_CAST(part[8] AS DOUBLE) AS skor_ikp, {year_sql('part[10]')} AS kategori_ikp FROM "
    f"(SELECT string_split(\"{INDEX_HEADER}\", ';') AS part FROM raw_index)) "
    "WHERE tahun BETWEEN 2000 AND 2030 AND kabupaten_kota <> '' "
    "AND skor_ikp BETWEEN 0 AND 100 AND kategori_ikp BETWEEN 1 AND 6",
}
DATASET_NAMES = {"production": "produksi_pangan", **SOURCE_NAMES}

for _name, _sql in SILVER_SQL.items():

    @query(f"silver_{_name}", with_views(_sql, f"raw_{_name}"))
    def _silver(t: Tables, name=_name) -> DataFrame:
        return presets.DATASETS[DATASET_NAMES[name]].clean(view(t, f"raw_{name}"))


def _raw_file(
    t: Tables, name: str, folder: str | None = None, path: str | None = None, mode: str = "error"
) -> str:
    """The raw view as a delimited file in the layout of its source."""
    raw = view(t, f"raw_{name}").withColumnsRenamed({"harga_pangan": "harga pangan"})
    source = presets.SOURCES[DATASET_NAMES[name]]
    path = path or (f"{folder}/{source.name}.csv" if folder else scratch.folder(t.spark, source.name))
    return scratch.write_csv(raw, path, source.separator, mode)


for _name, _sql in SILVER_SQL.items():

    @query(f"csv_silver_{_name}", with_views(_sql, f"raw_{_name}"))
    def _csv_silver(t: Tables, name=_name) -> DataFrame:
        dataset = presets.DATASETS[DATASET_NAMES[name]]
        return dataset.clean(g.read_source(t.spark, _raw_file(t, name), dataset.source))


# Prices of these lines are written without quotes, so that they have a field too many.
for _name, _sql in SILVER_SQL.items():

    @query(f"stream_silver_{_name}", with_views(_sql, f"raw_{_name}"))
    def _stream_silver(t: Tables, name=_name) -> DataFrame:
        """The files arrive twice, in several batches; what came before is not written again."""
        source, dataset = _raw_file(t, name), DATASET_NAMES[name]
        path, checkpoint = (scratch.folder(t.spark, f"stream_{name}_{part}") for part in ("table", "state"))
        stream_silver(t.spark, dataset, source, path, checkpoint, files_per_batch=4)
        _raw_file(t, name, mode="append", path=source)
        stream_silver(t.spark, dataset, source, path, checkpoint)
        return t.spark.read.parquet(path).select(*presets.SILVER_SCHEMAS[dataset].names)


OVERLONG = "tanggal IS NOT NULL AND komoditas LIKE '1%' AND harga_pangan LIKE '_%,___' AND harga_pangan NOT LIKE '%\"%'"


@query(
    "csv_silver_price_corrupt",
    "WITH whole AS (" + VIEWS["raw_price"].sql + "), "
    f"raw_price AS (SELECT * FROM whole WHERE NOT coalesce({OVERLONG}, false)) {SILVER_SQL['price']}",
)
def _csv_silver_price_corrupt(t: Tables) -> DataFrame:
    """Sound, packed and over-long price lines; the last hold no price."""
    raw = view(t, "raw_price")
    quoted = F.concat(F.lit('"'), F.regexp_replace("harga_pangan", '"', '""'), F.lit('"'))
    price = F.when(F.expr(OVERLONG), F.col("harga_pangan")).otherwise(quoted)
    sound = F.concat_ws(",", "komoditas", F.coalesce("tanggal", F.lit("")), F.coalesce(price, F.lit("")))
    packed = F.concat(F.lit('"'), F.regexp_replace("komoditas", '"', '""'), F.lit('"'))
    line = F.when(F.col("komoditas").contains(","), packed).otherwise(sound)
    path = scratch.write_text(raw.select(line), "csv_silver_price_corrupt")
    source = presets.SOURCES["harga_pangan"]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in source.columns])
    dataset = presets.DATASETS["harga_pangan"]
    return dataset.clean(g.read_source(t.spark, path, source, schema=schema, header=False))


# Which rows of a raw view are written with a field too many and with one too few.
WRONG_SHAPES = {
    "production": ("produktivitas LIKE '%7'", "produktivitas LIKE '%3'"),
    "weather": ("suhu LIKE '%1'", "suhu LIKE '%3'"),
    "social": ("Jumlah_Penduduk LIKE '%7'", "Jumlah_Penduduk LIKE '%3'"),
    "consumption": ("Komoditas LIKE '1%'", "Komoditas LIKE '3%'"),
    "index": (f"\"{INDEX_HEADER}\" LIKE '1%'", f"\"{INDEX_HEADER}\" LIKE '3%'"),
}


def _misshapen_file(t: Tables, name: str) -> tuple[presets.Dataset, DataFrame]:
    """A raw view as a file in which the rows above have wrong shapes, read as its source says."""
    raw, source = view(t, f"raw_{name}"), presets.SOURCES[DATASET_NAMES[name]]
    surplus, short = (F.expr(f"coalesce({test.replace(chr(34), chr(96))}, false)") for test in WRONG_SHAPES[name])
    cells = [F.coalesce(F.col(f"`{column}`"), F.lit("")) for column in raw.columns]
    if name == "index":
        line = F.when(surplus, F.concat(F.lit("0;"), cells[0])).when(short, F.regexp_replace(cells[0], ";[^;]*$", ""))
        line = F.concat(F.lit('"'), line.otherwise(cells[0]), F.lit('"'))
        header = f'"{raw.columns[0]}"'
    else:
        quoted = [F.when(cell.rlike("[\";]|^ "), F.concat(F.lit('"'), cell, F.lit('"'))).otherwise(cell) for cell in cells]
        first = F.concat_ws(";", *quoted[:-1])
        # The surplus field stands before the last one, which it would shift out.
        line = F.when(surplus, F.concat_ws(";", first, F.lit("1"), quoted[-1])).when(short, first)
        line = line.otherwise(F.concat_ws(";", *quoted))
        header = ";".join(raw.columns)
    path = scratch.write_text(raw.select(line), f"csv_silver_{name}_corrupt")
    names = header.strip('"').split(";") if name != "index" else [header.strip('"')]
    schema = T.StructType([T.StructField(column, T.StringType()) for column in names])
    return presets.DATASETS[DATASET_NAMES[name]], g.read_source(t.spark, path, source, schema=schema, header=False)


for _name, (_surplus, _short) in WRONG_SHAPES.items():

    @query(
        f"csv_silver_{_name}_corrupt",
        f"WITH whole AS ({VIEWS[f'raw_{_name}'].sql}), raw_{_name} AS (SELECT * FROM whole "
        f"WHERE NOT coalesce({_surplus}, false) AND NOT coalesce({_short}, false)) {SILVER_SQL[_name]}",
    )
    def _csv_silver_corrupt(t: Tables, name=_name) -> DataFrame:
        dataset, raw = _misshapen_file(t, name)
        return dataset.clean(raw)


def _wrong_sql(name: str) -> str:
    tests = " OR ".join(f"coalesce({test}, false)" for test in WRONG_SHAPES[name])
    if name == "index":
        tests += f" OR len(string_split(\"{INDEX_HEADER}\", ';')) <> 10"
    return f"SELECT '{DATASET_NAMES[name]}' AS dataset, count(*) AS rows_in, count(*) FILTER ({tests}) AS corrupt_rows FROM raw_{name}"


@query("csv_corrupt_counts", with_views(" UNION ALL ".join(map(_wrong_sql, WRONG_SHAPES)), *[f"raw_{name}" for name in WRONG_SHAPES]))
def _csv_corrupt_counts(t: Tables) -> DataFrame:
    """Lines of the wrong shape in five raw files, as a run counts them."""
    counts = []
    for name in WRONG_SHAPES:
        dataset, raw = _misshapen_file(t, name)
        corrupt = F.count(F.when(dataset.corrupt(raw), 1)).alias("corrupt_rows")
        counts.append(raw.agg(F.lit(DATASET_NAMES[name]).alias("dataset"), F.count("*").alias("rows_in"), corrupt))
    return reduce(DataFrame.unionByName, counts)


# ---------------------------------------------------------------- marts

SCORE_SQL = (
    "CAST(CASE WHEN total_produksi > 50000 THEN 80 WHEN total_produksi > 20000 THEN 60 ELSE 40 END "
    "AS INTEGER)"
)
LABEL_SQL = (
    "CASE WHEN skor_ketersediaan >= 70 THEN 'Tahan' WHEN skor_ketersediaan >= 50 THEN 'Sedang' "
    "ELSE 'Rentan' END"
)


def scored_sql(sql: str, per_capita: str) -> str:
    scored = (
        f"SELECT *, {per_capita} AS produksi_per_kapita, {SCORE_SQL} AS skor_ketersediaan "
        f"FROM ({sql})"
    )
    return f"SELECT *, {LABEL_SQL} AS kategori_ketahanan FROM ({scored})"


INDICATORS_SQL = with_views(
    with_rounding(
        scored_sql(grouped_sql("production"), "total_produksi / 1000"),
        [*measures("production"), "produksi_per_kapita"],
    ),
    "production",
)


@query("mart_indicators", INDICATORS_SQL)
def _mart_indicators(t: Tables) -> DataFrame:
    mart = presets.mart_indicators(view(t, "production"))
    return rounded(mart, *measures("production"), "produksi_per_kapita")


@query("mart_indicators_through", INDICATORS_SQL)
def mart_indicators_through(t: Tables) -> DataFrame:
    mart = presets.finish_indicators(_production_through(t))
    return rounded(mart, *measures("production"), "produksi_per_kapita")


PER_CAPITA_SQL = "CASE WHEN jumlah_penduduk > 0 THEN total_produksi / jumlah_penduduk END"
ALL_SOURCES = list(SOURCE_NAMES)
MART_MEASURES = [
    column for name in ("production", *ALL_SOURCES) if name != "social" for column in measures(name)
]


def lower_keys(sql: str) -> str:
    return f"SELECT * REPLACE (lower(regexp_replace(kabupaten_kota, '[^a-zA-Z0-9\\s]', '', 'g')) AS kabupaten_kota) FROM ({sql})"


def _mart(t: Tables, names: Sequence[str], **options) -> DataFrame:
    sources = {SOURCE_NAMES[name]: view(t, name) for name in names}
    return presets.mart_enriched(view(t, "production"), sources, **options)


@query(
    "mart_enriched",
    with_views(
        with_rounding(
            scored_sql(lower_keys(joined_sql(*ALL_SOURCES)), PER_CAPITA_SQL),
            [*MART_MEASURES, "produksi_per_kapita"],
        ),
        "production",
        *ALL_SOURCES,
    ),
)
def _mart_enriched(t: Tables) -> DataFrame:
    return rounded(_mart(t, ALL_SOURCES), *MART_MEASURES, "produksi_per_kapita")


@query("mart_enriched_bucketed", ORACLE["mart_enriched"])
def _mart_enriched_bucketed(t: Tables) -> DataFrame:
    sources = {SOURCE_NAMES[name]: view(t, name) for name in ALL_SOURCES}
    folder = scratch.folder(t.spark, "mart_enriched_bucketed")
    mart = mart_bucketed(view(t, "production"), sources, scratch.database(t.spark), folder, 8)
    return rounded(mart, *MART_MEASURES, "produksi_per_kapita")


# Some rows spell their region in another way; spellings of one region are one region.
SPELLED = "CASE WHEN komoditas LIKE 'A%' THEN lower(kabupaten_kota) || '!' ELSE kabupaten_kota END"
_MERGED = [("production", f"SELECT * REPLACE ({SPELLED} AS kabupaten_kota) FROM ({VIEWS['production'].sql})")]
_MERGED += [(name, VIEWS[name].sql) for name in ALL_SOURCES]


@query(
    "mart_enriched_spellings",
    "WITH " + ", ".join(f"{name} AS ({lower_keys(sql)})" for name, sql in _MERGED) + " "
    + with_rounding(scored_sql(joined_sql(*ALL_SOURCES), PER_CAPITA_SQL), [*MART_MEASURES, "produksi_per_kapita"]),
)
def _mart_enriched_spellings(t: Tables) -> DataFrame:
    sources = {SOURCE_NAMES[name]: view(t, name) for name in ALL_SOURCES}
    spelled = view(t, "production").withColumn("kabupaten_kota", F.expr(SPELLED))
    return rounded(presets.mart_enriched(spelled, sources), *MART_MEASURES, "produksi_per_kapita")


PROVINCE_WIDE = ["price", "weather"]
PROVINCE_MEASURES = [c for name in ("production", *PROVINCE_WIDE) for c in measures(name)]


@query(
    "mart_enriched_province",
    with_views(
        with_rounding(
            scored_sql(
                lower_keys(
                    f"SELECT * FROM ({grouped_sql('production')})"
                    + "".join(
                        f" LEFT JOIN (SELECT tahun, {AGG_SQL[name]} FROM {name} GROUP BY ALL) USING (tahun)"
                        for name in PROVINCE_WIDE
                    )
                ),
                "total_produksi",
            ),
            [*PROVINCE_MEASURES, "produksi_per_kapita"],
        ),
        "production",
        *PROVINCE_WIDE,
    ),
)
def _mart_enriched_province(t: Tables) -> DataFrame:
    """Prices and weather of the whole province, joined to every region by year."""
    wide = tuple(SOURCE_NAMES[name] for name in PROVINCE_WIDE)
    mart = _mart(t, PROVINCE_WIDE, province_wide=wide)
    return rounded(mart, *PROVINCE_MEASURES, "produksi_per_kapita")


PARTIAL = ["price", "index"]
PARTIAL_MEASURES = [c for name in ("production", *PARTIAL) for c in measures(name)]


@query(
    "mart_enriched_partial",
    with_views(
        with_rounding(
            scored_sql(lower_keys(joined_sql(*PARTIAL)), "total_produksi"),
            [*PARTIAL_MEASURES, "produksi_per_kapita"],
        ),
        "production",
        *PARTIAL,
    ),
)
def _mart_enriched_partial(t: Tables) -> DataFrame:
    return rounded(_mart(t, PARTIAL), *PARTIAL_MEASURES, "produksi_per_kapita")


def silver_views(*names: str) -> str:
    """Common table expressions of the raw views and, under plain names, their cleaned rows."""
    return with_views("", *[f"raw_{name}" for name in names]) + ", ".join(
        f", {name} AS ({SILVER_SQL[name]})" for name in names
    ).replace(", , ", ", ")


@query(
    "mart_indicators_from_raw",
    silver_views("production")
    + " "
    + with_rounding(
        scored_sql(grouped_sql("production"), "total_produksi / 1000"),
        [*measures("production"), "produksi_per_kapita"],
    ),
)
def _mart_indicators_from_raw(t: Tables) -> DataFrame:
    mart = presets.mart_indicators(presets.clean_production(view(t, "raw_production")))
    return rounded(mart, *measures("production"), "produksi_per_kapita")


# Sums of amounts in cents are compared in cents; at this size doubles hold no more.
CENTS = ["total_konsumsi_per_kapita"]
FINE = [name for name in [*MART_MEASURES, "produksi_per_kapita"] if name not in CENTS]


@query(
    "run_silver_and_gold",
    silver_views("production", *ALL_SOURCES)
    + f" SELECT * REPLACE ({rounded_sql(*CENTS, digits=2)}) FROM ("
    + with_rounding(
        scored_sql(lower_keys(joined_sql(*ALL_SOURCES)), PER_CAPITA_SQL),
        FINE,
    )
    + ")",
)
def _run_silver_and_gold(t: Tables) -> DataFrame:
    """From six raw files to the registered mart, as the jobs do it."""
    folder = scratch.folder(t.spark, "run")
    for name in DATASET_NAMES:
        _raw_file(t, name, f"{folder}/raw")
    silver, gold = scratch.database(t.spark), scratch.database(t.spark)
    run_silver(t.spark, f"{folder}/raw", f"{folder}/silver", database=silver)
    run_gold(t.spark, f"{folder}/gold", gold, silver)
    mart = t.spark.table(f"{gold}.ketahanan_pangan_enriched")
    return rounded(rounded(mart, *FINE), *CENTS, digits=2)


@query(
    "run_silver_and_gold_indicators",
    silver_views("production")
    + " "
    + with_rounding(
        scored_sql(grouped_sql("production"), "total_produksi / 1000"),
        [*measures("production"), "produksi_per_kapita"],
    ),
)
def _run_silver_and_gold_indicators(t: Tables) -> DataFrame:
    """The other mart of the same run, from the raw production file alone."""
    folder = scratch.folder(t.spark, "run")
    _raw_file(t, "production", f"{folder}/raw")
    silver, gold = scratch.database(t.spark), scratch.database(t.spark)
    run_silver(t.spark, f"{folder}/raw", f"{folder}/silver", ["produksi_pangan"], silver)
    run_gold(t.spark, f"{folder}/gold", gold, silver)
    mart = t.spark.table(f"{gold}.ketahanan_pangan_kab")
    return rounded(mart, *measures("production"), "produksi_per_kapita")


@query(
    "score_threshold",
    with_views(
        "SELECT luas_panen, CAST(CASE WHEN luas_panen > 60 THEN 80 WHEN luas_panen > 30 THEN 60 "
        "ELSE 40 END AS INTEGER) AS score FROM production",
        "production",
    ),
)
def _score_threshold(t: Tables) -> DataFrame:
    score = score_by_threshold(F.col("luas_panen"), ((60, 80), (30, 60)), 40).alias("score")
    return view(t, "production").select("luas_panen", score)


@query(
    "label_threshold",
    with_views(
        "SELECT produksi, CASE WHEN produksi >= 120 THEN 'Tahan' WHEN produksi >= 40 THEN 'Sedang' "
        "ELSE 'Rentan' END AS label FROM production",
        "production",
    ),
)
def _label_threshold(t: Tables) -> DataFrame:
    label = label_by_threshold(F.col("produksi"), ((120, "Tahan"), (40, "Sedang")), "Rentan")
    return view(t, "production").select("produksi", label.alias("label"))


@query(
    "gate_required",
    with_views(
        "SELECT CAST(count(*) >= 100 AS INTEGER) AS enough, CAST(0 AS INTEGER) AS complete "
        "FROM production",
        "production",
    ),
)
def _gate_required(t: Tables) -> DataFrame:
    frame = view(t, "production")
    enough = g.require(frame, ["produksi", "luas_panen"], 100)
    complete = g.require(frame, ["produksi", "absent"], 1)
    return t.spark.range(1).select(
        F.lit(int(enough)).alias("enough"), F.lit(int(complete)).alias("complete")
    )


@query(
    "validate_mart",
    with_views(
        "SELECT count(*) AS row_count, count(DISTINCT kabupaten_kota) AS region_count, "
        f"count(*) > 0 AS valid FROM ({grouped_sql('production')})",
        "production",
    ),
)
def _validate_mart(t: Tables) -> DataFrame:
    mart = presets.mart_indicators(view(t, "production"))
    return g.validate_mart(mart, presets.MART_REQUIRED, presets.REGION)


@query(
    "run_summary",
    with_views(
        "SELECT a AS rows_in, b AS rows_out, round((a - b) * 100.0 / a, 6) AS reduction_percent "
        "FROM (SELECT (SELECT count(*) FROM raw_production) AS a, "
        f"(SELECT count(*) FROM ({SILVER_SQL['production']})) AS b)",
        "raw_production",
    ),
)
def _run_summary(t: Tables) -> DataFrame:
    raw = view(t, "raw_production")
    return rounded(g.run_summary(raw, presets.clean_production(raw)), "reduction_percent")
