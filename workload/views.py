"""Input views over the driver tables, written once and used on both sides.

A view is a source and a list of expressions in SQL that Spark and DuckDB read
alike; where they do not, ``duck`` holds the other spelling. The raw views hold
text in the shapes the cleaners are made for, with marker cells, blank cells,
packed rows, impossible dates and repeated rows. The others are typed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The driver tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, frame)  # one schema look-up per table and query
        return frame


@dataclass(frozen=True)
class View:
    source: Callable[[Tables], DataFrame]
    from_sql: str
    columns: Mapping[str, str]
    duck: Mapping[str, str] = field(default_factory=dict)

    def frame(self, tables: Tables) -> DataFrame:
        return self.source(tables).select(
            *[F.expr(text).alias(name) for name, text in self.columns.items()]
        )

    @property
    def sql(self) -> str:
        columns = ", ".join(
            f'{self.duck.get(name, text)} AS "{name}"' for name, text in self.columns.items()
        )
        return f"SELECT {columns} FROM {self.from_sql}"


def _suppliers(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))


def _customers(t: Tables) -> DataFrame:
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return orders.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))


SUPPLIER_SQL = "lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"
CUSTOMER_SQL = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"

ORDER_DAY = (
    "lpad(cast(day(o_orderdate) as string), 2, '0') || '/' || "
    "lpad(cast(month(o_orderdate) as string), 2, '0') || '/' || "
    "cast(year(o_orderdate) + 10 as string)"
)
PRICE_TEXT = "format_number(cast(floor(o_totalprice / 100) as bigint) * 100, 0)"
PRICE_TEXT_DUCK = "format('{:,}', cast(floor(o_totalprice / 100) as bigint) * 100)"
PACKED_LINE = "o_orderkey % 7 = 3"
INDEX_HEADER = (
    "Nomor;Kode Prov;Nama Provinsi;Nama Kabupaten;Kode Kab/Kota;Tipe;Tahun;IKP;"
    "PERINGKAT KAB/KOTA;KELOMPOK IKP"
)


def _price_cells(price: str) -> dict[str, str]:
    return {
        "komoditas": f"CASE WHEN {PACKED_LINE} THEN o_orderpriority || ',' || {ORDER_DAY} || "
        f"',\"' || {price} || '\"' ELSE o_orderpriority END",
        "tanggal": f"CASE WHEN {PACKED_LINE} THEN NULL WHEN o_orderkey % 11 = 0 THEN '99/99/2010' "
        f"WHEN o_orderkey % 43 = 0 THEN NULL ELSE {ORDER_DAY} END",
        "harga_pangan": f"CASE WHEN {PACKED_LINE} THEN NULL WHEN o_orderkey % 5 = 0 THEN '-' "
        f"WHEN o_orderkey % 9 = 0 THEN '\" ' || {price} || '\"' ELSE {price} END",
    }


VIEWS: dict[str, View] = {
    # Typed views
    "production": View(
        _suppliers,
        SUPPLIER_SQL,
        {
            "kabupaten_kota": "n_name",
            "komoditas": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag || l_linestatus END",
            "produksi": "l_quantity * 4",
            "luas_panen": "l_extendedprice / 1001",
            "produktivitas": "l_quantity * 4 / (l_extendedprice / 1001) + l_tax * 1.9",
            "tahun": "cast(year(l_shipdate) + 3 as int)",
        },
    ),
    "price": View(
        _customers,
        CUSTOMER_SQL,
        {
            "kabupaten_kota": "n_name",
            "komoditas": "o_orderpriority",
            "harga_produsen": "o_totalprice / 1.001",
            "harga_konsumen": "o_totalprice * 1.1 / 1.001",
            "tahun": "cast(year(o_orderdate) + 3 as int)",
        },
    ),
    "weather": View(
        lambda t: t.events,
        "events",
        {
            "kabupaten_kota": "'NATION_' || cast(user_id % 25 as string)",
            "curah_hujan": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE value / 1.001 END",
            "suhu_rata_rata": "cast(20 + event_id % 45 as double)",
            "tahun": "cast(1998 + user_id % 7 as int)",
        },
    ),
    "social": View(
        lambda t: t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")),
        "customer JOIN nation ON c_nationkey = n_nationkey",
        {
            "kabupaten_kota": "n_name",
            "jumlah_penduduk": "cast(c_custkey % 400 as int)",
            "tingkat_kemiskinan": "cast(c_custkey % 1100 as double) / 10.01",
            "ipkm": "c_acctbal / 1.001",
            "tahun": "cast(1998 + c_custkey % 6 as int)",
        },
    ),
    # One key holds a third of all rows
    "heavy_social": View(
        lambda t: t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")),
        "customer JOIN nation ON c_nationkey = n_nationkey",
        {
            "kabupaten_kota": "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 3 = 0 "
            "THEN 'BRAZIL' ELSE n_name END",
            "jumlah_penduduk": "cast(c_custkey as int)",
            "ipkm": "c_acctbal / 1.001",
            "tahun": "cast(CASE WHEN c_custkey % 3 = 0 THEN 2003 ELSE 1998 + c_custkey % 6 END as int)",
        },
    ),
    "consumption": View(
        _customers,
        CUSTOMER_SQL,
        {
            "kabupaten_kota": "n_name",
            "komoditas": "CASE WHEN o_orderkey % 19 = 0 THEN ' ' ELSE o_orderpriority END",
            "konsumsi_per_kapita": "o_totalprice / 1001 - 50",
            "tahun": "cast(year(o_orderdate) + 3 as int)",
        },
    ),
    "index": View(
        lambda t: t.part,
        "part",
        {
            "kabupaten_kota": "'NATION_' || cast(p_partkey % 25 as string)",
            "skor_ikp": "p_retailprice / 12.013",
            "kategori_ikp": "cast(1 + p_size % 7 as int)",
            "tahun": "cast(1998 + p_partkey % 7 as int)",
        },
    ),
    # Raw views, all text
    "raw_production": View(
        lambda t: t.lineitem,
        "lineitem",
        {
            "kabupaten_kota": "CASE WHEN l_orderkey % 19 = 0 THEN '#N/A' WHEN l_orderkey % 2 = 0 "
            "THEN ' Kab.  North ' || cast(l_suppkey % 25 as string) "
            "ELSE 'Kab North-' || cast(l_suppkey % 25 as string) END",
            "komoditas": "l_returnflag || ' / ' || l_linestatus",
            "produksi": "CASE WHEN l_orderkey % 13 = 0 THEN '8888' WHEN l_orderkey % 17 = 0 THEN '-' "
            "WHEN l_orderkey % 23 = 0 THEN '-5' ELSE "
            "cast(cast(l_quantity as decimal(12,2)) as string) END",
            "luas_panen": "cast(cast(floor(l_extendedprice / 10000) as bigint) as string)",
            "produktivitas": "CASE WHEN l_partkey % 29 = 0 THEN '' ELSE "
            "cast(l_orderkey % 97 as string) END",
            "tahun": "CASE WHEN l_orderkey % 31 = 0 THEN '1899' WHEN l_orderkey % 37 = 0 THEN 'n.a.' "
            "WHEN l_orderkey % 41 = 0 THEN cast(year(l_shipdate) + 10 as string) || '.0' "
            "WHEN l_orderkey % 43 = 0 THEN '1899.0' WHEN l_orderkey % 47 = 0 THEN '2099.0' "
            "ELSE cast(year(l_shipdate) + 10 as string) END",
        },
    ),
    "raw_price": View(
        lambda t: t.orders,
        "orders",
        _price_cells(PRICE_TEXT),
        _price_cells(PRICE_TEXT_DUCK),
    ),
    "raw_weather": View(
        lambda t: t.events,
        "events",
        {
            "TANGGAL": "lpad(cast(1 + event_id % 31 as string), 2, '0') || '-' || "
            "lpad(cast(1 + user_id % 12 as string), 2, '0') || '-' || "
            "cast(2000 + event_id % 7 as string)",
            "suhu": "CASE WHEN event_id % 50 = 0 THEN '-' WHEN event_id % 41 = 0 THEN '99.5' "
            "ELSE cast(20 + user_id % 15 as string) END",
            "curah_hujan": "CASE WHEN event_id % 11 = 0 THEN '-' WHEN event_id % 13 = 0 THEN '8888' "
            "WHEN event_id % 17 = 0 THEN '8888.0' WHEN event_id % 19 = 0 THEN '' "
            "ELSE cast(cast(floor(value) as bigint) - 1 as string) END",
        },
    ),
    "raw_social": View(
        lambda t: t.customer,
        "customer",
        {
            "Kabupaten/Kota": "'Kab.  North-' || cast(c_nationkey as string)",
            "Tahun": "CASE WHEN c_custkey % 11 = 0 THEN ' ' WHEN c_custkey % 37 = 0 THEN NULL "
            "ELSE cast(2005 + c_custkey % 7 as string) END",
            "Jumlah_Penduduk": "CASE WHEN c_custkey % 13 = 0 THEN '-' "
            "ELSE cast(c_custkey % 500 as string) END",
            "Persentase_miskin": "cast(c_custkey % 110 as string) || '.5'",
            "pengeluaran_per_kapita": "cast(cast(c_acctbal as decimal(12,2)) as string)",
        },
    ),
    "raw_consumption": View(
        lambda t: t.orders,
        "orders",
        {
            "Tahun": "cast(year(o_orderdate) + 10 as string)",
            "Kabupaten_Kota": "CASE WHEN o_orderkey % 17 = 0 THEN ' ** ' "
            "ELSE 'Kab North-' || cast(o_custkey % 25 as string) END",
            "Komoditas": "o_orderpriority",
            "Konsumsi Pangan": "CASE WHEN o_orderkey % 23 = 0 THEN '1.234,5' "
            "WHEN o_orderkey % 29 = 0 THEN '-' ELSE "
            "replace(cast(cast(o_totalprice as decimal(12,2)) as string), '.', ',') END",
        },
    ),
    "raw_index": View(
        lambda t: t.part,
        "part",
        {
            INDEX_HEADER: "cast(p_partkey as string) || ';18;Prov;Kab. North-' || "
            "cast(p_partkey % 25 as string) || ';18;Kabupaten' || CASE WHEN p_partkey % 13 = 0 "
            "THEN '' ELSE ';' || cast(2005 + p_partkey % 7 as string) || ';' || "
            "cast(p_partkey % 105 as string) || '.5;' || CASE WHEN p_partkey % 6 = 0 THEN '#N/A' "
            "ELSE '3' END || ';' || cast(p_size % 8 as string) END",
        },
    ),
    "doubled_lines": View(
        lambda t: t.lineitem.unionAll(t.lineitem),
        "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)",
        {
            "l_orderkey": "l_orderkey",
            "l_partkey": "l_partkey",
            "l_suppkey": "l_suppkey",
            "l_linenumber": "l_linenumber",
            "l_quantity": "l_quantity",
            "l_returnflag": "l_returnflag",
        },
    ),
    "dated_orders": View(
        lambda t: t.orders,
        "orders",
        {
            "o_orderkey": "o_orderkey",
            "slash": f"CASE WHEN o_orderkey % 10 = 0 THEN '31/02/2010' WHEN o_orderkey % 10 = 1 "
            f"THEN '1/2/2010' WHEN o_orderkey % 10 = 2 THEN '-' ELSE {ORDER_DAY} END",
            "dash": f"CASE WHEN o_orderkey % 10 = 0 THEN '31-02-2010' WHEN o_orderkey % 10 = 1 "
            f"THEN '2010-02-01' WHEN o_orderkey % 10 = 2 THEN '' "
            f"ELSE replace({ORDER_DAY}, '/', '-') END",
        },
    ),
    "gappy_orders": View(
        lambda t: t.orders,
        "orders",
        {
            "o_orderkey": "o_orderkey",
            "status": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END",
            "amount": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END",
        },
    ),
}


def view(tables: Tables, name: str) -> DataFrame:
    return VIEWS[name].frame(tables)


def with_views(body: str, *names: str) -> str:
    """SQL text: the named views as common table expressions in front of ``body``."""
    return "WITH " + ", ".join(f"{name} AS ({VIEWS[name].sql})" for name in names) + " " + body
