"""Project the driver's TPC-H-like tables onto the seven airline tables.

The driver data has no airline tables, so each domain table is a plain
DataFrame expression over ``nation region part orders lineitem supplier``.
Every expression has an exact DuckDB counterpart (``tarmac.oracle.binding``),
which is what lets the oracle check whole-table results.

  airports_data   nation + region for the city
  aircrafts_data  distinct p_brand (the fleet)
  seats           part; class from p_type
  bookings        orders
  tickets         orders, one ticket per order
  segments        lineitem x supplier; a departure is (supplier nation, ship
                  day folded to every fifth day, supplier key mod 3)
  departures      one row per distinct departure of the segments

Every row of a driver table is kept.  Odd cases are made by value: departures
of one nation leave from a code that no airport has; two nations share a name,
others list "ru" first or have a malformed, NULL or half-empty name; every
50th ticket names a booking that doesn't exist; some seats and departures are
of an aircraft outside the fleet; one brand has economy seats only, and some
seats and segments are of a fourth class; some segments (and those of an unknown
supplier) have no departure id, some no amount.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOMAIN_TABLES = (
    "aircrafts_data",
    "airports_data",
    "bookings",
    "departures",
    "seats",
    "segments",
    "tickets",
)

_EPOCH_DAY = "1995-01-01"
_UNMATCHED_NATION = 24
_PACK = 1_000_000


# Declared schemas of the driver tables the binding reads (no inference job
# per read; only these columns are ever requested from the files).
DRIVER_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Each projection is written as SQL expressions (one analyzer call per column)
# so the Spark binding reads line for line like its DuckDB twin.
# Nation 7 carries nation 6's name.
_LETTERS = "translate(CAST(CASE WHEN n_nationkey = 7 THEN 6 ELSE n_nationkey END AS STRING), '0123456789', 'ABCDEFGHIJ')"
_EN, _RU = f"concat('\"en\": \"Nation ', {_LETTERS}, ' Airport\"')", f"concat('\"ru\": \"Нация ', {_LETTERS}, '\"')"
_DAYS = f"datediff(to_date(l_shipdate), DATE'{_EPOCH_DAY}')"


def _minutes(expr: str) -> str:
    return f"make_dt_interval(0, 0, CAST({expr} AS INT), 0)"


def airports_data(nation: DataFrame, region: DataFrame) -> DataFrame:
    return (
        nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
        .selectExpr(
            "concat('A', CAST(n_nationkey AS STRING)) AS airport_code",
            f"""CASE WHEN n_nationkey = 11 THEN concat('{{', {_EN})
                     WHEN n_nationkey = 13 THEN NULL
                     WHEN n_nationkey = 17 THEN concat('{{"en": null, ', {_RU}, '}}')
                     WHEN n_nationkey % 5 = 3 THEN concat('{{', {_RU}, ', ', {_EN}, '}}')
                     ELSE concat('{{', {_EN}, ', ', {_RU}, '}}') END AS airport_name""",
            """CASE WHEN n_nationkey = 19 THEN 'no json' ELSE concat('{"en": "', r_name, ' City", "ru": "Город"}') END AS city""",
            "named_struct('lon', n_nationkey * 1.5D, 'lat', n_regionkey * 10.0D) AS coordinates",
            "'UTC' AS timezone",
        )
    )


def aircrafts_data(part: DataFrame) -> DataFrame:
    return (
        part.selectExpr("p_brand AS aircraft_code")
        .distinct()
        .selectExpr(
            "aircraft_code",
            """concat('{"en": "Model ', aircraft_code, '", "ru": "Модель"}') AS model""",
            "length(aircraft_code) * 1000 AS range",
        )
    )


def seats(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "CASE WHEN p_size = 50 THEN 'Retired#1' ELSE p_brand END AS aircraft_code",
        "CAST(p_partkey AS STRING) AS seat_no",
        "CASE WHEN p_size = 49 THEN 'First' WHEN p_brand = 'Brand#3' THEN 'Economy' WHEN p_type = 'LARGE' THEN 'Business'"
        " WHEN p_type = 'PROMO' THEN 'Comfort' ELSE 'Economy' END AS fare_conditions",
    )


def bookings(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS book_ref",
        "o_orderdate AS book_date",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount",
    )


def tickets(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS ticket_no",
        "concat(CASE WHEN o_orderkey % 50 = 0 THEN 'none-' ELSE '' END, CAST(o_orderkey AS STRING)) AS book_ref",
        "CAST(o_custkey AS STRING) AS passenger_id",
        "concat('PASSENGER ', CAST(o_custkey AS STRING)) AS passenger_name",
        """concat('{"phone": "+7', lpad(CAST(o_custkey AS STRING), 10, '0'), '"}') AS contact_data""",
    )


def _segments(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """lineitem x supplier with the departure key of every segment."""
    seg = lineitem.join(supplier, lineitem["l_suppkey"] == supplier["s_suppkey"], "left")
    return seg.selectExpr(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_suppkey", "s_nationkey", f"{_DAYS} - {_DAYS} % 5 AS d5"
    ).selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "s_nationkey",
        "d5",
        "(CAST(s_nationkey AS BIGINT) * 10000 + d5) * 3 + l_suppkey % 3 AS flight_id",
    )


def segments(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    return _segments(lineitem, supplier).selectExpr(
        "CAST(l_orderkey AS STRING) AS ticket_no",
        "CASE WHEN l_orderkey % 97 <> 0 THEN flight_id END AS flight_id",
        "CASE WHEN l_orderkey % 31 = 0 THEN 'First' WHEN l_linenumber <= 4 THEN 'Economy' WHEN l_linenumber <= 6 THEN 'Business'"
        " ELSE 'Comfort' END AS fare_conditions",
        "CASE WHEN l_orderkey % 89 <> 0 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS amount",
    )


def departures(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    # One row per departure.  Nation and day are functions of flight_id, so
    # grouping by flight_id alone gives the distinct departures AND leaves
    # them hash-partitioned on flight_id, the key every consumer joins on.
    # Both attributes travel in ONE bigint aggregate (nation * 10^6 + day
    # offset; exact for any day within +-500,000 days of the epoch):
    # whichever columns a consumer prunes, the aggregate and its exchange
    # stay identical, so Spark derives the departures once per query and
    # reuses the stage -- and a bigint keeps the fast hash aggregate.
    # A departure always has an id.  Stating it here also keeps every
    # consumer's departures subtree identical (a join would otherwise add its
    # own inferred IS NOT NULL below the aggregate).
    half = _PACK // 2
    dep = (
        _segments(lineitem, supplier)
        .filter(F.col("flight_id").isNotNull())
        .groupBy("flight_id")
        .agg(F.expr(f"min(CAST(s_nationkey AS BIGINT) * {_PACK} + (d5 + {half}))").alias("k"))
        .selectExpr(
            "flight_id",
            f"CAST(k div {_PACK} AS INT) AS s_nationkey",
            f"CAST(k % {_PACK} - {half} AS INT) AS d5",
        )
    )
    sched = f"TIMESTAMP_NTZ'{_EPOCH_DAY} 00:00:00' + make_dt_interval(d5, 0, CAST(flight_id * 37 % 1440 AS INT), 0)"
    dep_offset = "flight_id * 13 % 91 - 10"
    return dep.selectExpr("flight_id", "s_nationkey", f"{sched} AS sched").selectExpr(
        "flight_id",
        "concat('PG', lpad(CAST(flight_id % 10000 AS STRING), 4, '0')) AS flight_no",
        "sched AS scheduled_departure",
        f"sched + {_minutes('60 + flight_id * 7 % 400')} AS scheduled_arrival",
        f"concat(CASE WHEN s_nationkey = {_UNMATCHED_NATION} THEN 'X' ELSE 'A' END, CAST(s_nationkey AS STRING)) AS departure_airport",
        "concat('A', CAST((s_nationkey + 1 + flight_id % 23) % 25 AS STRING)) AS arrival_airport",
        "CASE WHEN flight_id % 13 = 0 THEN 'Cancelled' WHEN flight_id % 17 = 0 THEN 'Departed'"
        " WHEN flight_id % 19 = 0 THEN 'Delayed' ELSE 'Arrived' END AS status",
        "CASE WHEN flight_id % 29 = 0 THEN 'Retired#1' WHEN flight_id % 31 = 0 THEN 'Unknown#1'"
        " ELSE concat('Brand#', CAST(1 + flight_id % 25 AS STRING)) END AS aircraft_code",
        f"CASE WHEN flight_id % 13 <> 0 THEN sched + {_minutes(dep_offset)} END AS actual_departure",
        f"CASE WHEN flight_id % 13 <> 0 AND flight_id % 17 <> 0"
        f" THEN sched + {_minutes(f'{dep_offset} + 45 + flight_id * 7 % 400')} END AS actual_arrival",
    )


class _BoundTables(Mapping):
    """The seven airline tables, each planned on first access.

    A query that needs two tables plans two; each driver table is opened
    (file listing) once and shared by the tables built from it.
    """

    _BUILDERS = {
        "aircrafts_data": (aircrafts_data, ("part",)),
        "airports_data": (airports_data, ("nation", "region")),
        "bookings": (bookings, ("orders",)),
        "departures": (departures, ("lineitem", "supplier")),
        "seats": (seats, ("part",)),
        "segments": (segments, ("lineitem", "supplier")),
        "tickets": (tickets, ("orders",)),
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._sf_dir = sf_dir
        self._driver: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}

    def _driver_table(self, name: str) -> DataFrame:
        if name not in self._driver:
            self._driver[name] = read_driver_table(self._spark, self._sf_dir, name)
        return self._driver[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            build, inputs = self._BUILDERS[name]
            self._built[name] = build(*(self._driver_table(i) for i in inputs))
        return self._built[name]

    def __iter__(self):
        return iter(DOMAIN_TABLES)

    def __len__(self) -> int:
        return len(DOMAIN_TABLES)


def bind_domain_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The seven airline tables as lazy DataFrames over the driver parquet."""
    return _BoundTables(spark, sf_dir)
