r"""DuckDB CTEs that build the seven airline tables from the driver views.

Expression for expression the same projection as ``tarmac.sources.binding``,
written independently in DuckDB SQL.  ``airports_clean`` applies the name
cleaning with DuckDB's JSON functions and RE2 (\x{...} instead of Java's
\u... escapes).
"""

# Fixed values -- the same name patterns as tarmac.functions.names, in RE2 form.
AIRPORT_NAME_RE2 = r"^([A-Za-z\x{0400}-\x{04FF}.\-]+(?:\s[A-Za-z\x{0400}-\x{04FF}.\-]+)*)"
CITY_NAME_RE2 = r"^([A-Za-z.\-]+(?:\s[A-Za-z.\-]+)?)"


def _joined_values(json_col: str) -> str:
    """All values of a JSON object in key order joined by ' | ', NULLs skipped."""
    return (
        "coalesce(array_to_string(list_filter(list_transform(json_keys({c}), "
        "lambda k: json_extract_string({c}, '$.\"' || k || '\"')), lambda v: v IS NOT NULL), ' | '), '')"
    ).format(c=f"(CASE WHEN json_valid({json_col}) THEN {json_col} END)")


def _letters(col: str) -> str:
    return f"translate(CAST({col} AS VARCHAR), '0123456789', 'ABCDEFGHIJ')"


_NAME_KEY = "(CASE n.n_nationkey WHEN 7 THEN 6 ELSE n.n_nationkey END)"
_EN = f"""'"en": "Nation ' || {_letters(_NAME_KEY)} || ' Airport"'"""
_RU = f"""'"ru": "Нация ' || {_letters(_NAME_KEY)} || '"'"""


def _minutes(expr: str) -> str:
    return f"to_minutes(CAST({expr} AS BIGINT))"


DOMAIN_CTES = f"""
airports_data AS (
  SELECT 'A' || CAST(n.n_nationkey AS VARCHAR) AS airport_code,
         CASE n.n_nationkey WHEN 11 THEN '{{' || {_EN} WHEN 13 THEN NULL WHEN 17 THEN '{{"en": null, ' || {_RU} || '}}'
           ELSE CASE WHEN n.n_nationkey % 5 = 3 THEN '{{' || {_RU} || ', ' || {_EN} || '}}' ELSE '{{' || {_EN} || ', ' || {_RU} || '}}' END
           END AS airport_name,
         CASE WHEN n.n_nationkey = 19 THEN 'no json' ELSE '{{"en": "' || r.r_name || ' City", "ru": "Город"}}' END AS city,
         CAST(n.n_nationkey AS DOUBLE) * 1.5 AS lon, CAST(n.n_regionkey AS DOUBLE) * 10.0 AS lat,
         'UTC' AS timezone
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
aircrafts_data AS (
  SELECT DISTINCT p_brand AS aircraft_code FROM part),
seats AS (
  SELECT if(p_size = 50, 'Retired#1', p_brand) AS aircraft_code, CAST(p_partkey AS VARCHAR) AS seat_no,
         CASE WHEN p_size = 49 THEN 'First' WHEN p_brand = 'Brand#3' THEN 'Economy' WHEN p_type = 'LARGE' THEN 'Business'
              WHEN p_type = 'PROMO' THEN 'Comfort' ELSE 'Economy' END AS fare_conditions
  FROM part),
bookings AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS book_ref, o_orderdate AS book_date,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount
  FROM orders),
tickets AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ticket_no,
         if(o_orderkey % 50 = 0, 'none-', '') || CAST(o_orderkey AS VARCHAR) AS book_ref,
         CAST(o_custkey AS VARCHAR) AS passenger_id
  FROM orders),
seg0 AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, l.l_suppkey, s.s_nationkey,
         date_diff('day', DATE '1995-01-01', CAST(l.l_shipdate AS DATE)) AS d
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey),
seg AS (
  SELECT *, (CAST(s_nationkey AS BIGINT) * 10000 + (d - d % 5)) * 3 + l_suppkey % 3 AS flight_id,
         d - d % 5 AS d5
  FROM seg0),
segments AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS ticket_no, if(l_orderkey % 97 = 0, NULL, flight_id) AS flight_id,
         CASE WHEN l_orderkey % 31 = 0 THEN 'First' WHEN l_linenumber <= 4 THEN 'Economy'
              WHEN l_linenumber <= 6 THEN 'Business' ELSE 'Comfort' END AS fare_conditions,
         if(l_orderkey % 89 = 0, NULL, CAST(l_extendedprice AS DECIMAL(12,2))) AS amount
  FROM seg),
flight_keys AS (
  SELECT DISTINCT flight_id, s_nationkey, d5 FROM seg WHERE flight_id IS NOT NULL),
flight_sched AS (
  SELECT *, TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(d5 AS INTEGER)) + {_minutes('flight_id * 37 % 1440')}
           AS scheduled_departure
  FROM flight_keys),
departures AS (
  SELECT flight_id, 'PG' || lpad(CAST(flight_id % 10000 AS VARCHAR), 4, '0') AS flight_no,
         scheduled_departure, scheduled_departure + {_minutes('60 + flight_id * 7 % 400')} AS scheduled_arrival,
         if(s_nationkey = 24, 'X', 'A') || CAST(s_nationkey AS VARCHAR) AS departure_airport,
         'A' || CAST((s_nationkey + 1 + flight_id % 23) % 25 AS VARCHAR) AS arrival_airport,
         CASE WHEN flight_id % 13 = 0 THEN 'Cancelled' WHEN flight_id % 17 = 0 THEN 'Departed'
              WHEN flight_id % 19 = 0 THEN 'Delayed' ELSE 'Arrived' END AS status,
         CASE WHEN flight_id % 29 = 0 THEN 'Retired#1' WHEN flight_id % 31 = 0 THEN 'Unknown#1'
              ELSE 'Brand#' || CAST(1 + flight_id % 25 AS VARCHAR) END AS aircraft_code,
         CASE WHEN flight_id % 13 = 0 THEN NULL
              ELSE scheduled_departure + {_minutes('flight_id * 13 % 91 - 10')} END AS actual_departure,
         CASE WHEN flight_id % 13 = 0 OR flight_id % 17 = 0 THEN NULL
              ELSE scheduled_departure + {_minutes('flight_id * 13 % 91 - 10 + 45 + flight_id * 7 % 400')} END
           AS actual_arrival
  FROM flight_sched),
airports_clean AS (
  SELECT airport_code, lon, lat, timezone,
         regexp_extract({_joined_values('airport_name')}, '{AIRPORT_NAME_RE2}', 1) AS airport_name,
         regexp_extract({_joined_values('city')}, '{CITY_NAME_RE2}', 1) AS city_name
  FROM airports_data),
names AS (
  SELECT airport_code, airport_name FROM airports_clean)
"""


def with_domain(body: str, extra_ctes: str = "") -> str:
    """``WITH <domain tables>[, extra] <body>``."""
    ctes = DOMAIN_CTES.strip()
    if extra_ctes.strip():
        ctes = ctes + ",\n" + extra_ctes.strip().rstrip(",")
    return f"WITH {ctes}\n{body.strip()}"


def r2(expr: str) -> str:
    """Spark's round(x, 2) on a double: half-up on the shortest decimal text."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE)"


def epoch_s(col: str) -> str:
    """Spark's unix_timestamp: whole seconds, fractions dropped."""
    return f"CAST(floor(epoch({col})) AS BIGINT)"


def day_text(col: str) -> str:
    return f"strftime(CAST({col} AS DATE), '%Y-%m-%d')"
