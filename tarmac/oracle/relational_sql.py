"""Oracle SQL for the relational-operator queries (tarmac.plans.relational)."""

from tarmac.oracle.binding import (
    AIRPORT_NAME_RE2,
    CITY_NAME_RE2,
    _joined_values,
    day_text,
    epoch_s,
    r2,
    with_domain,
)
from tarmac.schemas import PERIOD_COLUMNS

_COMPLETED = "f.actual_departure IS NOT NULL AND f.actual_arrival IS NOT NULL"
_WITH_ID = f"f.flight_id IS NOT NULL AND {_COMPLETED}"
_ARRIVED = f"{_WITH_ID} AND f.status = 'Arrived'"

_PERIOD = """CASE WHEN hour(f.scheduled_departure) >= 0 AND hour(f.scheduled_departure) < 6 THEN 'Early Morning'
     WHEN hour(f.scheduled_departure) >= 6 AND hour(f.scheduled_departure) < 12 THEN 'Morning'
     WHEN hour(f.scheduled_departure) >= 12 AND hour(f.scheduled_departure) < 18 THEN 'Afternoon'
     WHEN hour(f.scheduled_departure) >= 18 AND hour(f.scheduled_departure) < 24 THEN 'Evening' END"""

_PIVOTED = ", ".join(
    f"CAST(sum(CASE WHEN day_period = '{label}' THEN n END) AS BIGINT) AS {c}" for label, c in PERIOD_COLUMNS.items()
)
_PIVOT_BODY = f"""
SELECT date, airport_name, {_PIVOTED}
FROM (SELECT {day_text('f.scheduled_departure')} AS date, a.airport_name, {_PERIOD} AS day_period, count(*) AS n
      FROM departures f LEFT JOIN names a ON f.departure_airport = a.airport_code
      WHERE {_ARRIVED}
      GROUP BY 1, 2, 3) c
GROUP BY 1, 2"""

_MULTI_SUM = f"""
SELECT {day_text('f.scheduled_departure')} AS date, a.airport_name,
       CAST(sum(p.passengers) AS BIGINT) AS passengers, CAST(sum(c.seats) AS BIGINT) AS seats_available
FROM departures f
LEFT JOIN (SELECT flight_id, count(*) AS passengers FROM segments GROUP BY flight_id) p
  ON f.flight_id = p.flight_id
LEFT JOIN (SELECT aircraft_code, count(*) AS seats FROM seats GROUP BY aircraft_code) c
  ON f.aircraft_code = c.aircraft_code
LEFT JOIN names a ON f.departure_airport = a.airport_code
WHERE {_WITH_ID}
GROUP BY 1, 2"""

_REVENUE_CTE = "rev AS (SELECT flight_id, sum(amount) AS flight_revenue FROM segments GROUP BY flight_id)"
_AIRTIME = f"{epoch_s('f.actual_arrival')} - {epoch_s('f.actual_departure')}"

RELATIONAL_SQL = {
    "scan_table": "SELECT * FROM orders",
    "project_columns": with_domain(
        "SELECT flight_id, flight_no, departure_airport, arrival_airport, status, aircraft_code FROM departures"
    ),
    "project_expression": with_domain(
        f"SELECT f.flight_id, {day_text('f.scheduled_departure')} AS date, f.departure_airport "
        f"FROM departures f WHERE {_WITH_ID}"
    ),
    "derive_column": with_domain(
        f"SELECT f.flight_id, {epoch_s('f.actual_departure')} - {epoch_s('f.scheduled_departure')} AS delay_seconds, "
        f"{_AIRTIME} AS airtime_seconds FROM departures f"
    ),
    "rename_columns": with_domain("SELECT aircraft_code AS code, seat_no, fare_conditions AS fare_class FROM seats"),
    "drop_columns": with_domain("SELECT ticket_no, book_ref, passenger_id FROM tickets"),
    "filter_equals": with_domain("SELECT flight_id, status, departure_airport FROM departures WHERE status = 'Arrived'"),
    "drop_null_rows": with_domain(
        f"SELECT f.flight_id, f.actual_departure, f.actual_arrival FROM departures f WHERE {_COMPLETED}"
    ),
    "fill_null_all_numeric": with_domain(
        "SELECT date, airport_name, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in PERIOD_COLUMNS.values()) + " FROM pv",
        f"pv AS ({_PIVOT_BODY})",
    ),
    "fill_null_subset": with_domain(
        """
SELECT d.aircraft_code, coalesce(c.seats_economy, 0) AS seats_economy,
       coalesce(c.seats_business, 0) AS seats_business, coalesce(c.seats_comfort, 0) AS seats_comfort
FROM (SELECT DISTINCT aircraft_code FROM aircrafts_data) d
LEFT JOIN (SELECT aircraft_code,
                  CAST(count_if(fare_conditions = 'Economy') AS BIGINT) AS seats_economy,
                  CAST(count_if(fare_conditions = 'Business') AS BIGINT) AS seats_business,
                  CAST(count_if(fare_conditions = 'Comfort') AS BIGINT) AS seats_comfort
           FROM seats GROUP BY aircraft_code) c ON d.aircraft_code = c.aircraft_code"""
    ),
    "range_predicate": with_domain(
        "SELECT flight_id, CAST(hour(scheduled_departure) AS BIGINT) AS hour FROM departures "
        "WHERE hour(scheduled_departure) >= 6 AND hour(scheduled_departure) < 12"
    ),
    "left_join_single_key": with_domain(
        "SELECT tf.flight_id, tf.ticket_no, tf.fare_conditions, f.departure_airport, f.status "
        "FROM segments tf LEFT JOIN departures f ON tf.flight_id = f.flight_id"
    ),
    "left_join_composite_key": None,  # filled below from the metric CTEs
    "star_join_chain": with_domain(
        """
SELECT b.book_ref, t.ticket_no, tf.flight_id, a.airport_name
FROM bookings b
LEFT JOIN tickets t ON b.book_ref = t.book_ref
LEFT JOIN segments tf ON t.ticket_no = tf.ticket_no
LEFT JOIN departures f ON tf.flight_id = f.flight_id
LEFT JOIN names a ON f.departure_airport = a.airport_code"""
    ),
    "aggregate_then_join": with_domain(
        f"SELECT f.flight_id, f.departure_airport, CAST(r.flight_revenue AS DOUBLE) AS flight_revenue "
        f"FROM departures f LEFT JOIN rev r ON f.flight_id = r.flight_id WHERE {_WITH_ID}",
        _REVENUE_CTE,
    ),
    "group_count": with_domain("SELECT aircraft_code, count(*) AS seats FROM seats GROUP BY aircraft_code"),
    "group_sum": with_domain(
        "SELECT flight_id, CAST(sum(amount) AS DOUBLE) AS flight_revenue FROM segments GROUP BY flight_id"
    ),
    "group_multi_sum": with_domain(_MULTI_SUM),
    "group_avg_rounded": with_domain(
        f"""
SELECT f.departure_airport, {day_text('f.scheduled_departure')} AS date,
       {r2(f"CAST(sum({epoch_s('f.actual_departure')} - {epoch_s('f.scheduled_departure')}) AS DOUBLE) / count(*)")}
         AS avg_delay_seconds
FROM departures f WHERE {_COMPLETED} GROUP BY 1, 2"""
    ),
    "two_level_sum": with_domain(
        f"""
SELECT {day_text('f.scheduled_departure')} AS date, f.departure_airport,
       CAST(sum(r.flight_revenue) AS DOUBLE) AS revenue
FROM departures f LEFT JOIN rev r ON f.flight_id = r.flight_id
WHERE {_ARRIVED} GROUP BY 1, 2""",
        _REVENUE_CTE,
    ),
    "pivot_sum": with_domain(_PIVOT_BODY),
    "conditional_count": with_domain(
        """
SELECT flight_id, CAST(count_if(fare_conditions = 'Economy') AS BIGINT) AS passengers_economy,
       CAST(count_if(fare_conditions = 'Business') AS BIGINT) AS passengers_business,
       CAST(count_if(fare_conditions = 'Comfort') AS BIGINT) AS passengers_comfort
FROM segments GROUP BY flight_id"""
    ),
    "distinct_rows": with_domain("SELECT DISTINCT departure_airport, aircraft_code FROM departures"),
    "ratio_of_sums_percent": with_domain(
        f"SELECT airport_name, coalesce({r2('sum(passengers) / nullif(sum(seats_available), 0) * 100')}, 0.0) "
        "AS occupancy_percent FROM ms GROUP BY airport_name",
        f"ms AS ({_MULTI_SUM})",
    ),
    "order_by_two_keys": None,  # filled below
    "union_distinct": with_domain(
        f"SELECT {day_text('scheduled_departure')} AS date FROM departures "
        f"UNION SELECT {day_text('book_date')} AS date FROM bookings"
    ),
    "json_to_map": with_domain(
        "SELECT airport_code, CAST(len(json_keys(j)) AS BIGINT) AS n_names, json_extract_string(j, '$.en') AS name_en, "
        "json_extract_string(j, '$.ru') AS name_ru "
        "FROM (SELECT airport_code, CASE WHEN json_valid(airport_name) THEN airport_name END AS j FROM airports_data)"
    ),
    "map_values_joined": with_domain(f"SELECT airport_code, {_joined_values('city')} AS city_names FROM airports_data"),
    "regex_leading_words": with_domain(
        f"SELECT airport_code, regexp_extract({_joined_values('airport_name')}, '{AIRPORT_NAME_RE2}', 1) "
        f"AS airport_words, regexp_extract({_joined_values('city')}, '{CITY_NAME_RE2}', 1) AS city_words "
        "FROM airports_data"
    ),
    "day_string": with_domain(f"SELECT flight_id, {day_text('scheduled_departure')} AS date FROM departures"),
    "timestamp_diff_seconds": with_domain(
        f"SELECT f.flight_id, {_AIRTIME} AS airtime_seconds FROM departures f WHERE {_COMPLETED}"
    ),
    "hour_of_day": with_domain("SELECT flight_id, CAST(hour(scheduled_departure) AS BIGINT) AS hour FROM departures"),
    "day_period_bucket": with_domain(f"SELECT f.flight_id, {_PERIOD} AS day_period FROM departures f"),
    "cast_truncate_long": with_domain(
        "SELECT flight_id, CAST(trunc(sum(amount)) AS BIGINT) AS revenue FROM segments GROUP BY flight_id"
    ),
    "round_half_up": with_domain(
        f"""
SELECT f.flight_id, {r2('p.passengers / nullif(c.seats, 0) * 100')} AS occupancy_percent
FROM departures f
LEFT JOIN (SELECT flight_id, count(*) AS passengers FROM segments GROUP BY flight_id) p
  ON f.flight_id = p.flight_id
LEFT JOIN (SELECT aircraft_code, count(*) AS seats FROM seats GROUP BY aircraft_code) c
  ON f.aircraft_code = c.aircraft_code
WHERE {_WITH_ID}"""
    ),
    "minutes_from_seconds": with_domain(
        f"SELECT f.flight_id, ({_AIRTIME}) / 60 AS airtime_minutes FROM departures f WHERE {_ARRIVED}"
    ),
}


def _fill_from_metrics() -> None:
    from tarmac.oracle.metrics_sql import METRIC_CTES

    RELATIONAL_SQL["left_join_composite_key"] = with_domain(
        "SELECT r.date, r.airport_name, r.revenue, t.airtime_minutes FROM m_revenue r "
        "LEFT JOIN m_airtime t ON r.date = t.date AND r.airport_name = t.airport_name",
        f"m_revenue AS ({METRIC_CTES['m_revenue']}), m_airtime AS ({METRIC_CTES['m_airtime']})",
    )
    RELATIONAL_SQL["order_by_two_keys"] = with_domain(
        METRIC_CTES["m_airtime"] + "\nORDER BY 1 NULLS FIRST, 2 NULLS FIRST"
    )


_fill_from_metrics()
