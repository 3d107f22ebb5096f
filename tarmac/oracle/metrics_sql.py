"""Oracle SQL for the business queries (airports, spine, metrics, mart).

Written from the metric definitions in plain joins, independently of the
Spark plans (e.g. the bookings count is the literal left-join chain here,
while Spark re-associates it).
"""

from tarmac.oracle.binding import day_text, epoch_s, r2, with_domain
from tarmac.schemas import PERIOD_COLUMNS

_COMPLETED = "f.actual_departure IS NOT NULL AND f.actual_arrival IS NOT NULL"
_ARRIVED = f"f.flight_id IS NOT NULL AND {_COMPLETED} AND f.status = 'Arrived'"

_PERIOD_COUNTS = ", ".join(
    f"CAST(count_if(hour(f.scheduled_departure) >= {6 * i} AND hour(f.scheduled_departure) < {6 * i + 6}) AS BIGINT) AS {c}"
    for i, c in enumerate(PERIOD_COLUMNS.values())
)

# Each metric as (CTE name, SELECT ...) so the mart can reuse them.
METRIC_CTES = {
    "m_bookings": f"""
SELECT {day_text('b.book_date')} AS book_date, a.airport_name, count(*) AS bookings
FROM bookings b
LEFT JOIN tickets t ON b.book_ref = t.book_ref
LEFT JOIN segments tf ON t.ticket_no = tf.ticket_no
LEFT JOIN departures f ON tf.flight_id = f.flight_id
LEFT JOIN names a ON f.departure_airport = a.airport_code
GROUP BY 1, 2""",
    "m_revenue": f"""
SELECT {day_text('f.scheduled_departure')} AS date, a.airport_name,
       CAST(trunc(sum(r.flight_revenue)) AS BIGINT) AS revenue
FROM departures f
LEFT JOIN names a ON f.departure_airport = a.airport_code
LEFT JOIN (SELECT flight_id, sum(amount) AS flight_revenue FROM segments GROUP BY flight_id) r
  ON f.flight_id = r.flight_id
WHERE {_ARRIVED}
GROUP BY 1, 2""",
    "m_airtime": f"""
SELECT {day_text('f.scheduled_departure')} AS date, a.airport_name,
       {r2(f"sum({epoch_s('f.actual_arrival')} - {epoch_s('f.actual_departure')}) / 60")} AS airtime_minutes
FROM departures f LEFT JOIN names a ON f.departure_airport = a.airport_code
WHERE {_ARRIVED}
GROUP BY 1, 2""",
    "m_periods": f"""
SELECT {day_text('f.scheduled_departure')} AS date, a.airport_name,
       {_PERIOD_COUNTS}
FROM departures f LEFT JOIN names a ON f.departure_airport = a.airport_code
WHERE {_ARRIVED}
GROUP BY 1, 2""",
    # one row a day and airport code, then the code's name
    "m_delay": f"""
SELECT d.date, a.airport_name, d.avg_delay_seconds
FROM (SELECT f.departure_airport, {day_text('f.scheduled_departure')} AS date,
             {r2(f"CAST(sum({epoch_s('f.actual_departure')} - {epoch_s('f.scheduled_departure')}) AS DOUBLE) / count(*)")}
               AS avg_delay_seconds
      FROM departures f WHERE {_COMPLETED} GROUP BY 1, 2) d
LEFT JOIN names a ON d.departure_airport = a.airport_code""",
    # the mart's: codes that share a name together
    "m_delay_by_name": f"""
SELECT {day_text('f.scheduled_departure')} AS date, a.airport_name,
       {r2(f"CAST(sum({epoch_s('f.actual_departure')} - {epoch_s('f.scheduled_departure')}) AS DOUBLE) / count(*)")}
         AS avg_delay_seconds
FROM departures f LEFT JOIN names a ON f.departure_airport = a.airport_code
WHERE {_COMPLETED}
GROUP BY 1, 2""",
    "m_occupancy": f"""
SELECT {day_text('f.scheduled_departure')} AS date, a.airport_name,
       coalesce({r2("sum(p.passengers) / nullif(sum(c.seats), 0) * 100")}, 0.0) AS avg_occupancy_percent
FROM departures f
LEFT JOIN (SELECT flight_id, count(*) AS passengers FROM segments GROUP BY flight_id) p
  ON f.flight_id = p.flight_id
LEFT JOIN (SELECT aircraft_code, count(*) AS seats FROM seats GROUP BY aircraft_code) c
  ON f.aircraft_code = c.aircraft_code
LEFT JOIN names a ON f.departure_airport = a.airport_code
WHERE f.flight_id IS NOT NULL AND {_COMPLETED}
GROUP BY 1, 2""",
    "m_fare_class": f"""
SELECT {day_text('f.scheduled_departure')} AS date, a.airport_name,
       coalesce({r2("sum(p.pe) / nullif(sum(c.se), 0) * 100")}, 0.0) AS avg_occupancy_economy,
       coalesce({r2("sum(p.pb) / nullif(sum(c.sb), 0) * 100")}, 0.0) AS avg_occupancy_business,
       coalesce({r2("sum(p.pc) / nullif(sum(c.sc), 0) * 100")}, 0.0) AS avg_occupancy_comfort
FROM departures f
LEFT JOIN (SELECT flight_id, count_if(fare_conditions = 'Economy') AS pe,
                  count_if(fare_conditions = 'Business') AS pb, count_if(fare_conditions = 'Comfort') AS pc
           FROM segments GROUP BY flight_id) p
  ON f.flight_id = p.flight_id
LEFT JOIN (SELECT aircraft_code, count_if(fare_conditions = 'Economy') AS se,
                  count_if(fare_conditions = 'Business') AS sb, count_if(fare_conditions = 'Comfort') AS sc
           FROM seats WHERE aircraft_code IN (SELECT aircraft_code FROM aircrafts_data)
           GROUP BY aircraft_code) c
  ON f.aircraft_code = c.aircraft_code
LEFT JOIN names a ON f.departure_airport = a.airport_code
WHERE f.flight_id IS NOT NULL AND {_COMPLETED}
GROUP BY 1, 2""",
}

SPINE_CTE = """
spine AS (
  SELECT d.day, n.airport_name
  FROM (SELECT CAST(scheduled_departure AS DATE) AS day FROM departures
        UNION SELECT CAST(book_date AS DATE) FROM bookings) d
  CROSS JOIN (SELECT DISTINCT airport_name FROM airports_clean) n)"""


def _metric(name: str) -> str:
    return with_domain(METRIC_CTES[name])


def _mart_sql() -> str:
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in METRIC_CTES.items()) + "," + SPINE_CTE
    periods = ", ".join(f"coalesce(p.{c}, 0) AS {c}" for c in PERIOD_COLUMNS.values())
    body = f"""
SELECT strftime(s.day, '%Y-%m-%d') AS date, s.airport_name,
       coalesce(b.bookings, 0) AS bookings,
       coalesce(r.revenue, 0) AS revenue,
       coalesce(t.airtime_minutes, 0.0) AS airtime_minutes,
       {periods},
       coalesce(d.avg_delay_seconds, 0.0) AS avg_delay_seconds,
       coalesce(o.avg_occupancy_percent, 0.0) AS avg_occupancy_percent,
       coalesce(c.avg_occupancy_economy, 0.0) AS avg_occupancy_economy,
       coalesce(c.avg_occupancy_business, 0.0) AS avg_occupancy_business,
       coalesce(c.avg_occupancy_comfort, 0.0) AS avg_occupancy_comfort
FROM spine s
LEFT JOIN m_bookings b ON b.book_date = strftime(s.day, '%Y-%m-%d') AND b.airport_name = s.airport_name
LEFT JOIN m_revenue r ON r.date = strftime(s.day, '%Y-%m-%d') AND r.airport_name = s.airport_name
LEFT JOIN m_airtime t ON t.date = strftime(s.day, '%Y-%m-%d') AND t.airport_name = s.airport_name
LEFT JOIN m_periods p ON p.date = strftime(s.day, '%Y-%m-%d') AND p.airport_name = s.airport_name
LEFT JOIN m_delay_by_name d ON d.date = strftime(s.day, '%Y-%m-%d') AND d.airport_name = s.airport_name
LEFT JOIN m_occupancy o ON o.date = strftime(s.day, '%Y-%m-%d') AND o.airport_name = s.airport_name
LEFT JOIN m_fare_class c ON c.date = strftime(s.day, '%Y-%m-%d') AND c.airport_name = s.airport_name
ORDER BY 1 NULLS FIRST, 2 NULLS FIRST"""
    return with_domain(body, ctes)


MART_SQL = _mart_sql()

BUSINESS_SQL = {
    "airports_clean": with_domain(
        "SELECT airport_code, lon, lat, timezone, airport_name, city_name FROM airports_clean"
    ),
    "date_airport_spine": with_domain("SELECT strftime(day, '%Y-%m-%d') AS date, airport_name FROM spine", SPINE_CTE),
    "cross_join_spine": with_domain(
        "SELECT d.day, a.airport_code FROM (SELECT DISTINCT CAST(scheduled_departure AS DATE) AS day FROM departures) d "
        "CROSS JOIN airports_data a"
    ),
    "daily_bookings": _metric("m_bookings"),
    "daily_revenue": _metric("m_revenue"),
    "daily_airtime": _metric("m_airtime"),
    "daily_departures_by_day_period": _metric("m_periods"),
    "daily_departure_delay": _metric("m_delay"),
    "daily_occupancy": _metric("m_occupancy"),
    "daily_occupancy_by_fare_class": _metric("m_fare_class"),
    "daily_airport_mart": MART_SQL,
    "daily_airport_mart_assembled": MART_SQL,
    "incremental_mart": MART_SQL,
    "overwrite_table": MART_SQL,
    "scan_dump": with_domain("SELECT ticket_no, flight_id, fare_conditions, CAST(amount AS DOUBLE) AS amount FROM segments"),
    "staged_write": _metric("m_revenue"),
    "versioned_overwrite": with_domain(
        "SELECT date, airport_name, substr(date, 1, 4) AS year, "
        "CASE WHEN CAST(substr(date, 1, 4) AS INT) % 2 = 0 THEN airtime_minutes * 2 ELSE airtime_minutes END AS airtime_minutes "
        f"FROM ({METRIC_CTES['m_airtime']}) m"
    ),
}
