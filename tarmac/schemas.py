"""Declared schemas of the seven domain tables and of the mart."""

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

AMOUNT = DecimalType(12, 2)

AIRCRAFTS_DATA = StructType(
    [
        StructField("aircraft_code", StringType()),
        StructField("model", StringType()),
        StructField("range", IntegerType()),
    ]
)

COORDINATES = StructType([StructField("lon", DoubleType()), StructField("lat", DoubleType())])

AIRPORTS_DATA = StructType(
    [
        StructField("airport_code", StringType()),
        StructField("airport_name", StringType()),
        StructField("city", StringType()),
        StructField("coordinates", COORDINATES),
        StructField("timezone", StringType()),
    ]
)

BOOKINGS = StructType(
    [
        StructField("book_ref", StringType()),
        StructField("book_date", TimestampNTZType()),
        StructField("total_amount", AMOUNT),
    ]
)

DEPARTURES = StructType(
    [
        StructField("flight_id", LongType()),
        StructField("flight_no", StringType()),
        StructField("scheduled_departure", TimestampNTZType()),
        StructField("scheduled_arrival", TimestampNTZType()),
        StructField("departure_airport", StringType()),
        StructField("arrival_airport", StringType()),
        StructField("status", StringType()),
        StructField("aircraft_code", StringType()),
        StructField("actual_departure", TimestampNTZType()),
        StructField("actual_arrival", TimestampNTZType()),
    ]
)

SEATS = StructType(
    [
        StructField("aircraft_code", StringType()),
        StructField("seat_no", StringType()),
        StructField("fare_conditions", StringType()),
    ]
)

SEGMENTS = StructType(
    [
        StructField("ticket_no", StringType()),
        StructField("flight_id", LongType()),
        StructField("fare_conditions", StringType()),
        StructField("amount", AMOUNT),
    ]
)

TICKETS = StructType(
    [
        StructField("ticket_no", StringType()),
        StructField("book_ref", StringType()),
        StructField("passenger_id", StringType()),
        StructField("passenger_name", StringType()),
        StructField("contact_data", StringType()),
    ]
)

DOMAIN_SCHEMAS = {
    "aircrafts_data": AIRCRAFTS_DATA,
    "airports_data": AIRPORTS_DATA,
    "bookings": BOOKINGS,
    "departures": DEPARTURES,
    "seats": SEATS,
    "segments": SEGMENTS,
    "tickets": TICKETS,
}

# Output columns of the four parts of a day.
PERIOD_COLUMNS = {
    "Early Morning": "departures_early_morning",
    "Morning": "departures_morning",
    "Afternoon": "departures_afternoon",
    "Evening": "departures_evening",
}

# Output of the daily mart, in column order.
MART_COLUMNS = [
    "date",
    "airport_name",
    "bookings",
    "revenue",
    "airtime_minutes",
    *PERIOD_COLUMNS.values(),
    "avg_delay_seconds",
    "avg_occupancy_percent",
    "avg_occupancy_economy",
    "avg_occupancy_business",
    "avg_occupancy_comfort",
]

MART = StructType(
    [
        StructField("date", StringType()),
        StructField("airport_name", StringType()),
        StructField("bookings", LongType()),
        StructField("revenue", LongType()),
        StructField("airtime_minutes", DoubleType()),
        *[StructField(c, LongType()) for c in PERIOD_COLUMNS.values()],
        StructField("avg_delay_seconds", DoubleType()),
        StructField("avg_occupancy_percent", DoubleType()),
        StructField("avg_occupancy_economy", DoubleType()),
        StructField("avg_occupancy_business", DoubleType()),
        StructField("avg_occupancy_comfort", DoubleType()),
    ]
)
