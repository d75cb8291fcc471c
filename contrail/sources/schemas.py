"""One explicit schema per source."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Flight records as delivered, followed by lineage tags and load stamps.
RAW_FLIGHTS = _struct(
    ("icao24", T.StringType()),
    ("firstSeen", T.LongType()),
    ("estDepartureAirport", T.StringType()),
    ("lastSeen", T.LongType()),
    ("estArrivalAirport", T.StringType()),
    ("callsign", T.StringType()),
    ("estDepartureAirportHorizDistance", T.IntegerType()),
    ("estDepartureAirportVertDistance", T.IntegerType()),
    ("estArrivalAirportHorizDistance", T.IntegerType()),
    ("estArrivalAirportVertDistance", T.IntegerType()),
    ("departureAirportCandidatesCount", T.IntegerType()),
    ("arrivalAirportCandidatesCount", T.IntegerType()),
    ("_source_airport", T.StringType()),
    ("_source_direction", T.StringType()),
    ("loaded_at", T.TimestampType()),
    ("source_date", T.DateType()),
)

# Position of every element in a state vector; "sensors" is not stored.
STATE_VECTOR = _struct(
    ("icao24", T.StringType()),
    ("callsign", T.StringType()),
    ("origin_country", T.StringType()),
    ("time_position", T.LongType()),
    ("last_contact", T.LongType()),
    ("longitude", T.DoubleType()),
    ("latitude", T.DoubleType()),
    ("baro_altitude", T.DoubleType()),
    ("on_ground", T.BooleanType()),
    ("velocity", T.DoubleType()),
    ("true_track", T.DoubleType()),
    ("vertical_rate", T.DoubleType()),
    ("sensors", T.StringType()),
    ("geo_altitude", T.DoubleType()),
    ("squawk", T.StringType()),
    ("spi", T.BooleanType()),
    ("position_source", T.IntegerType()),
)

RAW_AIRCRAFT_STATES = T.StructType(
    [f for f in STATE_VECTOR.fields if f.name != "sensors"]
    + [T.StructField("loaded_at", T.TimestampType(), True)])

AIRPORT_METADATA = _struct(
    ("airport_id", T.StringType()),
    ("airport_name", T.StringType()),
    ("city", T.StringType()),
    ("country_code", T.StringType()),
    ("country_name", T.StringType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("timezone", T.StringType()),
    ("airport_type", T.StringType()),
)

MILITARY_RANGES = _struct(
    ("range_start", T.StringType()),
    ("range_end", T.StringType()),
    ("country_code", T.StringType()),
    ("country_name", T.StringType()),
    ("military_branch", T.StringType()),
    ("notes", T.StringType()),
)
