"""Great-circle distance and the small table of known cities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Known cities with latitude and longitude in degrees.
CITIES = [
    ("mumbai", 19.0760, 72.8777),
    ("delhi", 28.6139, 77.2090),
    ("bangalore", 12.9716, 77.5946),
    ("bengaluru", 12.9716, 77.5946),
    ("hyderabad", 17.3850, 78.4867),
    ("chennai", 13.0827, 80.2707),
    ("kolkata", 22.5726, 88.3639),
    ("pune", 18.5204, 73.8567),
    ("ahmedabad", 23.0225, 72.5714),
    ("london", 51.5074, -0.1278),
    ("new york", 40.7128, -74.0060),
    ("singapore", 1.3521, 103.8198),
    ("dubai", 25.2048, 55.2708),
    ("tokyo", 35.6762, 139.6503),
    ("sydney", -33.8688, 151.2093),
    ("paris", 48.8566, 2.3522),
    ("frankfurt", 50.1109, 8.6821),
    ("san francisco", 37.7749, -122.4194),
    ("hong kong", 22.3193, 114.1694),
]

# Fixed value: mean radius of the earth in kilometres.
EARTH_RADIUS_KM = 6371.0


def city_table(spark: SparkSession) -> DataFrame:
    """The known cities as a DataFrame; its 19 rows are safe to broadcast."""
    rows = ", ".join(f"('{city}', {lat}D, {lon}D)" for city, lat, lon in CITIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS city(city_key, lat, lon)")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in kilometres between two points given in degrees."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    )
    return F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_KM)


def round_half_up(value: Column) -> Column:
    """Round a non-negative double to a long, halves upwards."""
    return F.floor(value + 0.5)
