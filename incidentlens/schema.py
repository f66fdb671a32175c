"""Schemas of the tables the package reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

PAYLOAD_FIELDS = (
    "case_number",
    "primary_type",
    "description",
    "location_description",
    "arrest",
    "domestic",
    "beat",
    "district",
    "ward",
    "community_area",
    "year",
    "latitude",
    "longitude",
)

RAW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("record_data", T.StringType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
        T.StructField("source", T.StringType()),
    ]
)

RAW_PARTITION = "day"

CORRUPT = "_corrupt_record"

# Every payload field is read as text; a record that is not a JSON object ends
# up whole in the corrupt column instead of failing the job.
PAYLOAD = T.StructType(
    [T.StructField(f, T.StringType()) for f in (*PAYLOAD_FIELDS, CORRUPT)]
)

# Storage types of the feature table.  Values are rounded to these on write.
FEATURE_TYPES = {
    "id": "string",
    "date": "timestamp_ntz",
    "case_number": "string",
    "primary_type": "string",
    "description": "string",
    "location_description": "string",
    "arrest": "boolean",
    "domestic": "boolean",
    "beat": "string",
    "district": "string",
    "ward": "string",
    "community_area": "string",
    "latitude": "decimal(10,8)",
    "longitude": "decimal(11,8)",
    "year": "int",
    "hour": "int",
    "day_of_week": "int",
    "day_of_month": "int",
    "month": "int",
    "quarter": "int",
    "week_of_year": "int",
    "is_weekend": "boolean",
    "is_night": "boolean",
    "is_rush_hour": "boolean",
    "season": "string",
    "time_period": "string",
    "has_coordinates": "boolean",
    "district_num": "int",
    "beat_num": "int",
    "ward_num": "int",
    "community_area_num": "int",
    "location_type": "string",
    "distance_from_center": "decimal(8,2)",
    "crime_category": "string",
    "is_violent_crime": "boolean",
    "is_property_crime": "boolean",
    "is_drug_crime": "boolean",
    "crime_type_arrest_rate": "decimal(5,4)",
    "daily_crime_count": "int",
    "crimes_7day_avg": "decimal(8,2)",
    "crimes_30day_avg": "decimal(8,2)",
    "loaded_at": "timestamp_ntz",
    "source": "string",
    "created_at": "timestamp_ntz",
}

CLUSTER_TYPES = {
    "id": "string",
    "date": "timestamp_ntz",
    "primary_type": "string",
    "latitude": "decimal(10,8)",
    "longitude": "decimal(11,8)",
    "cluster_id": "int",
    "model_type": "string",
    "crime_type_filter": "string",
    "created_at": "timestamp_ntz",
}
CLUSTER_KEY = ("id", "model_type", "crime_type_filter")

HOTSPOT_TYPES = {
    "cluster_id": "int",
    "model_type": "string",
    "crime_type_filter": "string",
    "center_latitude": "decimal(10,8)",
    "center_longitude": "decimal(11,8)",
    "cluster_size": "int",
    "risk_score": "decimal(5,2)",
    "top_crime_type": "string",
    "violent_crime_ratio": "decimal(5,4)",
    "property_crime_ratio": "decimal(5,4)",
    "avg_distance_from_center": "decimal(8,2)",
    "peak_hour": "int",
    "weekend_ratio": "decimal(5,4)",
    "districts": "string",
    "created_at": "timestamp_ntz",
}
HOTSPOT_KEY = ("cluster_id", "model_type", "crime_type_filter")

FORECAST_TYPES = {
    "date": "date",
    "forecast": "decimal(10,2)",
    "lower_ci": "decimal(10,2)",
    "upper_ci": "decimal(10,2)",
    "model_type": "string",
    "crime_type": "string",
    "created_at": "timestamp_ntz",
}
FORECAST_KEY = ("date", "model_type", "crime_type")
