"""Parameterised scans and filters; every predicate is a Column, so it reaches
the Parquet scan where the column is stored."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

SPATIAL_COLUMNS = (
    "id",
    "date",
    "primary_type",
    "latitude",
    "longitude",
    "district_num",
    "beat_num",
    "ward_num",
    "community_area_num",
    "crime_category",
    "is_violent_crime",
    "is_property_crime",
    "distance_from_center",
    "hour",
    "day_of_week",
    "is_weekend",
    "season",
)

LOOK_BACK_MONTHS = {"recent_year": 12, "recent_month": 1}


def recent(col: Column, time_period: str | None, as_of: date | None) -> Column:
    """Within a year / a month before `as_of`; any other period keeps all."""
    months = LOOK_BACK_MONTHS.get(time_period)
    if months is None:
        return F.lit(True)
    today = F.lit(as_of) if as_of else F.current_date()
    return col >= F.add_months(today, -months).cast("timestamp_ntz")


def spatial_scan(
    features: DataFrame,
    crime_type: str | None = None,
    time_period: str | None = None,
    as_of: date | None = None,
    box=S.BOUNDING_BOX,
    violent_only: bool = False,
) -> DataFrame:
    """Clustering input: located incidents inside the bounding box."""
    keep = S.in_bounding_box(F.col("latitude"), F.col("longitude"), box)
    if crime_type:
        keep &= F.col("primary_type") == crime_type
    if violent_only:
        keep &= F.col("is_violent_crime")
    keep &= recent(F.col("date"), time_period, as_of)
    return features.filter(keep).select(*SPATIAL_COLUMNS)


def enough_rows(df: DataFrame, minimum: int) -> bool:
    """Whether there are at least `minimum` rows; stops reading once there are."""
    return df.limit(minimum).count() >= minimum


def recent_or_all(features: DataFrame, minimum: int = 100, **scan) -> DataFrame:
    """The recent month, or all rows when it has fewer than `minimum`."""
    last_month = spatial_scan(features, time_period="recent_month", **scan)
    return last_month if enough_rows(last_month, minimum) else spatial_scan(features, **scan)


def dashboard_filter(
    df: DataFrame,
    start: date | None = None,
    end: date | None = None,
    crime_types: list[str] | None = None,
    hours: str | None = None,
) -> DataFrame:
    """Inclusive calendar range, types (none = all) and a band of hours.

    The range is compared with the timestamp itself, not with a date computed
    from it, so row groups outside it are skipped."""
    keep = F.lit(True)
    if start:
        keep &= F.col("date") >= F.lit(start).cast("timestamp_ntz")
    if end:
        keep &= F.col("date") < F.lit(end + timedelta(days=1)).cast("timestamp_ntz")
    if crime_types:
        keep &= F.col("primary_type").isin(*crime_types)
    if hours:
        keep &= F.hour("date").between(*S.HOUR_BANDS[hours])
    return df.filter(keep)


def risk_band(hotspots: DataFrame, band: str | None = None) -> DataFrame:
    return hotspots.filter(S.RISK_BANDS[band](F.col("risk_score"))) if band else hotspots


def of_model(results: DataFrame, model_type: str) -> DataFrame:
    return results.filter(F.col("model_type") == model_type)
