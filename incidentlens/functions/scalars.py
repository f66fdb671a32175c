"""Scalar column expressions shared by the operators."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the published classification) -----------------
VIOLENT = ("HOMICIDE", "CRIMINAL SEXUAL ASSAULT", "ROBBERY", "ASSAULT", "BATTERY")
PROPERTY = ("BURGLARY", "THEFT", "MOTOR VEHICLE THEFT", "ARSON", "CRIMINAL DAMAGE")
DRUG = ("NARCOTICS", "OTHER NARCOTIC VIOLATION")
INDOOR = ("RESIDENCE", "APARTMENT", "HOUSE", "HOTEL/MOTEL", "RESTAURANT")
OUTDOOR = ("STREET", "SIDEWALK", "PARKING LOT/GARAGE(NON.RESID.)", "ALLEY")
COMMERCIAL = ("RETAIL STORE", "GROCERY FOOD STORE", "COMMERCIAL / BUSINESS OFFICE")
CITY_CENTER = (41.8781, -87.6298)
HIGH_CRIME_AREAS = ((41.8781, -87.6298), (41.8369, -87.6847), (41.7687, -87.6746))
EARTH_RADIUS_MILES = 3959.0
MILES_PER_DEGREE = 69.0
BOUNDING_BOX = {"latitude": (41.6, 42.1), "longitude": (-87.9, -87.5)}
# -----------------------------------------------------------------------------


def is_in(col: Column, values) -> Column:
    """Membership test that is false, not null, for a null value."""
    return F.coalesce(col.isin(*values), F.lit(False))


def is_true_text(col: Column) -> Column:
    return F.coalesce(col == "true", F.lit(False))


def safe_double(col: Column) -> Column:
    """Finite decimal number or null.  A number ends in a digit or a point; this
    excludes `nan`, `inf` and the type suffixes a Java parser would accept."""
    text = F.trim(col)
    return F.when(F.right(text, F.lit(1)).isin(*"0123456789."), text.try_cast("double"))


def safe_int(col: Column) -> Column:
    return F.trim(col).try_cast("int")


def rate_percent(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(F.lit(100.0) * part / whole, places)


def change_percent(now: Column, before: Column, places: int = 2) -> Column:
    """Percentage change, null unless there is a positive base."""
    return F.when(before > 0, F.round(F.lit(100.0) * (now - before) / before, places))


def season_of(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .when(month.isin(9, 10, 11), "Fall")
    )


def season_rank(season: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, ("Winter", "Spring", "Summer", "Fall"))), season)


def time_period_of(hour: Column) -> Column:
    """Four right-closed bands: up to 6, 12, 18 and 24 o'clock."""
    return (
        F.when(hour <= 6, "Night")
        .when(hour <= 12, "Morning")
        .when(hour <= 18, "Afternoon")
        .when(hour <= 24, "Evening")
    )


# Dashboard bands; they differ from time_period_of at 6, 12 and 18 o'clock.
HOUR_BANDS = {
    "Morning": (6, 11),
    "Afternoon": (12, 17),
    "Evening": (18, 23),
    "Night": (0, 5),
}


def is_night_hour(hour: Column, wrap_night: bool = False) -> Column:
    """22-5 o'clock.  An interval from 22 up to 5 is empty, and published risk
    scores rest on that; `wrap_night` gives the interval across midnight."""
    if wrap_night:
        return (hour >= 22) | (hour <= 5)
    return hour.between(22, 5)


def is_rush_hour(hour: Column) -> Column:
    return hour.between(7, 9) | hour.between(17, 19)


def location_type_of(place: Column) -> Column:
    return (
        F.when(place.isin(*INDOOR), "Indoor")
        .when(place.isin(*OUTDOOR), "Outdoor")
        .when(place.isin(*COMMERCIAL), "Commercial")
        .otherwise("Other")
    )


def crime_category_of(kind: Column) -> Column:
    return (
        F.when(kind.isin(*VIOLENT), "Violent")
        .when(kind.isin(*PROPERTY), "Property")
        .when(kind.isin(*DRUG), "Drug")
        .otherwise("Other")
    )


def haversine_miles(lat: Column, lon: Column, center=CITY_CENTER) -> Column:
    lat0, lon0 = (math.radians(v) for v in center)
    phi, lam = F.radians(lat), F.radians(lon)
    h = (
        F.pow(F.sin((F.lit(lat0) - phi) / 2), 2)
        + F.cos(phi) * math.cos(lat0) * F.pow(F.sin((F.lit(lon0) - lam) / 2), 2)
    )
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(h))


def planar_miles(lat: Column, lon: Column, point) -> Column:
    return F.sqrt(F.pow(lat - point[0], 2) + F.pow(lon - point[1], 2)) * MILES_PER_DEGREE


def linspace_bin(x: Column, low: Column, high: Column, edges: int) -> Column:
    """0-based right-closed bin among `edges` equally spaced edges; the lowest
    edge lies in no bin, so the minimum itself gives null."""
    step = (high - low) / (edges - 1)
    raw = F.ceil((x - low) / step).cast("int") - 1
    return F.when((x > low) & (x <= high), F.least(raw, F.lit(edges - 2)))


def equal_width_bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based right-closed bin; the minimum belongs to the first bin.  If all
    values are equal they lie in the middle of a slightly widened range."""
    raw = F.ceil((x - low) / ((high - low) / bins)).cast("int") - 1
    clamped = F.greatest(F.least(raw, F.lit(bins - 1)), F.lit(0))
    return F.when(high > low, clamped).when(x.isNotNull(), F.lit((bins + 1) // 2 - 1))


def in_bounding_box(lat: Column, lon: Column, box=BOUNDING_BOX) -> Column:
    """Decimal bounds compare with stored decimals and with doubles without a
    cast of the column, so the scan can skip row groups."""
    low_high = lambda side: [F.lit(Decimal(str(v))) for v in box[side]]
    return lat.between(*low_high("latitude")) & lon.between(*low_high("longitude"))


def trend_of(now: Column, before: Column) -> Column:
    ratio = (now - before) / before
    return (
        F.when((before > 0) & (ratio > 0.1), "Growing")
        .when((before > 0) & (ratio < -0.1), "Declining")
        .otherwise("Stable")
    )


def risk_level_of(score: Column) -> Column:
    return (
        F.when(score >= 80, "CRITICAL")
        .when(score >= 60, "HIGH")
        .when(score >= 40, "MODERATE")
        .otherwise("LOW")
    )


# The dashboard's band filter; scores between 79 and 80 or 59 and 60 match none.
RISK_BANDS = {
    "Critical (80+)": lambda s: s >= 80,
    "High (60-79)": lambda s: s.between(60, 79),
    "Moderate (40-59)": lambda s: s.between(40, 59),
    "Low (<40)": lambda s: s < 40,
}


def distance_band_of(miles: Column) -> Column:
    return (
        F.when(miles < 5, "Downtown (0-5 mi)")
        .when(miles < 10, "Inner City (5-10 mi)")
        .when(miles < 15, "Outer City (10-15 mi)")
        .otherwise("Suburbs (15+ mi)")
    )


def location_text(lat: Column, lon: Column) -> Column:
    return F.format_string("(%.4f, %.4f)", lat, lon)


def percent_text(ratio: Column) -> Column:
    return F.format_string("%.1f%%", ratio * 100)
