from datetime import date, datetime

from helpers import raw
from incidentlens.functions import scalars as S
from incidentlens.operators import features, filters
from incidentlens.operators.staging import typed
from pyspark.sql import functions as F


def at_hours(spark, hours):
    return typed(raw(spark, [(str(h), f"2024-01-06T{h:02d}:00:00", {}) for h in hours]))


def test_time_periods_and_bands(spark):
    df = features.temporal_features(at_hours(spark, [0, 6, 7, 12, 13, 18, 19, 23]))
    got = [r.time_period for r in df.orderBy("hour").collect()]
    assert got == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening"]
    morning = filters.dashboard_filter(df, hours="Morning")
    assert sorted(r.hour for r in morning.collect()) == [6, 7]


def test_night_flag(spark):
    df = at_hours(spark, [5, 6, 21, 22, 23])
    assert not any(r.is_night for r in features.temporal_features(df).collect())
    wrapped = features.temporal_features(df, wrap_night=True)
    assert {r.hour for r in wrapped.filter("is_night").collect()} == {5, 22, 23}


def test_calendar_features(spark):
    row = features.temporal_features(typed(raw(spark, [("1", "2024-12-30T08:00:00", {})]))).first()
    assert (row.day_of_week, row.week_of_year, row.quarter, row.season) == (0, 1, 4, "Winter")
    assert row.is_rush_hour and not row.is_weekend


def test_codes_and_coordinates(spark):
    rows = [
        ("1", "2024-01-01T00:00:00", {"district": "004", "beat": "x", "ward": "4.5", "latitude": "41.8781", "longitude": "-87.6298"}),
        ("2", "2024-01-01T00:00:00", {"latitude": "41.9", "location_description": "HOTEL/MOTEL"}),
    ]
    a, b = features.spatial_features(typed(raw(spark, rows))).orderBy("id").collect()
    assert (a.district_num, a.beat_num, a.ward_num, a.community_area_num) == (4.0, None, 4.5, None)
    assert a.has_coordinates and abs(a.distance_from_center) < 1e-9
    assert not b.has_coordinates and b.distance_from_center is None and b.location_type == "Indoor"


def test_haversine_against_known_distance(spark):
    d = spark.range(1).select(S.haversine_miles(F.lit(42.8781), F.lit(-87.6298)).alias("d")).first().d
    assert abs(d - 69.0976) < 1e-3


def test_crime_features(spark):
    rows = [(str(i), "2024-01-01T00:00:00", {"primary_type": t, "arrest": a}) for i, (t, a) in enumerate(
        [("THEFT", True), ("THEFT", False), ("ROBBERY", True), (None, True)])]
    out = {r.id: r for r in features.crime_features(typed(raw(spark, rows))).collect()}
    assert out["0"].crime_type_arrest_rate == 0.5 and out["2"].is_violent_crime
    assert out["3"].crime_category == "Other" and out["3"].is_violent_crime is False
    assert out["3"].crime_type_arrest_rate is None


def test_rolling_means_count_days_present(spark):
    rows = [("a", "2024-01-01T00:00:00", {}), ("b", "2024-01-01T01:00:00", {}), ("c", "2024-02-01T00:00:00", {})]
    out = {r.id: r for r in features.lag_features(typed(raw(spark, rows))).collect()}
    assert out["c"].daily_crime_count == 1 and out["c"].crimes_7day_avg == 1.5
    assert out["a"].crimes_30day_avg == 2.0


def test_full_feature_table_and_storage_rounding(spark):
    rows = [("1", "2024-01-01T00:00:00", {"ward": "4.5", "latitude": "41.123456785", "longitude": "-87.5"})]
    full = features.all_features(typed(raw(spark, rows)))
    assert len(full.columns) == 43
    stored = features.features_for_storage(full)
    assert len(stored.columns) == 44
    row = stored.first()
    assert row.ward_num == 5 and str(row.latitude) == "41.12345679"


def test_recent_windows(spark):
    df = features.row_features(typed(raw(spark, [
        ("old", "2023-01-30T23:00:00", {"latitude": "41.8", "longitude": "-87.6"}),
        ("year", "2023-02-01T00:00:00", {"latitude": "41.8", "longitude": "-87.6"}),
        ("month", "2024-01-02T00:00:00", {"latitude": "41.8", "longitude": "-87.6"}),
        ("outside", "2024-01-02T00:00:00", {"latitude": "43.8", "longitude": "-87.6"}),
    ])))
    ids = lambda period: {r.id for r in filters.spatial_scan(df, time_period=period, as_of=date(2024, 2, 1)).collect()}
    assert ids(None) == {"old", "year", "month"} == ids("whenever")
    assert ids("recent_year") == {"year", "month"}
    assert ids("recent_month") == {"month"}
    assert filters.recent_or_all(df, 2, as_of=date(2024, 2, 1)).count() == 3
    assert not filters.enough_rows(df, 5) and filters.enough_rows(df, 4)


def test_dashboard_filter(spark):
    df = typed(raw(spark, [
        ("1", "2024-01-01T00:00:00", {"primary_type": "A"}),
        ("2", "2024-01-02T23:59:59", {"primary_type": "B"}),
        ("3", "2024-01-03T00:00:00", {"primary_type": "A"}),
    ]))
    ids = lambda **kw: sorted(r.id for r in filters.dashboard_filter(df, **kw).collect())
    assert ids(start=date(2024, 1, 1), end=date(2024, 1, 2)) == ["1", "2"]
    assert ids(crime_types=["A"]) == ["1", "3"] and ids(crime_types=[]) == ["1", "2", "3"]
    assert ids(hours="Night") == ["1", "3"]


def test_filters_reach_the_stored_feature_table(spark, tmp_path):
    rows = [("1", "2024-01-01T00:00:00", {"primary_type": "THEFT", "latitude": "41.8", "longitude": "-87.6"})]
    path = str(tmp_path / "features")
    features.features_for_storage(features.all_features(typed(raw(spark, rows)))).write.parquet(path)
    stored = spark.read.parquet(path)
    scan = filters.spatial_scan(stored, "THEFT", "recent_year", date(2024, 2, 1))
    assert scan.count() == 1
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        again = filters.spatial_scan(stored, "THEFT", "recent_year", date(2024, 2, 1))
        plan = again._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    for part in ("GreaterThanOrEqual(latitude", "LessThanOrEqual(longitude", "EqualTo(primary_type", "GreaterThanOrEqual(date"):
        assert part in pushed
    assert "description" not in plan[plan.index("ReadSchema") :]
