"""Operators on no rows at all, and on values without spread."""

import pytest
from helpers import raw
from incidentlens.operators import clustering, features, filters, hotspots, marts, reports, series
from incidentlens.operators.dbscan import dbscan, quality
from incidentlens.operators.staging import stage, typed
from incidentlens.schema import RAW


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], RAW)


@pytest.mark.parametrize("name", sorted(marts.MARTS))
def test_marts(nothing, name):
    assert marts.MARTS[name](stage(nothing)).collect() == []


def test_reports(nothing):
    feats = features.all_features(typed(nothing))
    assert len(feats.columns) == 43 and feats.count() == 0
    row = reports.overall_stats(feats).first()
    assert row.crime_types == 0 and row.avg_distance_from_center is None
    for report in (reports.type_share, reports.hourly_distribution, reports.distance_bands, reports.series_stats):
        assert report(feats).collect() == []
    assert reports.peak_and_share(feats, "season").first().peak is None
    assert reports.grid_profile(feats).first().non_empty_cells == 0
    assert reports.feature_profile(feats).first().records == 0
    located = filters.spatial_scan(feats)
    assert clustering.grid_features(located).count() == 0


def test_series_and_clusters(spark, nothing):
    assert series.daily_series(typed(nothing)).count() == 0
    points = spark.createDataFrame([], "id long, a double, b double")
    labelled = dbscan(points, ["a", "b"], 0.1, 3)
    assert labelled.count() == 0 and quality(labelled).first().noise_ratio is None


def test_no_coordinates_at_all(spark):
    feats = features.row_features(typed(raw(spark, [("1", "2024-01-01T00:00:00", {})])))
    assert reports.overall_stats(feats).first().with_coordinates == 0


def test_one_place(spark):
    rows = [(str(i), "2024-01-01T00:00:00", {"latitude": "41.8", "longitude": "-87.6"}) for i in range(3)]
    located = filters.spatial_scan(features.row_features(typed(raw(spark, rows))))
    profile = reports.grid_profile(located).first()
    assert (profile.non_empty_cells, profile.max_per_cell) == (1, 3)
    gridded = clustering.grid_features(located)
    assert gridded.filter("lat_bin is null").count() == 3
    labelled = dbscan(gridded, ["latitude", "longitude"], 0.01, 2)
    assert {r.cluster_id for r in labelled.collect()} == {0}
    assert hotspots.cluster_profiles(labelled).first().risk_score is None  # no cell, no density
