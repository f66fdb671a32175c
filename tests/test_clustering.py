import numpy as np
import pytest
from helpers import brute_dbscan, brute_kdist, frame
from incidentlens.operators import clustering, dbscan, hotspots, kdistance
from pyspark.sql import functions as F


def labels_of(df):
    return np.array([r.cluster_id for r in df.orderBy("id").select("cluster_id").collect()])


def scene(seed, d=2):
    """Two dense clumps, a thin chain between nothing, noise, and repeats."""
    rng = np.random.default_rng(seed)
    clumps = [rng.normal(c, 0.05, (60, d)) for c in ([0] * d, [1] * d)]
    chain = np.column_stack([np.linspace(2, 4, 30)] + [np.full(30, 0.5)] * (d - 1)) + rng.normal(0, 0.01, (30, d))
    noise = rng.uniform(-2, 5, (25, d))
    points = np.vstack([*clumps, chain, noise, np.repeat(clumps[0][:3], 10, axis=0)])
    return points[rng.permutation(len(points))].round(4)


@pytest.mark.parametrize("seed,d,eps,min_samples", [(1, 2, 0.1, 4), (2, 2, 0.25, 5), (3, 3, 0.3, 4), (4, 1, 0.02, 3), (5, 2, 0.05, 8)])
def test_dbscan_equals_brute_force(spark, seed, d, eps, min_samples):
    points = scene(seed, d)
    names = [f"f{i}" for i in range(d)]
    out = dbscan.dbscan(frame(spark, points, names), names, eps, min_samples, order_by=F.col("id"))
    assert (labels_of(out) == brute_dbscan(points, eps, min_samples)).all()


def test_dbscan_hot_cells_are_refined(spark):
    """Crowded neighbouring cells whose link hangs on a few points: the pairs
    are too many to compare directly and have to be split."""
    rng = np.random.default_rng(7)
    left = np.column_stack([rng.uniform(0.0, 0.05, 400), rng.uniform(0, 0.06, 400)])
    right = np.column_stack([rng.uniform(0.149, 0.19, 400), rng.uniform(0, 0.06, 400)])
    lone = np.array([[0.9, 0.9]])
    points = np.vstack([left, right, lone]).round(5)
    for eps in (0.0993, 0.105):
        out = dbscan.dbscan(frame(spark, points, ["x", "y"]), ["x", "y"], eps, 5, order_by=F.col("id"), direct_pairs=16)
        assert (labels_of(out) == brute_dbscan(points, eps, 5)).all()


def test_dbscan_does_not_depend_on_partitioning(spark):
    points = scene(9)
    df = frame(spark, points, ["a", "b"])
    runs = [labels_of(dbscan.dbscan(df.repartition(n), ["a", "b"], 0.1, 4, order_by=F.col("id"))) for n in (1, 7)]
    assert (runs[0] == runs[1]).all()


def test_dbscan_zero_radius_and_errors(spark):
    df = frame(spark, [[0, 0], [0, 0], [1, 1]], ["a", "b"])
    assert list(labels_of(dbscan.dbscan(df, ["a", "b"], 0.0, 2, order_by=F.col("id")))) == [0, 0, -1]
    with pytest.raises(ValueError):
        dbscan.dbscan(df, ["a", "b"], -1, 2)
    q = dbscan.quality(dbscan.dbscan(df, ["a", "b"], 0.0, 2)).first()
    assert (q.n_clusters, q.n_noise_points) == (1, 1) and abs(q.noise_ratio - 1 / 3) < 1e-12


@pytest.mark.parametrize("seed,d", [(1, 2), (2, 3)])
def test_kth_distance_equals_brute_force(spark, seed, d):
    points = scene(seed, d)
    names = [f"f{i}" for i in range(d)]
    vectors = dbscan.distinct_vectors(frame(spark, points, names), names).persist()
    got = kdistance.kth_neighbour_distance(vectors, d, 4, most=10)
    spread = sorted(v for r in got.collect() for v in [r.kdist] * r.n)
    assert np.allclose(spread, sorted(brute_kdist(points, 4)))


@pytest.mark.parametrize("curve", [[0, 0, 0, 1, 1, 5], [1, 2, 4, 4, 9, 9, 9, 10], [3, 3, 3], [0, 1], [2, 2, 7]])
def test_elbow_equals_gradient_argmax(spark, curve):
    df = spark.createDataFrame([(float(v), 1) for v in curve], "kdist double, n long")
    want = sorted(curve)[int(np.argmax(np.gradient(np.sort(np.array(curve, float)))))]
    assert kdistance.curve_elbow(df).first().eps == want


def test_tuning_needs_enough_points(spark):
    with pytest.raises(ValueError):
        kdistance.tune_dbscan(frame(spark, [[0, 0]] * 3, ["a", "b"]), ["a", "b"])


def test_tuning_min_samples_follow_dimensions(spark):
    df = frame(spark, scene(3), ["a", "b"])
    eps, min_samples = kdistance.tune_dbscan(df, ["a", "b"])
    assert eps > 0 and min_samples == 4


def test_grid_minimum_has_no_cell(spark):
    df = frame(spark, [[0, 0], [1, 1], [0.5, 0.5], [1, 0.5]], ["latitude", "longitude"]).withColumn(
        "date", F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    )
    rows = {r.id: r for r in clustering.grid_features(df).collect()}
    assert rows[0].lat_bin is None and rows[0].grid_crime_count is None
    assert (rows[1].lat_bin, rows[1].lon_bin, rows[1].grid_crime_count) == (48, 48, 1)
    assert rows[3].lat_bin == 48


def test_standardize_fills_with_median_and_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (3.0, 2.0), (8.0, 2.0)], "a double, b double")
    out = clustering.standardize(df, ["a", "b"]).collect()
    a = np.array([1.0, 3.0, 3.0, 8.0])
    assert np.allclose([r.z_a for r in out], (a - a.mean()) / a.std())
    assert [r.z_b for r in out] == [0.0] * 4


def test_kmeans_finds_separate_clumps(spark):
    rng = np.random.default_rng(0)
    points = np.vstack([rng.normal(c, 0.1, (50, 2)) for c in ([0, 0], [5, 5], [0, 5])])
    df = frame(spark, points, ["a", "b"])
    sweep = clustering.kmeans_sweep(df, ["a", "b"], max_k=5, restarts=2)
    rows = {r.k: r for r in sweep.collect()}
    assert sorted(rows) == [2, 3, 4, 5] and rows[3].recommended_k == 3
    labelled, metrics = clustering.kmeans_labels(df, ["a", "b"], k=3, restarts=3)
    labels = labels_of(labelled)
    assert all(len(set(labels[i : i + 50])) == 1 for i in (0, 50, 100)) and len(set(labels)) == 3
    inertia = sum(((points[labels == c] - points[labels == c].mean(0)) ** 2).sum() for c in range(3))
    total = ((points - points.mean(0)) ** 2).sum()
    assert np.isclose(metrics["inertia"], inertia)
    assert np.isclose(metrics["calinski_harabasz"], ((total - inertia) / 2) / (inertia / 147))


def test_elbow_is_one_past_the_usual_choice(spark):
    rows = [(k, i, 0.5) for k, i in zip(range(2, 8), [100.0, 60.0, 30.0, 25.0, 22.0, 20.0])]
    df = spark.createDataFrame(rows, "k int, inertia double, silhouette_squared_euclidean double")
    assert clustering.with_recommendation(df).first().elbow_k == 5


def test_risk_score_of_a_published_row(spark):
    df = spark.createDataFrame([(115, 0.4087, 1.0, 0.0)], "size int, violent_crime_ratio double, density double, night_ratio double")
    assert df.select(hotspots.risk_score().alias("r")).first().r == 82.70


def profile_rows(spark):
    rows = [
        (1, 0, 41.8, -87.6, "THEFT", False, True, 2.0, 23, True, 5.0, 10),
        (2, 0, 41.9, -87.7, "ASSAULT", True, False, 4.0, 1, False, 7.0, 20),
        (3, -1, 41.0, -87.0, "THEFT", False, True, 9.0, 1, False, 7.0, 20),
        (4, 1, 41.5, -87.5, "THEFT", False, True, 1.0, 12, False, None, 4),
    ]
    return spark.createDataFrame(
        rows,
        "id long, cluster_id int, latitude double, longitude double, primary_type string, is_violent_crime boolean, "
        "is_property_crime boolean, distance_from_center double, hour int, is_weekend boolean, district_num double, grid_crime_count long",
    )


def test_profiles(spark):
    out = {r.cluster_id: r for r in hotspots.cluster_profiles(profile_rows(spark)).collect()}
    assert set(out) == {0, 1}
    a, b = out[0], out[1]
    assert (a.size, a.top_crime_type, a.peak_hour, a.weekend_ratio) == (2, "ASSAULT", 1, 0.5)
    assert a.crime_types == {"THEFT": 1, "ASSAULT": 1} and a.districts == [5.0, 7.0]
    # 100 * (0.3 * 2/100 + 0.8 * 0.5 + 0.2 * 15/20)
    assert a.risk_score == 55.6 and b.lat_std is None and b.districts == []
    wrapped = {r.cluster_id: r.risk_score for r in hotspots.cluster_profiles(profile_rows(spark), wrap_night=True).collect()}
    assert wrapped[0] == 65.6


def test_hotspot_summary_and_bands(spark):
    from incidentlens.operators import filters, reports

    scores = [80.0, 79.4, 60.0, 59.5, 40.0, 39.9]
    df = spark.createDataFrame(
        [(i, "DBSCAN" if i % 2 else "K-means", s, 10, "THEFT", 41.12345, -87.5, 0.4087) for i, s in enumerate(scores)],
        "cluster_id int, model_type string, risk_score double, size long, top_crime_type string, center_lat double, center_lon double, violent_crime_ratio double",
    )
    levels = [r.risk_level for r in hotspots.with_risk_level(df).orderBy("cluster_id").collect()]
    assert levels == ["CRITICAL", "HIGH", "HIGH", "MODERATE", "MODERATE", "LOW"]
    picked = lambda band: sorted(r.cluster_id for r in filters.risk_band(df, band).collect())
    assert picked("Critical (80+)") == [0] and picked("High (60-79)") == [2]
    assert picked("Moderate (40-59)") == [4] and picked("Low (<40)") == [5] and len(picked(None)) == 6
    s = hotspots.hotspot_summary(df).first()
    assert (s.total_hotspots, s.high_risk_hotspots, s.medium_risk_hotspots, s.low_risk_hotspots) == (6, 2, 3, 1)
    assert [h.risk_score for h in s.top_hotspots] == scores[:5]
    assert s.top_hotspots[0].location == "(41.1235, -87.5000)" and s.top_hotspots[0].violent_ratio == "40.9%"
    assert hotspots.top_hotspots(df, 8, above=70).count() == 2
    k = hotspots.hotspot_kpis(df).first()
    assert (k.critical_zones, k.high_zones, k.highest_risk, k.highest_risk_model) == (1, 3, 80.0, "K-means")
    assert sum(r.hotspots for r in hotspots.risk_histogram(df).collect()) == 6


@pytest.mark.parametrize("clusters", [None, 2])
def test_cluster_metrics_equal_all_pairs(spark, monkeypatch, clusters):
    from incidentlens.operators import cluster_metrics

    if clusters:
        monkeypatch.setattr(cluster_metrics, "CLUSTERS", clusters)  # several passes over the rows
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(c, 0.4, (n, 3)) for c, n in ((0, 30), (2, 20), (5, 1), (-3, 12))] + [np.full((5, 3), 9.0)])
    label = np.repeat([3, 7, 20, 0, 11], [30, 20, 1, 12, 5])
    noise = [(999, 1e6, 1e6, 1e6, -1), (998, 5.0, 5.0, 5.0, None)]
    rows = [(i, *map(float, p), int(c)) for i, (p, c) in enumerate(zip(x, label))] + noise
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, cluster_id int")
    got = cluster_metrics.cluster_metrics(df, ["a", "b", "c"]).first()
    far = ((x[:, None] - x[None]) ** 2).sum(-1)
    score = []
    for i, c in enumerate(label):
        own = (label == c).sum()
        if own == 1:
            score.append(0.0)
            continue
        a = far[i][label == c].sum() / (own - 1)
        b = min(far[i][label == o].mean() for o in set(label) - {c})
        score.append((b - a) / max(a, b))
    inertia = sum(((x[label == c] - x[label == c].mean(0)) ** 2).sum() for c in set(label))
    between = ((x - x.mean(0)) ** 2).sum() - inertia
    assert (got.n_clusters, got.n_points) == (5, len(x))
    assert np.isclose(got.inertia, inertia) and np.isclose(got.silhouette_squared_euclidean, np.mean(score))
    assert np.isclose(got.calinski_harabasz, (between / 4) / (inertia / (len(x) - 5)))
    one = cluster_metrics.cluster_metrics(df.filter("cluster_id = 3"), ["a", "b", "c"]).first()
    assert one.silhouette_squared_euclidean is None and one.calinski_harabasz is None
    none = cluster_metrics.cluster_metrics(df.filter("cluster_id = -1"), ["a", "b", "c"]).first()
    assert (none.n_clusters, none.n_points, none.inertia) == (0, 0, None)


def test_kmeans_separates_far_clumps_of_any_weight(spark):
    rng = np.random.default_rng(2)
    points = np.vstack([rng.normal(c, 0.1, (n, 2)) for c, n in (([0, 0], 300), ([9, 9], 5), ([0, 9], 40), ([9, 0], 2))])
    labelled, metrics = clustering.kmeans_labels(frame(spark, points, ["a", "b"]), ["a", "b"], k=4)
    labels = labels_of(labelled)
    ends = np.cumsum([0, 300, 5, 40, 2])
    assert len(set(labels)) == 4 and all(len(set(labels[a:b])) == 1 for a, b in zip(ends, ends[1:]))
    assert 0.9 < metrics["silhouette_squared_euclidean"] <= 1
    again, _ = clustering.kmeans_labels(frame(spark, points, ["a", "b"]).repartition(5), ["a", "b"], k=4)
    assert (labels_of(again) == labels).all()
