from datetime import date, datetime, timedelta

import pytest
from helpers import raw
from incidentlens.operators import features, reports
from incidentlens.operators.staging import stage, typed
from incidentlens.plans import pipelines
from incidentlens.schema import CLUSTER_KEY, CLUSTER_TYPES
from incidentlens.session import materialize
from incidentlens.sinks import exports, tables
from incidentlens.sources import landing
from incidentlens.streaming.daily_ingest import ingest_new_files, read_ingested
from pyspark.sql import functions as F


def records(spark, day, n, first=0):
    rows = [(str(first + i), f"{day}T{i % 24:02d}:00:00", ["THEFT", "BATTERY"][i % 2], i % 3 == 0) for i in range(n)]
    return spark.createDataFrame(rows, "id string, date string, primary_type string, arrest boolean")


def test_envelope(spark):
    df = spark.createDataFrame([(None, "2024-01-01T05:00:00", 1)], "id string, date string, x int")
    row = tables.envelope(df, "crime_api").first()
    assert row.id == "" and row.date == datetime(2024, 1, 1, 5) and '"x":1' in row.record_data
    assert tables.envelope(df.select("x"), "s").first().date is None


def test_loads_append_and_optionally_dedupe(spark, schema):
    table = f"{schema}.raw"
    tables.load_daily(records(spark, "2024-01-01", 5), table)
    tables.load_daily(records(spark, "2024-01-01", 5), table)
    assert spark.table(table).count() == 10
    tables.load_batch(records(spark, "2024-01-02", 5, first=3), "2024_01", table, dedupe=True)
    tables.load_batch(records(spark, "2024-01-02", 8, first=3), "2024_01", table, dedupe=True)
    assert spark.table(table).count() == 18
    tables.load_batch(records(spark, "2024-01-02", 0), "none", table)
    assert {r.source for r in spark.table(table).select("source").distinct().collect()} == {"crime_api", "batch_api_2024_01"}


def test_dedupe_keeps_records_without_id(spark, schema):
    rows = records(spark, "2024-01-01", 4).drop("id")
    tables.load_daily(rows, f"{schema}.raw", dedupe=True)
    assert spark.table(f"{schema}.raw").count() == 4


def test_loads_run_twice_are_merged(spark, schema):
    table = f"{schema}.raw"
    stored = lambda: sorted((r.id, r.record_data, r.source) for r in spark.table(table).collect())
    nameless = records(spark, "2024-01-02", 3).select("date", "primary_type").union(
        spark.createDataFrame([("2024-01-02T00:00:00", "THEFT")], "date string, primary_type string")
    )
    undated = spark.createDataFrame([("99", None, "THEFT", True)], "id string, date string, primary_type string, arrest boolean")
    first = records(spark, "2024-01-01", 5).unionByName(records(spark, "2024-01-02", 5, 5)).unionByName(undated)
    for _ in range(2):
        tables.load_batch(first, "a", table, dedupe=True)
        tables.load_batch(nameless, "n", table, dedupe=True)
        assert spark.table(table).count() == 11 + 4  # two equal ones without an id stay two
    before = {r.id: r for r in spark.table(table).filter("day = '2024-01-01'").collect()}
    changed = records(spark, "2024-01-02", 2, 6).withColumn("arrest", F.lit(None).cast("boolean"))
    tables.load_batch(changed.unionByName(changed), "b", table, dedupe=True)
    rows = {r.id: r for r in spark.table(table).filter("id != ''").collect()}
    assert len(rows) == 11 and spark.table(table).count() == 15
    assert {i for i, r in rows.items() if r.source == "batch_api_b"} == {"6", "7"}
    assert all(rows[i] == before[i] for i in before)  # other days are not touched
    assert len(stored()) == 15


def test_merge_keeps_the_last_row_and_the_larger_payload(spark):
    t = lambda h: datetime(2024, 1, 1, h)
    ddl = "id string, date timestamp_ntz, record_data string, loaded_at timestamp_ntz, source string, day date"
    row = lambda i, data, h, day=1: (i, t(0), data, t(h), "s", date(2024, 1, day))
    stored = spark.createDataFrame([row("a", "9", 1), row("b", "5", 4), row("c", "1", 2)], ddl)
    batch = spark.createDataFrame([row("a", "1", 3), row("b", "7", 3), row("c", "2", 2), row("c", "0", 2), row("a", "1", 3, 2)], ddl)
    found = {(r.id, r.day.day): r.record_data for r in tables.merged(stored, batch).collect()}
    assert found == {("a", 1): "1", ("b", 1): "5", ("c", 1): "2", ("a", 2): "1"}


def test_key_filter_passes_all_keys_and_few_others(spark, monkeypatch):
    keys = spark.range(2000).select((F.col("id") * 7).alias("k"), F.lit("m").alias("m"))
    others = spark.range(20000).select((F.col("id") * 7 + 1).alias("k"), F.lit("m").alias("m"))
    test = tables.key_filter(keys, ["k", "m"])
    assert keys.filter(test).count() == 2000 and others.filter(test).count() < 400
    assert tables.key_filter(keys.limit(0), ["k", "m"]) is not None
    monkeypatch.setattr(tables, "MOST_BITS", 64)
    assert tables.key_filter(keys, ["k", "m"]) is None


def test_skipped_rows_do_not_depend_on_partitioning(spark, schema):
    table = f"{schema}.clusters"
    twice = clusters(spark, ["1", "2"]).unionByName(clusters(spark, ["1"]).withColumn("cluster_id", F.lit(4)))
    tables.save_clusters(twice.coalesce(1), table, "DBSCAN", on_duplicate="skip")
    tables.save_clusters(twice.repartition(3), table, "DBSCAN", on_duplicate="skip")
    assert {r.id: r.cluster_id for r in spark.table(table).collect()} == {"1": 0, "2": 0}


def test_extract_prunes_partitions(spark, schema):
    table = f"{schema}.raw"
    both = records(spark, "2024-01-01", 5).unionByName(records(spark, "2024-01-02", 7, 5))
    tables.load_batch(both, "b", table)
    extract = landing.daily_extract(spark.table(table), date(2024, 1, 2))
    assert extract.count() == 7
    plan = extract._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def clusters(spark, ids):
    rows = [(i, datetime(2024, 1, 1), "THEFT", 41.123456789, -87.5, 0) for i in ids]
    return spark.createDataFrame(rows, "id string, date timestamp_ntz, primary_type string, latitude double, longitude double, cluster_id int")


def test_keyed_append(spark, schema):
    table = f"{schema}.clusters"
    tables.save_clusters(clusters(spark, ["1", "2"]), table, "DBSCAN")
    stored = spark.table(table)
    assert {f.name: f.dataType.simpleString() for f in stored.schema} == CLUSTER_TYPES
    assert str(stored.first().latitude) == "41.12345679"
    with pytest.raises(tables.DuplicateKeyError):
        tables.save_clusters(clusters(spark, ["2", "3"]), table, "DBSCAN")
    with pytest.raises(tables.DuplicateKeyError):
        tables.save_clusters(clusters(spark, ["7", "7"]), table, "DBSCAN")
    assert spark.table(table).count() == 2
    tables.save_clusters(clusters(spark, ["2", "3"]), table, "DBSCAN", on_duplicate="skip")
    tables.save_clusters(clusters(spark, ["2", "3"]), table, "DBSCAN", "VIOLENT")
    assert spark.table(table).count() == 5
    with pytest.raises(ValueError):
        tables.append_keyed(clusters(spark, []), table, {}, CLUSTER_KEY, "maybe")


@pytest.fixture(scope="module")
def city(spark):
    """Ninety days of incidents at a few places."""
    rows = []
    kinds = ["THEFT", "BATTERY", "ASSAULT", "NARCOTICS"]
    for i in range(1200):
        when = datetime(2024, 1, 1) + timedelta(hours=(i * 1.8))
        place = i % 5
        rows.append(
            (str(i), when.isoformat(), {
                "primary_type": kinds[i % 4], "arrest": i % 3 == 0, "domestic": i % 7 == 0, "district": f"{place:03d}",
                "ward": str(place), "beat": str(i % 9), "location_description": "STREET",
                "latitude": 41.7 + 0.05 * place + (i % 11) * 1e-3, "longitude": -87.8 + 0.05 * place + (i % 13) * 1e-3,
            })
        )
    return raw(spark, rows).persist()


def test_marts_refresh(spark, schema, city):
    summary = {r.table_name: r.record_count for r in pipelines.build_marts(city, schema).collect()}
    assert summary == {"Raw Data": 1200, "Staging Data": 1200, "Crime Types": 4, "Daily Patterns": 90, "Location Analysis": 5}
    names = {t.name for t in spark.catalog.listTables(schema) if not t.isTemporary}
    assert names == {*pipelines.MARTS, pipelines.PARTIALS}
    pipelines.build_marts(city, schema)  # replaces, does not double
    assert spark.table(f"{schema}.crime_type_analysis").count() == 4


def test_daily_load(spark, schema):
    landed = records(spark, "2024-01-01", 30).unionByName(records(spark, "2024-01-02", 20, 30))
    landed = landed.withColumn("date", F.col("date").cast("timestamp_ntz"))
    out = pipelines.daily_load(landed, date(2024, 1, 2), f"{schema}.raw", schema)
    assert {r.table_name: r.record_count for r in out.collect()}["Raw Data"] == 20


def test_three_days_one_by_one_equal_a_full_build(spark, schema):
    days = [("2024-01-01", 30, 0), ("2024-01-02", 20, 30), ("2023-01-02", 25, 50)]
    landed = None
    for day, n, first in days:
        rows = records(spark, day, n, first).withColumns(
            {"location_description": F.concat(F.lit("P"), F.col("id") % 3), "district": F.col("id") % 4, "ward": F.lit(None).cast("string")}
        )
        landed = rows if landed is None else landed.unionByName(rows)
    landed = landed.withColumn("date", F.col("date").cast("timestamp_ntz"))
    one, whole = f"{schema}.raw", f"{schema}.whole"
    for day, _, _ in days:
        counts = pipelines.daily_load(landed, date.fromisoformat(day), one, schema, dedupe=True)
    assert {r.table_name: r.record_count for r in counts.collect()}["Staging Data"] == 75
    tables.load_batch(landed, "all", whole)
    full = f"{schema}_full"
    try:
        pipelines.build_marts(spark.table(whole), full)
        for mart, build in pipelines.MARTS.items():
            rows = lambda df: sorted(map(str, df.collect()))
            want = rows(build(materialize(stage(spark.table(whole)))))  # from detail rows
            assert rows(spark.table(f"{schema}.{mart}")) == rows(spark.table(f"{full}.{mart}")) == want, mart
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {full} CASCADE")
    # a refresh reads the raw partitions of its days only
    plan = stage(spark.table(one).filter(tables.days_of(spark.table(one).filter("day = '2024-01-02'"))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in text and "2024-01-02" in text.split("PartitionFilters")[1]


def test_spatial_job_end_to_end(spark, schema, city):
    feats = pipelines.build_features(city, f"{schema}.features")
    assert feats.count() == 1200 and len(feats.columns) == 44
    result = pipelines.spatial_analysis(feats, k=4, eps=0.3, min_samples=8, restarts=2)
    assert set(result["labels"]) == {"K-means", "DBSCAN"}
    pipelines.save_spatial(result, f"{schema}.clusters", f"{schema}.hotspots")
    assert spark.table(f"{schema}.clusters").count() == 2400
    hot = spark.table(f"{schema}.hotspots")
    sizes = {r.model_type: r.n for r in hot.groupBy("model_type").agg(F.sum("cluster_size").alias("n")).collect()}
    assert sizes["K-means"] == 1200
    violent = pipelines.violent_spatial_analysis(feats, k=2, eps=0.5, min_samples=4, restarts=1)
    pipelines.save_spatial(violent, f"{schema}.clusters", f"{schema}.hotspots", "VIOLENT")
    assert spark.table(f"{schema}.clusters").count() == 2400 + 1200
    assert pipelines.spatial_analysis(feats, "NO SUCH TYPE") == {"error": "Insufficient data"}


def test_forecasting_job_and_reports(spark, schema, city):
    out = pipelines.forecasting_pipeline(typed(city), ["THEFT", "BATTERY"], days_ahead=14, period=7)
    best = {r.series_id: r.best_model for r in out["best_model"].collect()}
    assert set(best) == {"THEFT", "BATTERY", "ALL"}
    forecasts = out["future_forecasts"]
    assert forecasts.count() == 3 * 14 and out["errors"].count() == 0
    tables.save_forecasts(forecasts, f"{schema}.forecasts")
    with pytest.raises(tables.DuplicateKeyError):
        tables.save_forecasts(forecasts, f"{schema}.forecasts")
    stored = spark.table(f"{schema}.forecasts")
    rows = reports.forecast_summary(stored).collect()
    assert [r.crime_type for r in rows] == ["ALL", "BATTERY", "THEFT"] and all(r.forecast_days == 14 for r in rows)
    table = reports.metric_comparison(out["metrics"])
    assert {r.metric for r in table.collect()} >= {"mae", "rmse", "mape"}
    assert reports.forecast_table(stored).first().date == "2024-03-31"


def test_violent_fan_out_records_missing_types(city):
    out = pipelines.violent_forecasting(typed(city), days_ahead=7)
    assert {r.series_id for r in out["best_model"].collect()} == {"ASSAULT", "BATTERY"}


def test_status_reports(spark, schema, city):
    parts = {"Raw Data": city, "Features": city.limit(0), "Clusters": pipelines.table_or_none(spark, f"{schema}.none")}
    status = reports.pipeline_status(parts)
    assert {r.component: r.status for r in status.collect()} == {"Raw Data": "COMPLETE", "Features": "EMPTY", "Clusters": "ERROR"}
    assert reports.overall_status(status).first().status == "PARTIALLY COMPLETE"
    assert reports.overall_status(status.filter("records > 0")).first().status == "FULLY OPERATIONAL"


def test_exports_round_trip(spark, city, tmp_path):
    feats = features.features_for_storage(features.all_features(typed(city)))
    hot = spark.createDataFrame(
        [(1, "DBSCAN", 70.5, 10, "THEFT", 41.8, -87.6, 0.1, 0.9, 3, 0.2), (2, "DBSCAN", 90.5, 10, "THEFT", 41.8, -87.6, 0.1, 0.9, 3, 0.2)],
        "cluster_id int, model_type string, risk_score double, cluster_size int, top_crime_type string, center_latitude double, "
        "center_longitude double, violent_crime_ratio double, property_crime_ratio double, peak_hour int, weekend_ratio double",
    )
    fore = spark.createDataFrame(
        [(date(2024, 4, 1), 10.0, 5.0, 15.0, "ARIMA", "ALL")],
        "date date, forecast double, lower_ci double, upper_ci double, model_type string, crime_type string",
    )
    metrics = spark.createDataFrame([("ALL", "ARIMA", 1.5)], "series_id string, model_type string, mae double")
    folder = str(tmp_path / "export")
    exports.export_all(feats, hot, fore, folder, metrics, sample_size=100)
    sample = landing.read_feature_csv(spark, f"{folder}/crime_features")
    assert sample.count() == 100 and sample.filter("date is null or latitude is null").count() == 0
    assert [r.cluster_id for r in landing.read_csv(spark, f"{folder}/crime_hotspots", landing.HOTSPOT_CSV).collect()] == [2, 1]
    assert landing.read_csv(spark, f"{folder}/crime_forecasts", landing.FORECAST_CSV).first().date == date(2024, 4, 1)
    doc = landing.read_json_document(spark, f"{folder}/summary_stats").first()
    assert doc.overall_stats.total_records == 1200 and len(doc.hourly_distribution) == 24
    assert sum(d["count"] for d in doc.crime_distribution) == 1200 and doc.model_performance[0].mae == 1.5
    man = landing.read_json_document(spark, f"{folder}/manifest").first()
    assert man.files.crime_features == "100 records (sample)" and man.data_summary.hotspots_identified == 2


def test_sample_is_repeatable(spark, city):
    feats = features.row_features(typed(city))
    ids = lambda n: [r.id for r in reports.random_sample(feats.repartition(n), 50).collect()]
    assert ids(3) == ids(6) and len(set(ids(3))) == 50
    assert reports.random_sample(feats, 50, seed=None).count() == 50


def test_ml_report_and_first_rows(spark, city):
    feats = features.row_features(typed(city))
    clusters = spark.createDataFrame([(0,), (0,), (-1,)], "cluster_id int")
    row = reports.ml_report(feats, clusters, clusters, clusters.limit(1)).first()
    assert (row.feature_count, row.forecast_count, row.cluster_count, row.hotspot_count) == (1200, 3, 2, 1)
    assert [r.id for r in reports.first_rows(feats, 3, "date", "id").collect()] == ["0", "1", "2"]
    assert [r.primary_type for r in reports.first_types(feats, 2).collect()] == ["THEFT", "BATTERY"]


def test_incremental_ingest_loads_each_file_once(spark, tmp_path):
    landing_dir, out, ckpt = (str(tmp_path / n) for n in ("landing", "raw", "ckpt"))
    schema = records(spark, "2024-01-01", 1).schema
    for day, total in (("2024-01-01", 10), ("2024-01-02", 20)):
        records(spark, day, 10).write.mode("append").json(landing_dir)
        for _ in range(2):  # a repeated run finds nothing new
            query = ingest_new_files(spark, landing_dir, schema, out, ckpt)
            query.awaitTermination()
            assert read_ingested(spark, out).count() == total
