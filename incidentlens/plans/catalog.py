"""Registered queries: every operator over whole generated tables.

E-queries read `events`, O-queries `orders` (see sources.incident_views).
Figures that depend on the order of floating point sums or on the maths library
are rounded to six places here, at the edge, so that they can be compared."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import (
    cluster_metrics,
    clustering,
    dbscan,
    features,
    filters,
    forecasting,
    hotspots,
    kdistance,
    marts,
    reports,
    series,
)
from ..operators.staging import create_staging_view, parse_counts, split_records, stage, typed
from ..session import materialize, scratch_dir, settled
from ..sinks import exports, tables
from ..sources import landing
from ..sources.incident_views import damaged_events, events_raw, lineitem_places, orders_raw, table
from ..streaming import daily_counts
from . import pipelines

AS_OF = date(2024, 1, 31)
DEGREES = ["latitude", "longitude"]
# centres of a fixed assignment, in the corners and the middle of the area
CENTERS = [[41.7, -87.8], [41.7, -87.55], [41.86, -87.7], [42.0, -87.8], [42.0, -87.55]]


def r6(*names: str):
    return {n: F.round(F.col(n).cast("double"), 6) for n in names}


def e_staged(spark, sf):
    return stage(events_raw(spark, sf))


def o_staged(spark, sf):
    return stage(orders_raw(spark, sf))


def e_typed(spark, sf):
    return typed(events_raw(spark, sf))


def o_typed(spark, sf):
    return typed(orders_raw(spark, sf))


def e_features(spark, sf):
    return features.row_features(e_typed(spark, sf))


def e_located(spark, sf):
    return filters.spatial_scan(e_features(spark, sf))


def e_spatial_table(spark, sf):
    """The clustering input as a table, as the jobs that read it many times do."""
    return materialize(e_located(spark, sf))


def e_blobs(spark, sf):
    """Located incidents with the blob they were placed in as their cluster."""
    blob = (F.col("beat_num") % 7) * 5 + F.col("beat_num") % 5
    return clustering.grid_features(e_spatial_table(spark, sf)).withColumn("cluster_id", blob.cast("int"))


def blob_profiles(spark, sf):
    return materialize(hotspots.cluster_profiles(materialize(e_blobs(spark, sf))))


def blob_hotspots(spark, sf):
    return blob_profiles(spark, sf).select(
        "cluster_id",
        F.when(F.col("cluster_id") % 2 == 0, "K-means").otherwise("DBSCAN").alias("model_type"),
        "risk_score",
        F.col("size").alias("cluster_size"),
        "top_crime_type",
    )


# --- staging, sources, sinks ---------------------------------------------------


def staged_incidents(spark, sf):
    return e_staged(spark, sf).withColumns(
        {"latitude": S.safe_double(F.col("latitude")), "longitude": S.safe_double(F.col("longitude"))}
    )


def parse_quality(spark, sf):
    return parse_counts(damaged_events(spark, sf))


def rejected_records(spark, sf):
    """Rejected records by reason, and the good ones, read back from their tables."""
    good, bad, counts = split_records(damaged_events(spark, sf), f"{scratch_dir(spark)}/{uuid.uuid4().hex}")
    read = good.select(F.lit("good").alias("reason")).unionByName(bad.select("reason"))
    observed = F.create_map(*[F.lit(x) for k, v in counts.items() for x in (k, v)])
    return (
        read.groupBy("reason").agg(F.count("*").alias("records"))
        .withColumn("observed", F.get(F.map_values(F.map_filter(observed, lambda k, v: k == F.col("reason"))), 0).cast("long"))
    )


def rejected_lines(spark, sf):
    """Lines of CSV and JSON files that fit a schema, and those that don't."""
    ev = table(spark, sf, "events").select("event_id", "event_type", "value")
    kind = F.col("event_id") % 19
    number, value = F.col("event_id").cast("string"), F.col("value").cast("string")
    as_csv = (
        F.when(kind == 0, F.concat_ws(",", F.lit("x"), "event_type", value))  # no number
        .when(kind == 1, F.concat_ws(",", number, "event_type"))  # too few fields
        .when(kind == 2, F.concat_ws(",", number, "event_type", value, F.lit("more")))
        .otherwise(F.concat_ws(",", number, "event_type", value))
    )
    whole = F.to_json(F.struct("event_id", "event_type", "value"))
    as_json = (
        F.when(kind == 0, F.substring(whole, 1, 20))
        .when(kind == 1, F.lit("[]"))
        .when(kind == 2, F.to_json(F.struct(F.lit("x").alias("event_id"))))
        .otherwise(whole)
    )
    base, out = f"{scratch_dir(spark)}/{uuid.uuid4().hex}", None
    for form, line in (("csv", as_csv), ("json", as_json)):
        ev.select(line.alias("value")).write.text(f"{base}/{form}")
        good, bad, _ = landing.split_file(
            spark, f"{base}/{form}", "event_id long, event_type string, value double", form, f"{base}/{form}_read"
        )
        ids = good.agg(
            F.lit(form).alias("form"), F.lit(False).alias("rejected"), F.count("*").alias("lines"), F.sum("event_id").alias("ids")
        )
        lines = bad.agg(
            F.lit(form).alias("form"), F.lit(True).alias("rejected"), F.count("line").alias("lines"),
            F.lit(None).cast("long").alias("ids"),
        )
        both = ids.unionByName(lines)
        out = both if out is None else out.unionByName(both)
    return out


def streamed_counts(spark, sf):
    """Daily counts of a file stream that is stopped and started again: the second file
    repeats the records of two days and brings some of them late."""
    base = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    day = F.to_date("ts")
    ev = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    held_back = (day >= F.lit(date(2024, 1, 13))) & (F.col("event_id") % 5 == 0)
    parts = [
        ev.filter((day < F.lit(date(2024, 1, 15))) & ~held_back),
        ev.filter(day >= F.lit(date(2024, 1, 13))),
    ]
    for part in parts:
        # one file is one micro-batch, whose records may be in any order
        records = part.select(F.col("event_id").alias("id"), F.col("ts").alias("date"), "event_type", "value")
        records.coalesce(1).write.mode("append").json(f"{base}/landing")
        query = daily_counts.count_new_files(spark, f"{base}/landing", records.schema, f"{base}/counts", f"{base}/state")
        query.awaitTermination()
    return daily_counts.read_counts(spark, f"{base}/counts").withColumn("total", F.round("total", 4))


def window_extract(cut, view=events_raw):
    return lambda spark, sf: cut(view(spark, sf)).select("id", "date", "source")


def raw_envelope_append(spark, sf):
    records = table(spark, sf, "events").withColumnsRenamed({"event_id": "id", "ts": "date"})
    field = lambda n: F.get_json_object("record_data", f"$.{n}")
    return tables.envelope(records, "batch_api_2024").select(
        "id",
        "date",
        "source",
        field("event_type").alias("event_type"),
        field("user_id").cast("long").alias("user_id"),
        field("props").alias("props"),
    )


def _own_schema(spark) -> str:
    """A database for the tables of one run, in the shared scratch folder."""
    name = f"run_{uuid.uuid4().hex[:12]}"
    tables.create_schema(spark, name, f"{scratch_dir(spark).rstrip('/')}/{name}.db")
    return name


def repeated_load(spark, sf):
    """Ten days loaded twice, then five of them and all later ones with corrected values."""
    records = table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("date"), "event_type", "value"
    )
    raw = f"{_own_schema(spark)}.raw"
    early = records.filter(F.to_date("date") < F.lit(date(2024, 1, 11)))
    late = records.filter(F.to_date("date") >= F.lit(date(2024, 1, 6)))
    corrected = F.when(F.col("id") % 3 == 0, F.col("value") + 1000).otherwise(F.col("value"))
    for _ in range(2):
        tables.load_batch(early, "early", raw, dedupe=True)
    tables.load_batch(late.withColumn("value", corrected), "late", raw, dedupe=True)
    value = F.get_json_object("record_data", "$.value").cast("double")
    return (
        spark.table(raw)
        .groupBy("day", "source")
        .agg(F.count("*").alias("records"), F.count_distinct("id").alias("ids"), F.round(F.sum(value), 4).alias("total"))
    )


def keyed_append(spark, sf):
    """Keyed rows stored, a clashing append refused, and the same one with skipping."""
    clusters = f"{_own_schema(spark)}.clusters"
    number = F.col("id").cast("long")
    rows = e_spatial_table(spark, sf).select("id", "date", "primary_type", "latitude", "longitude")
    first = rows.filter(number % 2 == 0).withColumn("cluster_id", F.lit(0))
    second = rows.filter((number % 2 == 1) | (number % 3 == 0)).withColumn("cluster_id", F.lit(1))
    tables.save_clusters(first, clusters, "DBSCAN")
    try:
        tables.save_clusters(second, clusters, "DBSCAN")
        refused = False
    except tables.DuplicateKeyError:
        refused = True
    tables.save_clusters(second.unionByName(second), clusters, "DBSCAN", on_duplicate="skip")
    tables.save_clusters(second, clusters, "K-means")
    return (
        spark.table(clusters)
        .groupBy("model_type", F.col("cluster_id").cast("long").alias("cluster_id"))
        .agg(F.count("*").alias("stored"), F.count_distinct("id").alias("ids"))
        .withColumn("refused", F.lit(refused))
    )


def incremental_patterns(spark, sf):
    """The daily mart after three loads of ten days, each refreshing its own days."""
    schema = _own_schema(spark)
    raw, rows = f"{schema}.raw", events_raw(spark, sf)
    tables.create_raw_table(spark, raw)
    cuts = [date(2024, 1, 1), date(2024, 1, 11), date(2024, 1, 21), date(2025, 1, 1)]
    for start, stop in zip(cuts, cuts[1:]):
        part = rows.filter((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(stop)))
        tables.by_day(part).write.mode("append").partitionBy(tables.DAY).saveAsTable(raw)
        pipelines.refresh_marts(raw, schema, F.col(tables.DAY).between(start, stop))
    return spark.table(f"{schema}.daily_crime_patterns")


def analytics_summary(spark, sf):
    staged = materialize(e_staged(spark, sf).select(*marts.MART_COLUMNS))
    return marts.analytics_summary(events_raw(spark, sf), staged)


def component_status(spark, sf):
    feats = materialize(e_features(spark, sf).select("id", "latitude", "longitude", "district_num"))
    inside = S.in_bounding_box(F.col("latitude"), F.col("longitude"))
    return reports.pipeline_status(
        {
            "Raw Data": events_raw(spark, sf),
            "Feature Engineering": feats,
            "Spatial Clustering": feats.filter(inside),
            "Unknown District": feats.filter(F.col("district_num") > 24),
        }
    )


def component_health(spark, sf):
    return reports.overall_status(component_status(spark, sf))


def freshness(spark, sf):
    return reports.freshness(
        {
            "Raw Data": (events_raw(spark, sf), "loaded_at"),
            "Features": (e_features(spark, sf), "date"),
            "Orders": (orders_raw(spark, sf), "loaded_at"),
        }
    )


# --- features ------------------------------------------------------------------


def temporal_features(spark, sf):
    names = "hour day_of_week day_of_month month quarter week_of_year".split()
    return (
        features.temporal_features(e_typed(spark, sf))
        .select(
            "id",
            *[F.col(n).cast("long").alias(n) for n in names],
            "is_weekend",
            "is_night",
            S.is_night_hour(F.col("hour"), wrap_night=True).alias("is_night_wrapped"),
            "is_rush_hour",
            "season",
            "time_period",
        )
    )


def spatial_features(spark, sf):
    return (
        features.spatial_features(e_typed(spark, sf))
        .select(
            "id", "has_coordinates", "district_num", "beat_num", "ward_num",
            "community_area_num", "location_type", "distance_from_center",
        )
        .withColumns(r6("distance_from_center"))
    )


def crime_features(spark, sf):
    return (
        features.crime_features(e_typed(spark, sf))
        .select(
            "id", "crime_category", "is_violent_crime", "is_property_crime", "is_drug_crime",
            "crime_type_arrest_rate",
        )
        .withColumns(r6("crime_type_arrest_rate"))
    )


def lag_features(spark, sf):
    return (
        features.lag_features(e_typed(spark, sf))
        .select("id", "daily_crime_count", "crimes_7day_avg", "crimes_30day_avg")
        .withColumns(r6("crimes_7day_avg", "crimes_30day_avg"))
    )


def stored_features(spark, sf):
    """The full feature table as stored, without its creation time."""
    full = features.features_for_storage(features.all_features(e_typed(spark, sf)))
    decimals = [f.name for f in full.schema if f.dataType.typeName() == "decimal"]
    ints = [f.name for f in full.schema if f.dataType.typeName() == "integer"]
    return full.drop("created_at").withColumns(
        {n: F.col(n).cast("double") for n in decimals} | {n: F.col(n).cast("long") for n in ints}
    )


# --- reports -------------------------------------------------------------------


def overall_stats(spark, sf):
    return reports.overall_stats(e_features(spark, sf)).withColumns(r6("avg_distance_from_center"))


def hours_as_long(df: DataFrame) -> DataFrame:
    return df.withColumn("hour", F.col("hour").cast("long"))


def feature_profile(spark, sf):
    full = features.lag_features(e_features(spark, sf))
    out = reports.feature_profile(full)
    rounded = [f.name for f in out.schema if f.dataType.typeName() == "double"]
    ints = [f.name for f in out.schema if f.dataType.typeName() == "integer"]
    return out.withColumns(r6(*rounded) | {n: F.col(n).cast("long") for n in ints})


def category_counts(spark, sf):
    return reports.value_counts(e_features(spark, sf), "crime_category")


def trend_first_last_week(spark, sf):
    daily = e_typed(spark, sf).groupBy(F.to_date("date").alias("day")).agg(F.count("*").alias("n"))
    return reports.first_last_week(daily).withColumns(
        r6("avg_daily", "first_week_avg", "last_week_avg", "trend_percent")
    )


def series_stats(spark, sf):
    return reports.series_stats(e_typed(spark, sf)).withColumns(r6("avg_per_day"))


def bbox_filtered(spark, sf):
    return e_located(spark, sf).select("id", "date", "primary_type", "latitude", "longitude", "district_num")


def recent_window(spark, sf):
    rows = filters.spatial_scan(e_features(spark, sf), "THEFT", "recent_month", date(2024, 2, 15))
    return rows.select("id", "date", "primary_type", "season")


def spatial_profile(spark, sf):
    out = reports.spatial_profile(e_located(spark, sf))
    return out.withColumns(r6("min_distance", "max_distance", "avg_distance", "violent_rate"))


def spatial_bounds(spark, sf):
    return reports.spatial_bounds(e_located(spark, sf))


def grid_profile_10x10(spark, sf):
    return reports.grid_profile(e_located(spark, sf)).withColumns(r6("avg_per_cell"))


def grid_features(spark, sf):
    hot = [f"distance_to_hotspot_{i}" for i in (1, 2, 3)]
    return (
        clustering.grid_features(e_spatial_table(spark, sf))
        .select("id", "lat_bin", "lon_bin", "grid_crime_count", "crimes_same_location_24h", *hot)
        .withColumns(r6(*hot) | {n: F.col(n).cast("long") for n in ("lat_bin", "lon_bin")})
    )


def scaled_features(spark, sf):
    z = clustering.scaled_names()
    scaled = clustering.standardize(materialize(clustering.grid_features(e_spatial_table(spark, sf))))
    return scaled.select("id", *z).withColumns(r6(*z))


# --- dashboard -----------------------------------------------------------------


def dashboard_filtered_counts(spark, sf):
    rows = filters.dashboard_filter(
        e_features(spark, sf), date(2024, 1, 5), date(2024, 1, 20),
        ["THEFT", "BATTERY", "ASSAULT"], "Evening",
    )
    return reports.top_types(rows, 10).drop("percentage")


def dashboard_hourly(spark, sf):
    rows = filters.dashboard_filter(e_features(spark, sf), date(2024, 1, 5), date(2024, 1, 20))
    return hours_as_long(reports.value_counts(rows, "hour"))


def district_top8(spark, sf):
    return reports.group_counts(e_features(spark, sf), "district_num", 8)


def group_by(column):
    return lambda spark, sf: reports.group_counts(e_features(spark, sf), column)


def severity_share(spark, sf):
    return reports.peak_and_share(e_features(spark, sf), "crime_category")


def first_types(spark, sf):
    return reports.first_types(e_typed(spark, sf))


# --- clustering ----------------------------------------------------------------


def nearest_center(spark, sf):
    return clustering.nearest_center(e_located(spark, sf), DEGREES, CENTERS).select(
        "id", F.col("cluster_id").cast("long").alias("cluster_id")
    )


def _scaled(spark, sf):
    gridded = materialize(clustering.grid_features(e_spatial_table(spark, sf)))
    return materialize(clustering.standardize(gridded))


def kmeans_assign(spark, sf):
    """Profiles of a K-means clustering with four clusters."""
    labelled, _ = clustering.kmeans_labels(_scaled(spark, sf), k=4)
    return hotspots.cluster_profiles(materialize(labelled)).drop("crime_types", "districts")


def kmeans_sweep(spark, sf):
    return clustering.kmeans_sweep(_scaled(spark, sf))


def dbscan_clusters(spark, sf):
    labelled = dbscan.dbscan(
        e_spatial_table(spark, sf), DEGREES, 0.02, 5, order_by=F.col("id").cast("long")
    )
    return labelled.select("id", F.col("cluster_id").cast("long").alias("cluster_id"))


def dbscan_quality(spark, sf):
    labelled = dbscan.dbscan(e_spatial_table(spark, sf), DEGREES, 0.02, 5, order_by=F.col("id").cast("long"))
    labelled = materialize(labelled)
    measured = cluster_metrics.cluster_metrics(labelled, DEGREES).select(
        F.struct(
            F.round("inertia", 6).alias("inertia"),
            F.round("calinski_harabasz", 1).alias("calinski_harabasz"),
            F.round("silhouette_squared_euclidean", 6).alias("silhouette_squared_euclidean"),
        ).alias("m")
    )
    return dbscan.quality(labelled).withColumn("m", measured.scalar()).select("*", "m.*").drop("m")


def blob_metrics(spark, sf):
    """Metrics of a given partition: the blob every place was made in."""
    return cluster_metrics.cluster_metrics(materialize(e_blobs(spark, sf)), DEGREES).withColumns(
        r6("inertia", "silhouette_squared_euclidean")
        | {"calinski_harabasz": F.round("calinski_harabasz", 1)}
    )


def strip_sweep(spark, sf):
    return clustering.strip_sweep(e_spatial_table(spark, sf)).withColumns(r6("inertia"))


def dbscan_scaled(spark, sf):
    """Tuned DBSCAN over the eight scaled features, profiled."""
    scaled = _scaled(spark, sf)
    columns = clustering.scaled_names()
    eps, min_samples = kdistance.tune_dbscan(scaled, columns)
    labelled = dbscan.dbscan(scaled, columns, eps, min_samples, order_by=F.col("id").cast("long"))
    return hotspots.cluster_profiles(materialize(labelled)).drop("crime_types", "districts")


def fitted_hotspots(spark, sf):
    """Hotspots of a fitted density clustering, stored and read back."""
    gridded = materialize(clustering.grid_features(e_spatial_table(spark, sf)))
    labelled = materialize(dbscan.dbscan(gridded, DEGREES, 0.02, 5, order_by=F.col("id").cast("long")))
    stored = f"{_own_schema(spark)}.hotspots"
    tables.save_hotspots(hotspots.cluster_profiles(labelled), stored, "DBSCAN")
    return spark.table(stored).select(
        F.col("cluster_id").cast("long").alias("cluster_id"),
        "model_type",
        "crime_type_filter",
        F.col("cluster_size").cast("long").alias("cluster_size"),
        F.col("risk_score").cast("double").alias("risk_score"),
        "top_crime_type",
        F.col("peak_hour").cast("long").alias("peak_hour"),
    )


def violent_clusters(spark, sf):
    """Density clusters of violent incidents alone, stored under their own filter name."""
    violent = materialize(filters.spatial_scan(e_features(spark, sf), violent_only=True))
    labelled = dbscan.dbscan(violent, DEGREES, 0.02, 5, order_by=F.col("id").cast("long"))
    stored = f"{_own_schema(spark)}.clusters"
    tables.save_clusters(labelled, stored, "DBSCAN", "VIOLENT")
    return spark.table(stored).select(
        "id", F.col("cluster_id").cast("long").alias("cluster_id"), "model_type", "crime_type_filter"
    )


def kmeans_partition(spark, sf):
    """K-means with four clusters over places moved into four clumps far apart; a cluster
    is named by its smallest id."""
    beat = F.col("beat_num").cast("long")
    moved = e_spatial_table(spark, sf).withColumns(
        {"latitude": F.col("latitude") + 9 * (beat % 2), "longitude": F.col("longitude") + 7 * (F.floor(beat / 2) % 2)}
    )
    clumps = materialize(clustering.standardize(moved, DEGREES))
    labelled, _ = clustering.kmeans_labels(clumps, clustering.scaled_names(DEGREES), k=4)
    number = F.col("id").cast("long")
    names = labelled.groupBy("cluster_id").agg(F.min(number).alias("cluster"))
    return labelled.join(F.broadcast(names), "cluster_id").select("id", "cluster")


def guarded_rows(spark, sf):
    """The recent month if it has enough rows, else all."""
    feats = materialize(e_features(spark, sf))
    scan = lambda least: filters.recent_or_all(feats, least, as_of=date(2024, 2, 15))
    parts = [
        scan(least).agg(F.lit(name).alias("rows_of"), F.count("*").alias("records"), F.min("date").alias("since"))
        for name, least in (("recent month", 10), ("all", 2_000_000_000))
    ]
    return parts[0].unionByName(parts[1])


def stored_tables(spark, sf):
    """A table created, replaced and stamped, and the staging view over the raw rows."""
    schema = _own_schema(spark)
    rows = e_spatial_table(spark, sf).select("id", "date", "primary_type")
    for part in (rows.filter("primary_type = 'THEFT'"), rows):
        tables.replace_table(tables.with_provenance(part, "K-means", "ALL"), f"{schema}.incidents")
    view = f"stg_{schema}"
    create_staging_view(events_raw(spark, sf), view)
    stamped = spark.table(f"{schema}.incidents").groupBy("model_type", "crime_type_filter").agg(
        F.count("*").alias("records"), F.count("created_at").alias("stamped")
    )
    staged = spark.table(view).agg(
        F.lit("staging").alias("model_type"), F.lit("none").alias("crime_type_filter"),
        F.count("*").alias("records"), F.count("loaded_at").alias("stamped"),
    )
    return stamped.unionByName(staged)


def exported_hotspots(spark, sf):
    """The hotspot file, written as CSV and read back by its schema."""
    named = blob_profiles(spark, sf).select(
        "cluster_id", F.lit("DBSCAN").alias("model_type"), "risk_score", F.col("size").alias("cluster_size"),
        "top_crime_type", F.col("center_lat").alias("center_latitude"), F.col("center_lon").alias("center_longitude"),
        "violent_crime_ratio", "property_crime_ratio", "peak_hour", "weekend_ratio",
    )
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    exports.write_csv(exports.hotspot_export(named), path)
    read = landing.read_csv(spark, path, landing.HOTSPOT_CSV)
    whole = ("cluster_id", "cluster_size", "peak_hour")
    return read.select("model_type", "risk_score", "top_crime_type", *[F.col(c).cast("long").alias(c) for c in whole],
                       *[F.round(c, 6).alias(c) for c in ("lat", "lon", "violent_crime_ratio", "weekend_ratio")])


def raw_or_nothing(spark, sf):
    """The landed rows of a folder, and none of one that does not exist."""
    base = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    events_raw(spark, sf).write.parquet(f"{base}/raw")
    parts = [
        landing.read_raw(spark, f"{base}/{name}").agg(F.lit(name).alias("folder"), F.count("*").alias("records"))
        for name in ("raw", "absent")
    ]
    return parts[0].unionByName(parts[1])


def dbscan_dense(spark, sf):
    """Density clustering of mostly distinct places, a third of them in one block."""
    labelled = dbscan.dbscan(
        settled(lambda: lineitem_places(spark, sf)), DEGREES, 0.0002, 5, order_by=F.col("id")
    )
    return labelled.select("id", F.col("cluster_id").cast("long").alias("cluster_id"))


def kdistance_dense(spark, sf):
    """Fifth-nearest distances over distinct places and two constant features."""
    places = lineitem_places(spark, sf).withColumns({"level": F.lit(0.0), "floor": F.lit(1.5)})
    vectors = materialize(dbscan.distinct_vectors(places, ["level", "floor", *DEGREES]))
    curve = kdistance.kth_neighbour_distance(vectors, 4)
    return (
        curve.groupBy(F.round(F.col("kdist") * 1000, 3).alias("kdist_milli"))
        .agg(F.sum("n").alias("points"))
    )


def kdistance_tuning(spark, sf):
    vectors = materialize(dbscan.distinct_vectors(e_spatial_table(spark, sf), DEGREES))
    curve = kdistance.kth_neighbour_distance(vectors, 2)
    return (
        curve.groupBy(F.round("kdist", 6).alias("kdist"))
        .agg(F.sum("n").alias("points"))
    )


def kdistance_eps(spark, sf):
    vectors = materialize(dbscan.distinct_vectors(e_spatial_table(spark, sf), DEGREES))
    curve = kdistance.kth_neighbour_distance(vectors, 2)
    return kdistance.curve_elbow(curve).withColumns(r6("eps"))


def hotspot_profile(spark, sf):
    out = blob_profiles(spark, sf)
    rounded = (
        "center_lat center_lon lat_std lon_std violent_crime_ratio property_crime_ratio "
        "avg_distance_from_center weekend_ratio"
    ).split()
    return out.select(
        F.col("cluster_id").cast("long").alias("cluster_id"),
        "size",
        *[F.round(c, 6).alias(c) for c in rounded],
        "top_crime_type",
        F.col("peak_hour").cast("long").alias("peak_hour"),
        F.array_join(F.col("districts").cast("array<int>").cast("array<string>"), ",").alias("districts"),
        F.array_join(
            F.transform(
                F.array_sort(F.map_entries("crime_types")),
                lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")),
            ),
            ";",
        ).alias("crime_types"),
    )


def risk_score(spark, sf):
    return blob_profiles(spark, sf).select(
        F.col("cluster_id").cast("long").alias("cluster_id"), "size", "risk_score"
    )


def hotspot_summary(spark, sf):
    return hotspots.hotspot_summary(blob_profiles(spark, sf)).drop("top_hotspots")


def top_hotspots(spark, sf):
    return hotspots.top_hotspots(blob_profiles(spark, sf), 5).withColumn(
        "cluster_id", F.col("cluster_id").cast("long")
    )


def risk_levels(spark, sf):
    return (
        hotspots.with_risk_level(blob_profiles(spark, sf))
        .groupBy("risk_level")
        .agg(F.count("*").alias("hotspots"), F.max("risk_score").alias("highest"))
    )


def risk_band_filter(spark, sf):
    return filters.risk_band(blob_hotspots(spark, sf), "Moderate (40-59)").select(
        F.col("cluster_id").cast("long").alias("cluster_id"), "risk_score"
    )


def hotspot_kpis(spark, sf):
    return hotspots.hotspot_kpis(blob_hotspots(spark, sf))


def risk_histogram(spark, sf):
    out = hotspots.risk_histogram(blob_hotspots(spark, sf))
    return out.withColumn("bin", F.col("bin").cast("long"))


def risk_zone_table(spark, sf):
    return reports.risk_table(blob_hotspots(spark, sf))


def clusters_per_model(spark, sf):
    rows = e_blobs(spark, sf).select(
        F.when(F.col("cluster_id") % 2 == 0, "K-means").otherwise("DBSCAN").alias("model_type"),
        "cluster_id",
    )
    return hotspots.clusters_per_model(rows)


# --- time series ---------------------------------------------------------------


def o_series(spark, sf):
    return series.daily_series(o_typed(spark, sf))


def seasonal_decompose(spark, sf):
    parts = series.seasonal_decompose(o_series(spark, sf), 7)
    return parts.drop("error").withColumns(r6("trend", "seasonal", "residual"))


def series_summary(spark, sf):
    return series.series_summary(o_series(spark, sf)).withColumns(r6("mean_daily", "std_daily"))


def chronological_split(spark, sf):
    return (
        series.chronological_split(o_series(spark, sf))
        .groupBy("series_id", "is_train")
        .agg(F.count("*").alias("days"), F.min("date").alias("first_day"), F.sum("y").alias("incidents"))
    )


def _week_before(spark, sf):
    """Each day scored against the same weekday one and two weeks earlier."""
    from pyspark.sql import Window

    by_date = Window.partitionBy("series_id").orderBy("date")
    lagged = o_series(spark, sf).withColumns(
        {"one": F.lag("y", 7).over(by_date), "two": F.lag("y", 14).over(by_date)}
    )
    return (
        lagged.filter(F.col("two").isNotNull())
        .unpivot(["series_id", "date", "y"], ["one", "two"], "model_type", "yhat")
    )


def forecast_metrics(spark, sf):
    return series.forecast_metrics(_week_before(spark, sf)).withColumns(r6("mae", "rmse", "mape"))


def model_choice(spark, sf):
    return series.choose_model(series.forecast_metrics(_week_before(spark, sf))).withColumns(r6("best_score"))


def _naive_forecasts(spark, sf):
    return _week_before(spark, sf).select(
        F.col("series_id").alias("crime_type"),
        "model_type",
        "date",
        F.col("yhat").alias("forecast"),
        (F.col("yhat") / 3).alias("lower_ci"),
        (F.col("yhat") * 2).alias("upper_ci"),
    )


def forecast_summary(spark, sf):
    return reports.forecast_summary(_naive_forecasts(spark, sf))


def forecast_table(spark, sf):
    return reports.forecast_table(filters.of_model(_naive_forecasts(spark, sf), "one"))


def metric_table(spark, sf):
    metrics = series.forecast_metrics(_week_before(spark, sf))
    return reports.metric_comparison(metrics, ("one", "two")).withColumns(r6("one", "two"))


def ml_report(spark, sf):
    blobs = materialize(e_blobs(spark, sf).select("cluster_id"))
    return reports.ml_report(e_typed(spark, sf), _naive_forecasts(spark, sf), blobs, blob_hotspots(spark, sf))


def high_risk_hotspots(spark, sf):
    rows = hotspots.top_hotspots(blob_profiles(spark, sf), 8, above=70)
    return rows.withColumn("cluster_id", F.col("cluster_id").cast("long"))


def _fitted(model, days=30):
    def run(spark, sf):
        return forecasting.run_model(o_series(spark, sf), model, days).drop("params")

    return run


def adf_test(spark, sf):
    return forecasting.stationarity(o_series(spark, sf))


def forecast_report(spark, sf):
    ahead = forecasting.future_rows(forecasting.run_model(o_series(spark, sf), forecasting.ARIMA, 14))
    return reports.forecast_summary(ahead.withColumnRenamed("series_id", "crime_type"))


def model_comparison(spark, sf):
    """ARIMA against the additive model, with the metrics side by side."""
    daily = materialize(o_series(spark, sf))
    fitted = forecasting.run_model(daily, forecasting.ARIMA, 0).unionByName(
        forecasting.run_model(daily, forecasting.ADDITIVE, 0)
    )
    metrics = series.forecast_metrics(forecasting.test_rows(fitted))
    return reports.metric_comparison(metrics)


# --- exports -------------------------------------------------------------------


def sampled_export(spark, sf):
    full = features.lag_features(e_features(spark, sf))
    rounded = r6("distance_from_center", "crimes_7day_avg")
    whole = {n: F.col(n).cast("long") for n in ("hour", "day_of_week")}
    return exports.feature_sample(full).withColumns(rounded | whole)


def summary_document(spark, sf):
    """The nested summary with its lists written out as text."""
    doc = exports.summary_document(materialize(e_features(spark, sf)))
    listed = lambda col, f: F.array_join(F.transform(col, f), ";")
    return doc.select(
        "overall_stats.*",
        listed(
            "crime_distribution",
            lambda e: F.concat_ws("=", e["primary_type"], e["count"].cast("string")),
        ).alias("crime_distribution"),
        listed(
            "hourly_distribution",
            lambda e: F.concat_ws("=", e["hour"].cast("string"), e["crimes"].cast("string")),
        ).alias("hourly_distribution"),
    ).withColumns(r6("avg_distance_from_center"))


def export_manifest(spark, sf):
    feats = materialize(e_features(spark, sf))
    hot = blob_hotspots(spark, sf)
    sample = reports.random_sample(feats, 500)
    return exports.manifest(feats, sample, hot, filters.of_model(hot, "DBSCAN")).select(
        "files.*", "data_summary.*"
    )


def model_split(spark, sf):
    """The first rows of one model, riskiest first."""
    rows = filters.of_model(blob_hotspots(spark, sf), "DBSCAN")
    return reports.first_rows(rows, 5, F.desc("risk_score"), "cluster_id").select(
        F.col("cluster_id").cast("long").alias("cluster_id"), "risk_score", "cluster_size", "top_crime_type"
    )


Query = Callable[[SparkSession, str], DataFrame]


def on(operator: Callable[[DataFrame], DataFrame], source: Callable) -> Query:
    return lambda spark, sf: operator(source(spark, sf))


QUERIES: dict[str, Query] = {
    "staged_incidents": staged_incidents,
    "typed_incidents": e_typed,
    "parse_quality": parse_quality,
    "window_extract_day": window_extract(lambda r: landing.daily_extract(r, date(2024, 1, 10))),
    "window_extract_fallback": window_extract(
        lambda r: landing.daily_extract(r, date(2024, 5, 1), today=date(2024, 4, 10))
    ),
    "window_extract_range": window_extract(
        lambda r: landing.range_extract(r, date(2024, 1, 5), date(2024, 1, 7))
    ),
    "window_extract_month": window_extract(
        lambda r: landing.monthly_extract(r, 1998, 12), orders_raw
    ),
    "window_extract_year": window_extract(lambda r: landing.yearly_extract(r, 1998), orders_raw),
    "raw_envelope_append": raw_envelope_append,
    "crime_type_analysis": on(marts.crime_type_analysis, e_staged),
    "daily_patterns": on(marts.daily_patterns, e_staged),
    "location_analysis": on(marts.location_analysis, e_staged),
    "monthly_trends": on(marts.monthly_trends, o_staged),
    "yoy_by_type": on(marts.yoy_by_type, o_staged),
    "seasonal_yoy": on(marts.seasonal_yoy, o_staged),
    "trend_classification": on(marts.trend_classification, o_staged),
    "top_movers": on(marts.top_movers, o_staged),
    "analytics_summary": analytics_summary,
    "component_status": component_status,
    "component_health": component_health,
    "freshness": freshness,
    "temporal_features": temporal_features,
    "spatial_features": spatial_features,
    "crime_features": crime_features,
    "lag_features": lag_features,
    "stored_features": stored_features,
    "overall_stats": overall_stats,
    "type_share": on(reports.type_share, e_features),
    "top_types": on(reports.top_types, e_features),
    "hourly_distribution": on(lambda f: hours_as_long(reports.hourly_distribution(f)), e_features),
    "peak_hours": on(lambda f: hours_as_long(reports.peak_hours(f)), e_features),
    "distance_bands": on(reports.distance_bands, e_features),
    "feature_profile": feature_profile,
    "category_counts": category_counts,
    "trend_first_last_week": trend_first_last_week,
    "series_stats": series_stats,
    "bbox_filtered": bbox_filtered,
    "recent_window": recent_window,
    "spatial_profile": spatial_profile,
    "spatial_bounds": spatial_bounds,
    "grid_profile_10x10": grid_profile_10x10,
    "grid_features": grid_features,
    "scaled_features": scaled_features,
    "dashboard_filtered_counts": dashboard_filtered_counts,
    "dashboard_hourly": dashboard_hourly,
    "district_top8": district_top8,
    "season_counts": group_by("season"),
    "weekend_split": group_by("is_weekend"),
    "time_period_counts": group_by("time_period"),
    "severity_share": severity_share,
    "first_types": first_types,
    "nearest_center": nearest_center,
    "kmeans_assign": kmeans_assign,
    "kmeans_sweep": kmeans_sweep,
    "fitted_hotspots": fitted_hotspots,
    "violent_clusters": violent_clusters,
    "kmeans_partition": kmeans_partition,
    "guarded_rows": guarded_rows,
    "stored_tables": stored_tables,
    "exported_hotspots": exported_hotspots,
    "raw_or_nothing": raw_or_nothing,
    "rejected_records": rejected_records,
    "rejected_lines": rejected_lines,
    "streamed_counts": streamed_counts,
    "repeated_load": repeated_load,
    "keyed_append": keyed_append,
    "incremental_patterns": incremental_patterns,
    "dbscan_clusters": dbscan_clusters,
    "dbscan_quality": dbscan_quality,
    "blob_metrics": blob_metrics,
    "strip_sweep": strip_sweep,
    "dbscan_scaled": dbscan_scaled,
    "dbscan_dense": dbscan_dense,
    "kdistance_dense": kdistance_dense,
    "kdistance_tuning": kdistance_tuning,
    "kdistance_eps": kdistance_eps,
    "hotspot_profile": hotspot_profile,
    "risk_score": risk_score,
    "hotspot_summary": hotspot_summary,
    "top_hotspots": top_hotspots,
    "risk_levels": risk_levels,
    "risk_band_filter": risk_band_filter,
    "hotspot_kpis": hotspot_kpis,
    "risk_histogram": risk_histogram,
    "risk_zone_table": risk_zone_table,
    "clusters_per_model": clusters_per_model,
    "daily_series_filled": o_series,
    "seasonal_decompose": seasonal_decompose,
    "series_summary": series_summary,
    "chronological_split": chronological_split,
    "forecast_metrics": forecast_metrics,
    "model_choice": model_choice,
    "forecast_summary": forecast_summary,
    "forecast_table": forecast_table,
    "metric_table": metric_table,
    "ml_report": ml_report,
    "high_risk_hotspots": high_risk_hotspots,
    "arima_forecast": _fitted(forecasting.ARIMA),
    "additive_forecast": _fitted(forecasting.ADDITIVE),
    "adf_test": adf_test,
    "forecast_report": forecast_report,
    "model_comparison": model_comparison,
    "sampled_export": sampled_export,
    "summary_document": summary_document,
    "export_manifest": export_manifest,
    "model_split": model_split,
}
