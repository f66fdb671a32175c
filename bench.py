"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores.
Every query is built and run in full (all rows produced, none collected)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from incidentlens.plans.catalog import QUERIES  # noqa: E402
from incidentlens.session import build_session  # noqa: E402

HEADLINE = (
    "staged_incidents", "typed_incidents", "window_extract_year", "raw_envelope_append",
    "crime_type_analysis", "daily_patterns", "location_analysis", "monthly_trends",
    "yoy_by_type", "seasonal_yoy", "trend_classification", "analytics_summary",
    "temporal_features", "spatial_features", "crime_features", "lag_features",
    "stored_features", "overall_stats", "type_share", "hourly_distribution",
    "distance_bands", "dashboard_filtered_counts", "district_top8", "grid_features",
    "scaled_features", "nearest_center", "kmeans_assign", "kmeans_sweep",
    "dbscan_clusters", "dbscan_scaled", "kdistance_eps", "hotspot_profile",
    "risk_score", "daily_series_filled", "seasonal_decompose", "forecast_metrics",
    "arima_forecast", "additive_forecast", "adf_test", "model_comparison",
    "sampled_export", "summary_document", "dbscan_dense", "kdistance_dense", "blob_metrics",
    "strip_sweep",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["crime_type_analysis"](spark, sf_dir).collect()  # start the JVM's engines
    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
