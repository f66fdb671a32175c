from helpers import incidents
from incidentlens.operators import marts
from incidentlens.operators.staging import stage


def staged(spark, rows):
    return stage(incidents(spark, rows))


def test_mode_tie_takes_smallest(spark):
    day = "2024-01-01T00:00:00"
    df = staged(spark, [(day, t, None, "1", "1", "STREET") for t in ("b", "a", "b", "a")])
    assert marts.daily_patterns(df).first().most_common_crime == "a"
    assert marts.location_analysis(df).first().most_common_crime == "a"


def test_missing_type_counts_in_totals_only(spark):
    day = "2024-01-01T00:00:00"
    df = staged(spark, [(day, None), (day, None), (day, "a", True)])
    row = marts.daily_patterns(df).first()
    assert (row.total_incidents, row.unique_crime_types, row.most_common_crime, row.arrests_made) == (3, 1, "a", 1)
    assert marts.crime_type_analysis(df).count() == 1


def test_locations_with_one_incident_are_dropped(spark):
    day = "2024-01-01T00:00:00"
    rows = [(day, "a", None, "1", "1", "STREET")] * 2 + [(day, "a", None, "2", "1", "STREET"), (day, "a", None, None, None, "PARK")]
    assert [r.district for r in marts.location_analysis(staged(spark, rows)).collect()] == ["1"]


def test_moving_average_and_lag_count_rows_not_months(spark):
    rows = []
    for n, month in enumerate(["2023-01", "2023-02", "2023-05"], start=1):
        rows += [(f"{month}-01T00:00:00", "a")] * n
    out = {r.month.isoformat(): r for r in marts.monthly_trends(staged(spark, rows)).collect()}
    assert out["2023-05-01"].three_month_avg == 2.0  # rows, although two months lie between
    assert out["2023-02-01"].three_month_avg == 1.5
    assert out["2023-05-01"].same_month_prev_year is None and out["2023-05-01"].yoy_change_percent is None


def test_year_over_year(spark):
    rows = [("2022-03-01T00:00:00", "a")] * 4 + [("2023-03-01T00:00:00", "a", True)] * 5 + [("2023-01-01T00:00:00", "new")]
    out = marts.yoy_by_type(staged(spark, rows)).collect()
    assert len(out) == 1  # a type without an earlier year has nothing to compare
    row = out[0]
    assert row.yoy_incident_change_percent == 25.0
    assert row.prev_year_arrests == 0 and row.yoy_arrest_change_percent is None
    assert row.arrest_rate_change_points == 100.0


def test_seasons_in_order(spark):
    rows = [(f"2023-{m:02d}-15T00:00:00", "a") for m in range(1, 13)]
    assert [r.season for r in marts.seasonal_yoy(staged(spark, rows)).collect()] == ["Winter", "Spring", "Summer", "Fall"]


def test_trend_uses_calendar_years_before_the_latest(spark):
    rows = (
        [("2020-01-01T00:00:00", "a")] * 10  # third year present, but not latest - 2
        + [("2022-01-01T00:00:00", "a")] * 10
        + [("2023-01-01T00:00:00", "a")] * 11
        + [("2022-01-01T00:00:00", "b")] * 10
        + [("2023-01-01T00:00:00", "b")] * 8
        + [("2022-01-01T00:00:00", "c")] * 10
        + [("2023-01-01T00:00:00", "c")] * 12
        + [("2023-01-01T00:00:00", "new")]
    )
    df = staged(spark, rows)
    out = {r.primary_type: r for r in marts.trend_classification(df).collect()}
    assert {k: r.trend_category for k, r in out.items()} == {"a": "Stable", "b": "Declining", "c": "Growing"}
    assert out["a"].two_years_ago_incidents == 0 and out["a"].two_year_change_percent is None
    movers = [(r.analysis_type.split()[1], r.primary_type) for r in marts.top_movers(df, 1).collect()]
    assert movers == [("Growing", "c"), ("Declining", "b")]


def test_no_detail_rows_in_single_partition_windows(spark):
    """The only single-partition exchange of a mart is over one row per month."""
    df = staged(spark, [("2024-01-01T00:00:00", "a")])
    plan = marts.daily_patterns(df)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
