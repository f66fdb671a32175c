from datetime import date

import pytest

from helpers import raw
from incidentlens.operators.staging import create_staging_view, parse_counts, stage, typed
from incidentlens.sources import landing


@pytest.fixture
def mixed(spark):
    return raw(
        spark,
        [
            ("1", "2024-01-01T10:00:00", {"primary_type": "THEFT", "arrest": True, "latitude": "41.9", "year": "2024"}),
            ("2", "2024-01-01T11:00:00", {"arrest": "true", "latitude": "x", "longitude": -87.6, "year": "2024.0"}),
            ("3", "2024-01-02T00:00:00", {"arrest": "TRUE", "latitude": "nan"}),
            ("4", "2024-01-02T01:00:00", {}),
            ("5", "2024-01-03T00:00:00", "not json"),
            ("6", "2024-01-03T00:00:00", "[1, 2]"),
            ("7", "2024-01-03T00:00:00", "null"),
            (None, "2024-01-03T00:00:00", {}),
            ("8", None, {}),
            ("9", "2024-01-03T00:00:00", None),
        ],
    )


def test_staging_gate_and_text_fields(mixed):
    rows = {r.id: r for r in stage(mixed).collect()}
    assert set(rows) == {"1", "2", "3", "4", "5", "6", "7"}
    assert rows["1"].arrest == "true" and rows["2"].arrest == "true"
    assert rows["3"].arrest == "TRUE" and rows["4"].arrest is None
    assert rows["1"].incident_date == date(2024, 1, 1)
    assert rows["2"].longitude == "-87.6"


def test_typed_drops_only_malformed_records(mixed):
    rows = {r.id: r for r in typed(mixed).collect()}
    assert set(rows) == {"1", "2", "3", "4", None, "8"}
    assert [rows[i].arrest for i in "1234"] == [True, True, False, False]
    assert rows["1"].latitude == 41.9 and rows["1"].year == 2024
    assert rows["2"].latitude is None and rows["2"].longitude == -87.6 and rows["2"].year is None
    assert rows["3"].latitude is None


def test_parse_counts(mixed):
    row = parse_counts(mixed).first()
    assert (row.parsed, row.dropped) == (6, 4)


def test_record_is_parsed_once(mixed):
    plan = typed(mixed).filter("latitude > 41 and longitude < 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_staging_view(spark, mixed):
    assert create_staging_view(mixed, "stg_test") == 7
    assert spark.table("stg_test").count() == 7


def test_extracts(mixed):
    days = lambda df: sorted(r.id for r in df.collect() if r.id)
    assert days(landing.daily_extract(mixed, date(2024, 1, 1))) == ["1", "2"]
    assert days(landing.range_extract(mixed, date(2024, 1, 1), date(2024, 1, 2))) == ["1", "2", "3", "4"]
    assert landing.daily_extract(mixed, date(2024, 1, 1), limit=1).count() == 1
    assert landing.monthly_extract(mixed, 2024, 1).count() == 9
    assert landing.monthly_extract(mixed, 2023, 12).count() == 0
    assert landing.yearly_extract(mixed, 2024).count() == 9


def test_future_day_falls_back():
    today = date(2024, 4, 10)
    assert landing.effective_day(date(2024, 4, 10), today) == date(2024, 1, 11)
    assert landing.effective_day(date(2024, 4, 9), today) == date(2024, 4, 9)


def test_range_reaches_the_scan(spark, mixed, tmp_path):
    mixed.write.parquet(str(tmp_path / "raw"))
    plan = landing.daily_extract(landing.read_raw(spark, str(tmp_path / "raw")), date(2024, 1, 1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date" in text and "LessThan(date" in text


def test_missing_path_is_empty(spark, tmp_path):
    empty = landing.read_raw(spark, str(tmp_path / "nothing"))
    assert empty.count() == 0 and "record_data" in empty.columns


def test_jdbc_reader_needs_no_connection_to_plan():
    assert callable(landing.read_jdbc)
