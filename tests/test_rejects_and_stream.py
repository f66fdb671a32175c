"""Rejected records and lines, and the stream with late and repeated records."""

from datetime import date, datetime

import pytest
from incidentlens.operators.staging import REASONS, split_records, typed
from incidentlens.schema import RAW
from incidentlens.sources import landing
from incidentlens.streaming import daily_counts
from pyspark.sql import functions as F

GOOD = '{"primary_type": "THEFT", "latitude": 41.9}'


def test_every_reason(spark, tmp_path):
    t = datetime(2024, 1, 1)
    rows = [
        ("1", t, GOOD), ("2", t, "{}"), (None, t, GOOD), ("3", None, GOOD), ("4", t, None), ("5", t, "[1, 2]"),
        ("6", t, " "), ("7", t, '"text"'), ("8", t, GOOD[:20]), ("9", t, "  " + GOOD), (None, None, None),
    ]
    df = spark.createDataFrame([(*r, t, "s") for r in rows], RAW)
    good, bad, counts = split_records(df, str(tmp_path / "out"))
    assert sorted(r.id for r in good.collect()) == ["1", "2", "9"] and good.schema == df.schema
    assert {(r.id, r.record_data): r.reason for r in bad.collect()} == {
        (None, GOOD): "no id", ("3", GOOD): "no date", ("4", None): "no payload", ("5", "[1, 2]"): "not an object",
        ("6", " "): "not an object", ("7", '"text"'): "not an object", ("8", GOOD[:20]): "malformed", (None, None): "no id",
    }
    assert counts == {"good": 3, "no id": 2, "no date": 1, "no payload": 1, "not an object": 3, "malformed": 1}
    assert set(counts) == {"good", *REASONS} and typed(good).count() == 3
    none, nothing, zero = split_records(df.limit(0), str(tmp_path / "none"))
    assert none.count() == nothing.count() == 0 and zero == {"good": 0}


@pytest.mark.parametrize("form,lines,good,bad", [
    ("csv", ["1,a,2.5", "x,b,1", "2,c", '3,"q,r",4', "4,d,1,2", "5,,"], [1, 3, 5], ["x,b,1", "2,c", "4,d,1,2"]),
    ("json", ['{"n": 1, "s": "a", "v": 2.5}', "[]", '[{"n": 8}]', '{"n": "x"}', '{"n": 2', "{}", "null", '{"n": 3}'],
     [1, None, 3], ["[]", '[{"n": 8}]', '{"n": "x"}', '{"n": 2', "null"]),
])
def test_lines_that_do_not_fit(spark, tmp_path, form, lines, good, bad):
    (tmp_path / "in").write_text("\n".join(lines) + "\n")
    found, rejected, counts = landing.split_file(spark, str(tmp_path / "in"), "n long, s string, v double", form, str(tmp_path / "out"))
    assert sorted((r.n for r in found.collect()), key=str) == sorted(good, key=str) and found.columns == ["n", "s", "v"]
    assert sorted(r.line for r in rejected.collect()) == sorted(bad)
    assert counts == {"good": len(good), "rejected": len(bad)}


def test_stream_counts_late_and_repeated_records_once(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("landing", "counts", "state")]
    ddl = "id long, date timestamp_ntz, event_type string, value double"
    row = lambda i, day, kind="a": (i, datetime(2024, 1, day, i % 24), kind, float(i))

    def arrive(rows):
        df = spark.createDataFrame(rows, ddl)
        df.coalesce(1).write.mode("append").json(paths[0])
        query = daily_counts.count_new_files(spark, paths[0], df.schema, *paths[1:])
        query.awaitTermination()
        return {(r.incident_date.day, r.event_type): (r.records, r.total) for r in daily_counts.read_counts(spark, paths[1]).collect()}

    assert arrive([row(1, 1), row(2, 1), row(2, 1), row(3, 5, "b")]) == {(1, "a"): (2, 3.0), (5, "b"): (1, 3.0)}
    # repeated, late by two days, new
    got = arrive([row(3, 5, "b"), row(4, 3), row(5, 6)])
    assert got == {(1, "a"): (2, 3.0), (5, "b"): (1, 3.0), (3, "a"): (1, 4.0), (6, "a"): (1, 5.0)}
    # later than the delay: dropped; nothing else changes, also when nothing new has come
    assert arrive([row(6, 1), row(7, 6)]) == got | {(6, "a"): (2, 12.0)}
    query = daily_counts.count_new_files(spark, paths[0], spark.createDataFrame([], ddl).schema, *paths[1:])
    query.awaitTermination()
    assert daily_counts.read_counts(spark, paths[1]).filter(F.col("incident_date") == date(2024, 1, 6)).first().records == 2
