import datetime as dt
import math

import __spark_entry__ as entry

_EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _events(spark, tmp_path, rows):
    folder = str(tmp_path / "tables")
    spark.createDataFrame(rows, _EVENTS).write.parquet(f"{folder}/events.parquet")
    return folder


def test_pct_change_after_a_zero_value(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=i), 1, "a", v, None) for i, v in enumerate([2.0, 0.0, 3.0, 0.0, -4.0, 0.0, 0.0, 5.0])]
    got = {r.event_id: r.pct for r in entry.queries()["q_frame_pct_change"](spark, _events(spark, tmp_path, rows)).collect()}
    assert got[0] is None
    assert got[1] == -1.0
    assert got[2] == math.inf
    assert got[4] == -math.inf
    assert math.isnan(got[6])
    assert got[7] == math.inf


def test_to_datetime_seconds_past_int_range(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    ids = [3, 596_524, 6_000_001, 2_500_000_000]
    rows = [(i, t0, 1, "a", 1.5, None) for i in ids]
    got = {r.event_id: r.seconds for r in entry.queries()["q_frame_to_datetime"](spark, _events(spark, tmp_path, rows)).collect()}
    assert got == {i: i * 3600 for i in ids}
