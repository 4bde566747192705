"""Gap rules (FIXTURES 3: gap on resume, missing intervals, silence timers)."""

import datetime as dt

import pytest

from tsquality.config import DEFAULT
from tsquality.operators.gaps import gap_events, missing_intervals, silence_alerts

from helpers import readings, ts


def _us(s):
    return int(ts(s).replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)


@pytest.mark.parametrize("current,interval,expected", [
    ("10:30:00", 30, None),
    ("10:45:00", 30, None),
    ("10:45:59", 30, ("10:30:00", "10:45:59", 15)),
    ("11:00:00", 30, ("10:30:00", "11:00:00", 30)),
    ("12:00:00", 30, ("10:30:00", "12:00:00", 90)),
    ("10:01:31", 1, None),
    ("10:02:00", 1, ("10:01:00", "10:02:00", 1)),
])
def test_gap_on_resume(spark, current, interval, expected):
    cfg = DEFAULT.with_(interval_minutes=interval)
    df = readings(spark, [("M1", "2024-01-01 10:00:00", 1.0), ("M1", f"2024-01-01 {current}", 1.0)])
    got = [(r.missing_from.strftime("%H:%M:%S"), r.missing_to.strftime("%H:%M:%S"), r.gap_minutes)
           for r in gap_events(df, cfg).collect()]
    assert got == ([] if expected is None else [expected])


def test_out_of_order_does_not_open_gap(spark):
    df = readings(spark, [("M1", "2024-01-01 10:00:00", 1.0), ("M1", "2024-01-01 09:50:00", 1.0)])
    got = gap_events(df, DEFAULT).collect()
    # In event-time order 09:50 precedes 10:00: 10 minutes apart, no gap.
    assert got == []


def test_missing_intervals(spark):
    gaps = spark.createDataFrame([("M1", ts("2024-01-01 10:30:00"), ts("2024-01-01 12:10:00"))],
                                 "meter_id string, missing_from timestamp, missing_to timestamp")
    one = [(r.slot_from.strftime("%H:%M"), r.slot_to.strftime("%H:%M"), r.slot_minutes)
           for r in missing_intervals(gaps, DEFAULT).orderBy("slot_from").collect()]
    assert one == [("10:30", "11:00", 30), ("11:00", "11:30", 30), ("11:30", "12:00", 30), ("12:00", "12:10", 10)]
    two = [(r.slot_from.strftime("%H:%M"), r.slot_to.strftime("%H:%M"))
           for r in missing_intervals(gaps, DEFAULT, stride=2).orderBy("slot_from").collect()]
    assert two == [("10:30", "11:00"), ("11:30", "12:00")]
    none = spark.createDataFrame([("M1", ts("2024-01-01 10:30:00"), ts("2024-01-01 10:30:00"))],
                                 "meter_id string, missing_from timestamp, missing_to timestamp")
    assert missing_intervals(none, DEFAULT).count() == 0


@pytest.mark.parametrize("final,expected", [
    ("10:44:59", []),
    ("10:45:00", [("10:30", "10:45")]),
    ("11:15:00", [("10:30", "10:45"), ("11:00", "11:15")]),
    ("12:00:00", [("10:30", "10:45"), ("11:00", "11:15"), ("11:30", "11:45")]),
])
def test_silence_timers(spark, final, expected):
    df = readings(spark, [("M1", "2024-01-01 10:00:00", 1.0)])
    got = [(r.missing_from.strftime("%H:%M"), r.missing_to.strftime("%H:%M"), r.gap_minutes)
           for r in silence_alerts(df, DEFAULT, final_wm_us=_us(f"2024-01-01 {final}")).orderBy("missing_from").collect()]
    assert got == [(a, b, 15) for a, b in expected]


def test_silence_stops_at_next_reading_and_ttl(spark):
    df = readings(spark, [("M1", "2024-01-01 10:00:00", 1.0), ("M1", "2024-01-01 11:20:00", 1.0),
                          ("M2", "2024-01-20 00:00:00", 1.0)])
    got = silence_alerts(df, DEFAULT).where("meter_id = 'M1'").orderBy("missing_from").collect()
    froms = [r.missing_from.strftime("%m-%d %H:%M") for r in got]
    # 10:45 fires before the 11:20 reading; 11:15 too (due before 11:20), then the cascade restarts
    assert froms[:2] == ["01-01 10:30", "01-01 11:00"]
    # after 11:20 the cascade runs until the TTL of 7 days: (7 d - 15 min) / 30 min = 335 steps
    assert len(froms) == 2 + 335
