"""Counts of a stream hold every window, those that end after the last event included."""

from datetime import datetime, timedelta

from sieveline.queries import QUERIES

T0 = datetime(2024, 1, 1)


def test_open_windows_are_counted(spark, tmp_path):
    rows = [(0, T0, 1, "view", 60.0), (1, T0 + timedelta(minutes=10), 1, "view", 5.0), (2, T0 + timedelta(hours=3), 2, "view", 5.0), (3, T0 + timedelta(hours=3, minutes=59), 2, "view", 70.0), (4, T0 + timedelta(hours=3, minutes=1), 2, "view", 1.0)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").repartition(2).write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(tuple(r) for r in QUERIES["stream_level_counts"](spark, str(tmp_path)).select("window_start", "level", "n").collect())
    late = T0 + timedelta(hours=3)
    assert got == [(T0, "Private", 1), (T0, "Public", 1), (late, "Private", 1), (late, "Public", 2)]
