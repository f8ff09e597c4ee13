"""A backlog read file by file counts every row, whatever its age."""

import functools
import os
from datetime import datetime

from cartwheel.streaming import daily_events


def test_rows_older_than_ten_years_count_in_any_batch(spark, tmp_path, monkeypatch):
    schema = "event_id long, user_id long, event_type string, ts timestamp_ntz"
    folder = f"{tmp_path}/events.parquet"
    for n, year in enumerate((2024, 2010, 2024, 2010)):
        before = set(os.listdir(folder)) if n else set()
        spark.createDataFrame([(n, n, "view", datetime(year, 5, 1, 12))], schema).coalesce(1).write.mode("append").parquet(folder)
        for name in set(os.listdir(folder)) - before:  # the stream reads the oldest file first
            os.utime(f"{folder}/{name}", (1_700_000_000 + n, 1_700_000_000 + n))
    monkeypatch.setattr(daily_events, "clickstream_stream",
                        functools.partial(daily_events.clickstream_stream, max_files_per_trigger=1))
    got = {(str(r.date), r.event): r["count"] for r in daily_events.daily_event_counts(spark, str(tmp_path)).collect()}
    assert got == {("2024-05-01", "view"): 2, ("2010-05-01", "view"): 2}
