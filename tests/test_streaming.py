"""Streaming steps over several deliveries with one checkpoint."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from conftest import rows
from geocadence.streaming import jobs as J

T0 = datetime(2024, 1, 1)
SCHEMA = "event_id bigint, ts timestamp_ntz, area string, run int, value double"


@pytest.fixture()
def feed(spark, tmp_path):
    folder = tmp_path / "in"

    def deliver(data, part):
        df = spark.createDataFrame([(i, T0 + timedelta(minutes=m), a, r, v) for i, m, a, r, v in data], SCHEMA)
        df.coalesce(1).write.mode("append").parquet(str(folder))

    def stream():
        from pyspark.sql.types import _parse_datatype_string
        return J.file_stream(spark, str(folder), "*.parquet", _parse_datatype_string(SCHEMA))

    return deliver, stream, str(tmp_path / "out"), str(tmp_path / "cp")


def test_late_rows_count_until_the_limit(spark, feed):
    deliver, stream, out, cp = feed
    deliver([(1, 10, "a", 0, 1.0), (2, 70, "a", 0, 3.0), (3, 150, "a", 0, 5.0)], 1)
    J.run_hourly_means(stream(), "1 hour", out, cp)
    deliver([(4, 100, "a", 0, 7.0), (5, 20, "a", 0, 100.0), (6, 400, "a", 0, 9.0)], 2)  # 4 is in time, 5 too late
    J.run_hourly_means(stream(), "1 hour", out, cp)
    assert rows(spark.read.parquet(out), "time", "value") == [(T0, 1.0), (T0 + timedelta(hours=1), 5.0), (T0 + timedelta(hours=2), 5.0)]


def test_sums_of_all_widths_over_restarts(spark, feed):
    spark.conf.set(*J.STATE_STORE)
    deliver, stream, out, cp = feed
    hour = lambda h, v, area="a": (h, 60 * h + 5, area, 0, v)
    run = lambda: J.run_sliding_sums(stream(), "1 hour", [4, 2], out, cp)
    deliver([hour(0, 1.0), hour(1, 2.0), hour(2, 4.0), hour(4, 8.0)], 1)
    run()
    deliver([hour(5, 16.0), hour(3, 32.0), hour(1, 500.0), hour(6, None), hour(0, 64.0, "b"), hour(7, 128.0), hour(8, 256.0), hour(10, 1.0)], 2)  # hour 3 is in time, 1 too late
    run()
    deliver([hour(40, 1.0), hour(41, 2.0, "b")], 3)
    run()
    got = {(r.area, r.time): (r.value_2H, r.value_4H) for r in spark.read.parquet(out).collect()}
    want = {1: (3.0, None), 2: (6.0, None), 3: (36.0, 39.0), 4: (40.0, 46.0), 5: (24.0, 60.0), 8: (384.0, None)}
    assert got == {("a", T0 + timedelta(hours=h)): v for h, v in want.items()}


def test_the_ring_holds_the_widest_window_and_silent_areas_go(spark, feed):
    spark.conf.set(*J.STATE_STORE)
    deliver, stream, out, cp = feed
    run = lambda: J.run_sliding_sums(stream(), "1 hour", 5, out, cp)
    deliver([(h, 60 * h, a, 0, 1.0) for h in range(30) for a in "ab"], 1)
    run()
    state = lambda: {(r.key.area, r.user_map_key.hour) for r in spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "hours").load(cp).collect()}
    held = state()
    assert held and max(sum(k == a for k, _ in held) for a in "ab") <= 4
    deliver([(h, 60 * h, "a", 0, 1.0) for h in range(30, 60)], 2)
    run()
    deliver([(99, 60 * 61, "a", 0, 1.0)], 3)
    run()
    assert {k for k, _ in state()} == {"a"}
    assert {r.value for r in spark.read.parquet(out).collect()} == {5.0}


def test_ring_sums_equal_plain_sums():
    rng = np.random.default_rng(4)
    hours = np.sort(rng.choice(400, 320, replace=False))
    values = np.where(rng.random(320) < 0.05, np.nan, rng.random(320))
    known = dict(zip(hours.tolist(), values.tolist()))
    for got, w in zip(J.ring_sums(hours, values, [1, 3, 24]), [1, 3, 24]):
        want = [sum(known.get(h - k, np.nan) for k in range(w)) for h in hours.tolist()]
        assert np.allclose(got, want, equal_nan=True)


def test_newest_rows_over_deliveries(spark, feed):
    deliver, stream, out, cp = feed
    keys, order = ["area", "ts"], ["run", "event_id"]
    cols = ["area", "ts", "run", "event_id", "value"]
    deliver([(1, 0, "a", 1, 1.0), (2, 60, "a", 1, 2.0)], 1)
    J.run_newest_rows(stream().select(*cols), keys, order, out, cp, "ts", "2 days")
    deliver([(3, 0, "a", 2, 8.0), (4, 60, "a", 0, 9.0)], 2)
    J.run_newest_rows(stream().select(*cols), keys, order, out, cp, "ts", "2 days")
    assert rows(J.read_newest_rows(spark, out), "ts", "value") == [(T0, 8.0), (T0 + timedelta(hours=1), 2.0)]


def test_newest_rows_let_old_keys_go(spark, feed):
    deliver, stream, out, cp = feed
    keys, order = ["area", "ts"], ["run", "event_id"]
    cols = ["area", "ts", "run", "event_id", "value"]
    run = lambda: J.run_newest_rows(stream().select(*cols), keys, order, out, cp, time="ts", late="2 hours")
    deliver([(1, 0, "a", 1, 1.0), (2, 600, "a", 1, 2.0)], 1)
    run()
    deliver([(3, 0, "a", 2, 8.0), (4, 540, "a", 2, 9.0)], 2)  # the first is beyond the limit
    run()
    assert set(rows(J.read_newest_rows(spark, out), "ts", "value")) == {
        (T0, 1.0), (T0 + timedelta(hours=9), 9.0), (T0 + timedelta(hours=10), 2.0)}


def test_level_state_survives_a_restart(spark, feed):
    spark.conf.set(*J.STATE_STORE)
    deliver, stream, out, cp = feed
    hour = lambda h, n, i: [(i + k, 60 * h + k, "a", 0, 1.0) for k in range(n)]
    deliver(hour(0, 1, 0) + hour(1, 2, 10) + hour(2, 4, 20) + hour(5, 1, 30), 1)
    J.run_level_changes(stream(), "1 hour", out, cp)
    deliver(hour(6, 3, 40) + hour(9, 1, 50), 2)
    J.run_level_changes(stream(), "1 hour", out, cp)
    # levels 1, 1, 2 (hours 0-2), then 1 (hour 5), 2 (hour 6): written only on change
    assert rows(spark.read.parquet(out), "time", "previous", "level") == [
        (T0, None, 1), (T0 + timedelta(hours=2), 1, 2), (T0 + timedelta(hours=5), 2, 1), (T0 + timedelta(hours=6), 1, 2)]


def test_redelivered_steps_are_dropped(spark, feed):
    deliver, stream, out, cp = feed
    deliver([(1, 0, "a", 0, 1.0), (2, 0, "a", 0, 1.0), (3, 60, "b", 0, 1.0)], 1)
    J.run_distinct_steps(stream(), ["area", "ts"], "3 hours", out, cp)
    deliver([(4, 0, "a", 0, 1.0), (5, 120, "a", 0, 1.0)], 2)
    J.run_distinct_steps(stream(), ["area", "ts"], "3 hours", out, cp)
    assert rows(spark.read.parquet(out)) == [("a", T0), ("a", T0 + timedelta(hours=2)), ("b", T0 + timedelta(hours=1))]
