"""Scenarios kept up to date against scenarios made anew."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from geocadence.functions.times import ntz_lit
from geocadence.plans.scenarios import build_scenarios, finish_scenarios, update_days
from geocadence.sources.versions import Versions

SCHEMA = "area string, run_time timestamp_ntz, time date, {} double"


def _runs(spark, runs, name, scale):
    """Rows of the runs' day and the day before; a value says which run wrote it."""
    data = [(a, r, r.date() - dt.timedelta(days=back), scale * (r.day * 100 + r.hour + back / 10)) for a, r in runs for back in (0, 1)]
    return spark.createDataFrame(data, SCHEMA.format(name)).withColumn("run_date", F.to_date("run_time"))


def _slips(spark):
    return spark.createDataFrame([(a, dt.date(2024, 2, d), d) for a in "xy" for d in (2, 5, 9)], "area string, time date, slips_n long")


def _full(spark, runs, reference):
    rain, sm = _runs(spark, runs, "rain_v", 1.0).drop("run_date"), _runs(spark, runs, "sm_v", 2.0).drop("run_date")
    return rows(build_scenarios(rain, sm, _slips(spark), ntz_lit(reference), F.lit("2024-01-30")))


def _update(spark, tables, runs, reference, **options):
    rain, sm = _runs(spark, runs, "rain_v", 1.0), _runs(spark, runs, "sm_v", 2.0)
    return [str(d) for d in update_days(*tables, rain, sm, _slips(spark), ntz_lit(reference), **options)]


def _got(spark, tables):
    return rows(finish_scenarios(tables[0].read(), _slips(spark), F.lit("2024-01-30")))


@pytest.fixture
def tables(spark, tmp_path):
    return Versions(spark, str(tmp_path / "days")), Versions(spark, str(tmp_path / "runs"))


RUNS = [(a, dt.datetime(2024, 2, d, h)) for a in "xy" for d in (1, 2, 4, 5, 8) for h in (8, 14)]


def test_new_runs_touch_their_days_only(spark, tables):
    assert _update(spark, tables, RUNS, "2024-02-05 10:00:00") == ["2024-01-31", "2024-02-01", "2024-02-02", "2024-02-03", "2024-02-04", "2024-02-05"]
    assert _got(spark, tables) == _full(spark, RUNS, "2024-02-05 10:00:00")
    old = tables[0].manifest()["parts"]
    # the run of 14 hours replaces that of 8 hours: its day and the day before
    assert _update(spark, tables, RUNS, "2024-02-05 15:00:00") == ["2024-02-04", "2024-02-05"]
    assert _got(spark, tables) == _full(spark, RUNS, "2024-02-05 15:00:00")
    new = tables[0].manifest()["parts"]
    assert {p for p in new if new[p] != old.get(p)} == {"2024-02-04", "2024-02-05"}
    assert _update(spark, tables, RUNS, "2024-02-05 15:00:00") == [] and tables[0].manifest()["parts"] == new
    # a newest run of one area: rows of the run it follows are no longer the latest
    more = RUNS + [("x", dt.datetime(2024, 2, 10, 8))]
    assert _update(spark, tables, more, "2024-02-12 00:00:00") == ["2024-02-04", "2024-02-05", "2024-02-07", "2024-02-08", "2024-02-09", "2024-02-10"]
    assert _got(spark, tables) == _full(spark, more, "2024-02-12 00:00:00")


def test_old_partitions_are_not_needed(spark, tables):
    _update(spark, tables, RUNS, "2024-02-08 10:00:00")
    newer = RUNS + [("x", dt.datetime(2024, 2, 9, 8)), ("y", dt.datetime(2024, 2, 9, 14))]
    late = [r for r in newer if r[1] >= dt.datetime(2024, 2, 8)]  # the tables lost all earlier runs
    assert _update(spark, tables, late, "2024-02-09 20:00:00", since=dt.date(2024, 2, 8)) == ["2024-02-07", "2024-02-08", "2024-02-09"]
    assert _got(spark, tables) == _full(spark, newer, "2024-02-09 20:00:00")


def test_runs_that_vanish_late_runs_and_rewritten_runs(spark, tables):
    _update(spark, tables, RUNS, "2024-02-12 00:00:00")
    fewer = [r for r in RUNS if r != ("y", dt.datetime(2024, 2, 8, 14)) and r[1].day != 2]
    assert _update(spark, tables, fewer, "2024-02-12 00:00:00") == ["2024-02-01", "2024-02-02", "2024-02-07", "2024-02-08"]
    assert _got(spark, tables) == _full(spark, fewer, "2024-02-12 00:00:00")
    late = fewer + [("x", dt.datetime(2024, 2, 3, 1))]
    assert _update(spark, tables, late, "2024-02-12 00:00:00") == ["2024-02-02", "2024-02-03"]
    assert _got(spark, tables) == _full(spark, late, "2024-02-12 00:00:00")
    again = spark.createDataFrame([("x", dt.datetime(2024, 2, 3, 1))], "area string, run_time timestamp_ntz")
    assert _update(spark, tables, late, "2024-02-12 00:00:00", redone=again) == ["2024-02-02", "2024-02-03"]
    # an earlier reference takes days away again
    assert "2024-02-08" in _update(spark, tables, late, "2024-02-05 23:00:00")
    assert _got(spark, tables) == _full(spark, late, "2024-02-05 23:00:00")
    assert "2024-02-08" not in tables[0].manifest()["parts"]


def test_an_update_that_was_cut_off_is_repeated(spark, tables, monkeypatch):
    _update(spark, tables, RUNS, "2024-02-05 10:00:00")
    with monkeypatch.context() as m:
        m.setattr(tables[1], "replace", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            _update(spark, tables, RUNS, "2024-02-08 10:00:00")
    assert _update(spark, tables, RUNS, "2024-02-08 20:00:00") != []
    assert _got(spark, tables) == _full(spark, RUNS, "2024-02-08 20:00:00")
