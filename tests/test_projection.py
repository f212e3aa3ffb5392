"""Map coordinates against known places and round trips; selection windows of runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from geocadence.functions.projection import projection
from geocadence.operators.inventory import selection_window
from geocadence.sources.tables import parse_polygons


def _forward(spark, epsg, lon, lat):
    d = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    return tuple(d.select(*projection(epsg).forward(F.col("lon"), F.col("lat"))).first())


def test_known_places(spark):
    # length of the meridian from the equator to 45 degrees on WGS 84, times the scale of the zone
    x, y = _forward(spark, 32633, 15.0, 45.0)
    assert x == pytest.approx(500000.0, abs=1e-6) and y == pytest.approx(4984944.378 * 0.9996, abs=1e-3)
    x, y = _forward(spark, 32617, -79.387139, 43.642567)
    assert (x, y) == (pytest.approx(630084, abs=1), pytest.approx(4833439, abs=1))
    assert _forward(spark, 32733, 15.0, 0.0)[1] == pytest.approx(10000000.0, abs=1e-6)
    assert _forward(spark, 3857, 180.0, 0.0)[0] == pytest.approx(20037508.342789, abs=1e-5)


@pytest.mark.parametrize("epsg,lon0", [(32632, 9.0), (32732, 9.0), (25833, 15.0), (32601, -177.0), (32660, 177.0), (3857, 0.0)])
def test_round_trip(spark, epsg, lon0):
    system = projection(epsg)
    d = spark.range(61 * 81).select((F.lit(lon0) + (F.col("id") % 61 - 30) / 10.0).alias("lon"), (F.floor(F.col("id") / 61) * 2.0 - 80).alias("lat"))
    x, y = system.forward(F.col("lon"), F.col("lat"))
    back = d.select("*", x.alias("x"), y.alias("y"))
    lon, lat = system.inverse(F.col("x"), F.col("y"))
    worst = back.select(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(worst) < 1e-9


def test_polygons_in_metres(spark):
    d = spark.createDataFrame([("a", "POLYGON ((500000 0, 600000 0, 500000 100000, 500000 0))"), ("b", None), ("c", "POLYGON EMPTY")], "code string, wkt string")
    got = {r[0]: r[1] for r in parse_polygons(d, "code", epsg=32632).collect()}
    assert len(got["a"][0]) == 3 and got["a"][0][0]["x"] == pytest.approx(9.0) and got["a"][0][0]["y"] == pytest.approx(0.0, abs=1e-12)
    assert got["b"] is None and got["c"] == []
    with pytest.raises(ValueError, match="unknown"):
        parse_polygons(d, "code", epsg=3003)
    assert projection(4326) is None


def _run(spark, ini="202401120300", obs="202401121100", end="202401141200"):
    return spark.createDataFrame([(ini, obs, end)], "DateIni string, DateObs string, DateEnd string")


def _window(df, **how):
    return rows(selection_window(df, **how), "window_start", "window_end")


def test_windows(spark):
    d = _run(spark)
    at = lambda *x: dt.datetime(2024, 1, *x)
    now = F.lit("2024-01-14 08:59:59").cast("timestamp_ntz")
    assert _window(d) == [(at(12, 3), at(14, 12))]
    assert _window(d, limit_to_obs=True) == [(at(12, 3), at(12, 11))]
    assert _window(d, days_back=2) == [(at(10, 3), at(14, 12))]
    assert _window(d, days_back=2, start_hour="06:30") == [(at(10, 6, 30), at(14, 12))]
    assert _window(d, start_hour="06:30") == [(at(12, 3), at(14, 12))]  # only days back have a start hour
    assert _window(d, flatten_hour="09:00", now=now) == [(at(11, 3), at(14, 12))]
    assert _window(d, flatten_hour="08:59", now=now) == [(at(12, 3), at(14, 12))]
    assert _window(d, flatten_hour="09:00") == [(at(12, 3), at(14, 12))]
    assert _window(d, flatten_hour="09:00", now=now, days_back=1, start_hour="00:00") == [(at(10), at(14, 12))]


def test_windows_without_stamps(spark):
    for bad in (_run(spark, ini=None), _run(spark, end="2024011"), _run(spark, end="202413011200")):
        with pytest.raises(Exception, match="lacks the stamps"):
            _window(bad)
        assert _window(bad, missing="skip") == []
    no_obs = _run(spark, obs=None)
    assert len(_window(no_obs)) == 1
    with pytest.raises(Exception, match="lacks the stamps"):
        _window(no_obs, limit_to_obs=True)
