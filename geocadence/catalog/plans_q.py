"""Queries of the composed stages: A5, A6, U2, M8, M9, scenarios, regional soil moisture."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import functions as F

from geocadence.catalog.grids_q import REGION, FINE, SQL_FINE, _SCATTER, _basin_cells, _fine_mask, hav
from geocadence.catalog.kernel_q import SQL_VECTORS, training
from geocadence.catalog.registry import (
    AREAS, SQL_AREA_DAYS, SQL_CELL_HOURS, Tables, area_days, big, cell_hours, query, r6, text,
)
from geocadence.functions.geo import Grid
from geocadence.functions.times import hour_floor, hours, ntz_lit
from geocadence.operators import grid as G
from geocadence.operators.kernel import collapse_model
from geocadence.operators.timespine import period_blocks, run_window
from geocadence.plans import indicators as PI
from geocadence.plans import predictors as PP
from geocadence.plans.scenarios import build_scenarios, finish_scenarios, update_days
from geocadence.plans.soil_moisture import regional_soil_moisture
from geocadence.session import scratch, stored
from geocadence.sources.versions import Versions

# Rain grid of the demonstration: two rows of two cells per area; fine mask grid of half the cell size.
RAIN = Grid(nrows=10, ncols=2, xll=8.0, yll=44.0, cellsize=0.05)
MASK = Grid(nrows=20, ncols=4, xll=8.0, yll=44.0, cellsize=0.025)
CIRCLE_KM = 5.0


def _area_index(c: str = "area"):
    return F.element_at(F.create_map(*chain.from_iterable((F.lit(a), F.lit(i)) for i, a in enumerate(AREAS))), F.col(c))


def _grid_cells(t: Tables):
    c = cell_hours(t)
    i = _area_index()
    return c.select("time", (i * 2 + F.floor(F.col("cell") / 2).cast("int")).alias("row"), F.pmod("cell", F.lit(2)).alias("col"), "value")


def _fine(t: Tables):
    area = F.element_at(F.array(*[F.lit(a) for a in AREAS]), F.floor(F.col("row") / 4).cast("int") + 1)
    return G.grid_cells(t.spark, MASK).select(
        area.alias("area"), F.col("row").alias("trow"), F.col("col").alias("tcol"), "lon", "lat",
        F.when(F.pmod(F.col("row") * 4 + F.col("col"), F.lit(5)) != 0, 1).otherwise(0).alias("mask"))


def _geometry(t: Tables, with_circles: bool = True):
    """Cell weights of the areas and circle membership, stored as the geometry stage does."""
    fine = _fine(t)
    mapping = stored(G.regrid_map(fine.select("trow", "tcol", "lon", "lat"), RAIN), "regrid-map")
    weights = G.cell_weights(mapping, fine, ["trow", "tcol"])
    if not with_circles:
        return weights, None
    pts = t.spark.createDataFrame([(a, i, p) for i, a in enumerate(AREAS) for p in (0, 1)], "area string, i int, point_id int").select(
        "area", "point_id", RAIN.lon(F.col("point_id")).alias("lon"), RAIN.lat(F.col("i") * 2 + F.col("point_id")).alias("lat"))
    mask = fine.select("area", F.col("trow").alias("row"), F.col("tcol").alias("col"), "mask")
    members = G.circle_members(pts, MASK, CIRCLE_KM, mask=mask, mask_keys=("area",)).withColumnsRenamed({"row": "trow", "col": "tcol"})
    return weights, stored(PI.source_circles(members.drop("lon", "lat"), mapping), "circles")


def _periods(t: Tables, obs: int, obs_partition: str):
    days = t.events.select(F.col("ts").cast("date").cast("timestamp_ntz").alias("d")).distinct()
    w = run_window(days.select((F.col("d") + hours(14)).alias("run")), 24, 24, snap_end="none").select("time_run", "window_start", "window_end")
    return stored(period_blocks(w, obs, 24, obs_partition=obs_partition), "periods")


def _quoted(a):
    return f"'{a}'"


_GEO_SQL = f"""areas(area, i) AS (VALUES {', '.join(f"('{a}', {i})" for i, a in enumerate(AREAS))}),
cells AS (SELECT time, i * 2 + cell // 2 AS row, cell % 2 AS col, value FROM cell_hours JOIN areas USING (area)),
fine AS (SELECT area, r AS trow, c AS tcol, 8.0125::DOUBLE + c * 0.025::DOUBLE AS lon, 44.4875::DOUBLE - r * 0.025::DOUBLE AS lat FROM range(0, 20) a(r), range(0, 4) b(c), areas
  WHERE r // 4 = i AND (r * 4 + c) % 5 <> 0),
src AS (SELECT r AS row, c AS col, 8.025::DOUBLE + c * 0.05::DOUBLE AS lon, 44.475::DOUBLE - r * 0.05::DOUBLE AS lat FROM range(0, 10) a(r), range(0, 2) b(c)),
map AS (SELECT f.area, f.trow, f.tcol, f.lon, f.lat, s.row, s.col FROM fine f, src s QUALIFY row_number() OVER (PARTITION BY f.trow, f.tcol ORDER BY {hav('f.lon', 'f.lat', 's.lon', 's.lat')}) = 1),
weights AS (SELECT area, row, col, COUNT(*) AS n FROM map GROUP BY ALL),
pts AS (SELECT area, p AS point_id, 8.025::DOUBLE + p * 0.05::DOUBLE AS lon, 44.475::DOUBLE - (i * 2 + p) * 0.05::DOUBLE AS lat FROM areas, range(0, 2) g(p)),
circles AS (SELECT DISTINCT m.area, point_id, m.row, m.col FROM map m JOIN pts p ON p.area = m.area AND {hav('p.lon', 'p.lat', 'm.lon', 'm.lat')} < 5000)"""


def _period_sql(obs_start: str) -> str:
    return f"""days AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS d FROM events),
per AS (SELECT d + INTERVAL 14 HOUR AS run, 'Observed_0001_Period' AS tag, 'Observed' AS ty, d - INTERVAL {obs_start} HOUR AS b, d AS e FROM days
  UNION ALL SELECT d + INTERVAL 14 HOUR, 'Forecast_0001_Period', 'Observed_Forecast', d + INTERVAL 1 HOUR, d + INTERVAL 24 HOUR FROM days)"""


_WIDTHS = (3, 6, 12, 24)


def _sum_frames(part: str) -> tuple[str, str]:
    cols = ", ".join(f"CASE WHEN COUNT(value) OVER w{n} = {n} THEN SUM(value) OVER w{n} END AS s{n}" for n in _WIDTHS)
    wins = ", ".join(f"w{n} AS (PARTITION BY {part} ORDER BY time RANGE BETWEEN INTERVAL {n - 1} HOUR PRECEDING AND CURRENT ROW)" for n in _WIDTHS)
    return cols, wins


_cc, _cw = _sum_frames("run, tag, row, col")
_ac, _aw = _sum_frames("area, run, tag")
_RAIN_SQL = f"""
WITH {SQL_CELL_HOURS}, {_GEO_SQL}, {_period_sql('23')},
base AS (SELECT run, tag, time, row, col, value FROM cells JOIN per ON time BETWEEN b AND e),
rolled AS (SELECT run, tag, row, col, time, {_cc} FROM base WINDOW {_cw}),
pk AS (SELECT area, run, tag, time, point_id, {', '.join(f'MAX(s{n}) AS p{n}' for n in _WIDTHS)} FROM rolled JOIN circles USING (row, col) GROUP BY ALL),
pm AS (SELECT area, run, tag, {', '.join(f'MAX(p{n}) AS px{n}, AVG(p{n}) AS pa{n}' for n in _WIDTHS)} FROM pk GROUP BY ALL),
ser AS (SELECT area, run, tag, time, SUM(value * n) / SUM(n) AS value FROM base JOIN weights USING (row, col) GROUP BY ALL),
ra AS (SELECT area, run, tag, time, {_ac} FROM ser WINDOW {_aw}),
am AS (SELECT area, run, tag, {', '.join(f'AVG(s{n} / {n}) AS aa{n}, MAX(s{n} / {n}) AS ax{n}, MIN(s{n} / {n}) AS an{n}, MAX(s{n}) AS sx{n}, MIN(s{n}) AS sn{n}' for n in _WIDTHS)} FROM ra GROUP BY ALL)
SELECT area, CAST(run AS VARCHAR) AS time_run, tag AS period_tag, ty AS period_type, CAST(CAST(b AS DATE) AS VARCHAR) AS time_key,
{', '.join(f'round(px{n} + 1e-9, 6) AS "rain_peak_{n}H:max", round(pa{n} + 1e-9, 6) AS "rain_peak_{n}H:avg", round(aa{n} + 1e-9, 6) AS "rain_average_{n}H:avg", round(ax{n} + 1e-9, 6) AS "rain_average_{n}H:max", round(an{n} + 1e-9, 6) AS "rain_average_{n}H:min", round(sx{n} + 1e-9, 6) AS "rain_accumulated_{n}H:max", round(sn{n} + 1e-9, 6) AS "rain_accumulated_{n}H:min"' for n in _WIDTHS)}
FROM am LEFT JOIN pm USING (area, run, tag) JOIN per USING (run, tag)"""


@query("a5_rain_indicators", _RAIN_SQL)
def a5(t: Tables):
    weights, circles = _geometry(t)
    out = PI.rain_indicators(_grid_cells(t), _periods(t, 24, "multiple"), weights, circles)
    values = [c for c in out.columns if c.startswith("rain_")]
    return out.select("area", text("time_run").alias("time_run"), "period_tag", "period_type", "time_key", *[r6(f"`{c}`").alias(c) for c in values])


_SM_ROWS = f"""{SQL_CELL_HOURS}, {_GEO_SQL}, {_period_sql('1')},
ser AS (SELECT area, run, tag, time, SUM(value * n) / SUM(n) AS value FROM cells JOIN per ON time BETWEEN b AND e JOIN weights USING (row, col) GROUP BY ALL),
sm AS (SELECT area, run, tag, AVG(value) AS a, MAX(value) AS x, arg_min(value, time) AS f, arg_max(value, time) AS l FROM ser GROUP BY ALL HAVING COUNT(*) > 1)"""


@query("a6_sm_indicators", f"""
WITH {_SM_ROWS}
SELECT area, CAST(run AS VARCHAR) AS time_run, tag AS period_tag, ty AS period_type, round(a + 1e-9, 6) AS sm_value_avg, round(x + 1e-9, 6) AS sm_value_max, round(f + 1e-9, 6) AS sm_value_first, round(l + 1e-9, 6) AS sm_value_last FROM sm JOIN per USING (run, tag)""")
def a6(t: Tables):
    weights, _ = _geometry(t, with_circles=False)
    out = PI.sm_indicators(_grid_cells(t), _periods(t, 2, "unique"), weights)
    return out.select("area", text("time_run").alias("time_run"), "period_tag", "period_type", *[r6(f"sm_value_{m}").alias(f"sm_value_{m}") for m in ("avg", "max", "first", "last")])


@query("u2_period_rows", f"""
WITH {_SM_ROWS} SELECT area, tag AS period_tag, COUNT(*) AS n FROM sm GROUP BY 1, 2""")
def u2(t: Tables):
    weights, _ = _geometry(t, with_circles=False)
    p = _periods(t, 2, "unique")
    parts = [PI.sm_indicators(_grid_cells(t), p.filter(F.col("period_type") == ty), weights) for ty in ("Observed", "Observed_Forecast")]
    return PI.append_periods(parts).groupBy("area", "period_tag").agg(F.count(F.lit(1)).alias("n"))


# --- scenarios -------------------------------------------------------------------------------------
_RAIN_OK, _SM_OK = "value > 17", "value <= 17"


def _indicator_runs(t: Tables, usable: str):
    """Indicator rows of every run: an hour with suitable events is a run that covers its day and the day before."""
    e = t.events.filter(usable).groupBy(
        F.col("event_type").alias("area"), hour_floor(F.col("ts")).alias("run_time")).agg((F.sum(F.round(F.col("value") * 100).cast("bigint")) / 100.0).alias("v"))
    day = F.col("run_time").cast("date")
    rows = F.explode(F.array(F.struct(day.alias("time"), F.col("v").alias("value")), F.struct(F.date_sub(day, 1).alias("time"), (F.col("v") * 2).alias("value"))))
    return e.select("area", "run_time", rows.alias("r")).select("area", "run_time", "r.time", "r.value")


def _ind_sql(name: str, usable: str) -> str:
    return f"""{name}_r AS (SELECT event_type AS area, date_trunc('hour', ts) AS run, SUM(CAST(round(value * 100) AS BIGINT)) / 100.0 AS v FROM events WHERE {usable} GROUP BY 1, 2),
{name}_rows AS (SELECT area, run, CAST(run AS DATE) AS time, v AS value FROM {name}_r UNION ALL SELECT area, run, CAST(CAST(run AS DATE) - INTERVAL 1 DAY AS DATE), v * 2 FROM {name}_r)"""


_SCENARIO_SQL = f"""
WITH {SQL_AREA_DAYS}, {_ind_sql('rain', _RAIN_OK)}, {_ind_sql('sm', _SM_OK)}, slips AS (SELECT area, time, n FROM area_days),
chosen AS (SELECT area, MAX(run) AS run FROM rain_r JOIN sm_r USING (area, run) WHERE area IN (SELECT area FROM slips) AND run <= TIMESTAMP '2024-01-20 13:00:00' GROUP BY area, CAST(run AS DATE)),
rn AS (SELECT area, time, arg_max(value, run) AS value, MAX(run) AS run FROM rain_rows JOIN chosen USING (area, run) GROUP BY area, time),
sn AS (SELECT area, time, arg_max(value, run) AS value, MAX(run) AS run FROM sm_rows JOIN chosen USING (area, run) GROUP BY area, time),
rx AS (SELECT rn.*, CASE WHEN run = MAX(run) OVER (PARTITION BY area) THEN 'latest' ELSE 'db' END AS tag FROM rn),
sx AS (SELECT sn.*, CASE WHEN run = MAX(run) OVER (PARTITION BY area) THEN 'latest' ELSE 'db' END AS tag FROM sn),
com AS (SELECT area, time FROM rx INTERSECT SELECT area, time FROM sx), bd AS (SELECT area, MIN(time) AS lo, MAX(time) AS hi FROM com GROUP BY area),
sp AS (SELECT area, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS time FROM bd),
mg AS (SELECT sp.area, sp.time, COALESCE(rx.value, -9999) AS value, rx.run AS rr, COALESCE(rx.tag, 'NA') AS rt, COALESCE(sx.value, -9999) AS sv, sx.run AS sr, COALESCE(sx.tag, 'NA') AS st, COALESCE(slips.n, -9999) AS n
  FROM sp LEFT JOIN com USING (area, time) LEFT JOIN rx ON rx.area = com.area AND rx.time = com.time LEFT JOIN sx ON sx.area = com.area AND sx.time = com.time LEFT JOIN slips ON slips.area = sp.area AND slips.time = sp.time),
gp AS (SELECT area, CAST(unnest(generate_series(TIMESTAMP '2023-12-25', CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS time FROM bd)
SELECT gp.area, CAST(gp.time AS VARCHAR) AS time, COALESCE(value, -9999) AS value, CAST(CASE WHEN mg.area IS NULL THEN CAST(gp.time AS TIMESTAMP) ELSE rr END AS VARCHAR) AS rain_time_run, COALESCE(rt, 'NoData') AS rain_latest_from,
  COALESCE(sv, -9999) AS sm_value, CAST(CASE WHEN mg.area IS NULL THEN CAST(gp.time AS TIMESTAMP) ELSE sr END AS VARCHAR) AS sm_time_run, COALESCE(st, 'NoData') AS sm_latest_from, COALESCE(n, -9999) AS n
FROM gp LEFT JOIN mg USING (area, time)"""


@query("scenario_table", _SCENARIO_SQL)
def scenario_table(t: Tables):
    slips = area_days(t).select("area", "time", "n")
    rain, sm = (stored(_indicator_runs(t, usable), name) for usable, name in ((_RAIN_OK, "rain-rows"), (_SM_OK, "sm-rows")))
    out = build_scenarios(rain, sm, slips, F.lit("2024-01-20 13:00:00").cast("timestamp_ntz"), F.lit("2023-12-25"))
    return out.drop("domain").withColumns({"rain_time_run": text("rain_time_run"), "sm_time_run": text("sm_time_run")})


@query("j6_incremental_scenarios", _SCENARIO_SQL)
def incremental_scenarios(t: Tables):
    """The same table from four updates: two of whole weeks, one within a day, one of the rest by run dates."""
    slips = area_days(t).select("area", "time", "n")
    rain, sm = (stored(_indicator_runs(t, usable).withColumn("run_date", F.to_date("run_time")), name) for usable, name in ((_RAIN_OK, "rain-rows"), (_SM_OK, "sm-rows")))
    days, runs = Versions(t.spark, scratch(t.spark, "scenario-days")), Versions(t.spark, scratch(t.spark, "scenario-runs"))
    for at, since in (("2024-01-09 06:00:00", None), ("2024-01-16 04:00:00", None), ("2024-01-16 19:00:00", "2024-01-16"), ("2024-01-20 13:00:00", "2024-01-16")):
        update_days(days, runs, rain, sm, slips, ntz_lit(at), since)
    out = finish_scenarios(days.read(), slips, F.lit("2023-12-25"))
    return out.drop("domain").withColumns({"rain_time_run": text("rain_time_run"), "sm_time_run": text("sm_time_run")})


# --- predictors ------------------------------------------------------------------------------------
_MAXIMA, _MEANS = [100.0, 5000.0, 10000.0, 366.0], [0.5, 0.4, 0.2, 0.05]


def _scenario_days(t: Tables):
    n = F.col("n")
    return area_days(t).select(
        "area", F.col("time"), n.cast("double").alias("sm_value_first"),
        F.when(F.pmod(n, F.lit(13)) == 0, -9999.0).otherwise(F.col("value")).alias("rain_accumulated_12H"), (F.col("value") / 2).alias("rain_peak_3H"),
        F.when(F.pmod(n, F.lit(3)) == 0, "Observed_Forecast").otherwise("Observed").alias("rain_period_type"),
        F.when(F.pmod(n, F.lit(5)) == 0, "Observed_Forecast").otherwise("Observed").alias("sm_period_type"), F.pmod(n, F.lit(16)).alias("slips_obs_n"))


_PRED = f"""{SQL_AREA_DAYS}, {SQL_VECTORS},
d AS (SELECT area, time, n, value, CASE WHEN n % 13 = 0 THEN -9999 ELSE value END AS acc, n % 3 = 0 OR n % 5 = 0 AS mixed FROM area_days),
k AS (SELECT area, MAX(time) AS k FROM d WHERE mixed GROUP BY area),
v AS (SELECT d.*, n / 100.0::DOUBLE - 0.5 AS z0, acc / 5000.0::DOUBLE - 0.4 AS z1, value / 2 / 10000.0::DOUBLE - 0.2 AS z2, dayofyear(time) / 366.0::DOUBLE - 0.05 AS z3 FROM d LEFT JOIN k USING (area) WHERE NOT (mixed AND time <> k) AND n % 13 <> 0),
s AS (SELECT area, time, n, SUM((y - 4.5) / 10.0 * pow(1 + z0 * x0 + z1 * x1 + z2 * x2 + z3 * x3, 3)) AS raw FROM v, vectors GROUP BY ALL),
p AS (SELECT area, time, n, CAST(greatest(round_even(raw, 0), 0) AS BIGINT) AS c FROM s),
q AS (SELECT *, CASE WHEN area = 'view' THEN CASE WHEN c = 0 THEN 0 WHEN c <= 2 THEN 1 WHEN c <= 5 THEN 2 WHEN c <= 13 THEN 3 WHEN c >= 14 THEN 4 END
  ELSE CASE WHEN c = 0 THEN 0 WHEN c <= 1 + length(area) % 3 THEN 1 WHEN c <= 4 + 2 * (length(area) % 3) THEN 2 WHEN c <= 9 + 3 * (length(area) % 3) THEN 3 WHEN c >= 10 THEN 4 END END AS lv FROM p)"""


def _own_levels(t: Tables):
    """Ranges that differ by area; the area ``view`` has none and takes the defaults."""
    k = F.pmod(F.length("name"), F.lit(3))
    none = F.lit(None).cast("int")
    entries = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(level).alias("level"), lo.alias("lo"), hi.alias("hi")) for i, (level, lo, hi) in enumerate([
        ("white", F.lit(0), F.lit(0)), ("green", F.lit(1), 1 + k), ("yellow", 2 + k, 4 + 2 * k), ("orange", 5 + 2 * k, 9 + 3 * k), ("red", 10 + 3 * k, none)])])
    return area_days(t).select(F.col("area").alias("name")).distinct().where("name <> 'view'").select("name", F.inline(entries))


def _predicted(t: Tables):
    model = collapse_model(training(t), 4, 3, maxima=_MAXIMA, means=_MEANS)
    return PP.predict(_scenario_days(t), model, levels=_own_levels(t))


@query("m8_predicted_slips", f"""
WITH {_PRED} SELECT area, CAST(time AS VARCHAR) AS time, c AS slips_pred_n, CAST(lv AS BIGINT) AS slips_pred_id, CASE lv WHEN 0 THEN 'white' WHEN 1 THEN 'green' WHEN 2 THEN 'yellow' WHEN 3 THEN 'orange' WHEN 4 THEN 'red' END AS slips_pred_alert_color FROM q""")
def m8(t: Tables):
    return _predicted(t).select("area", text("time").alias("time"), big("slips_pred_n").alias("slips_pred_n"), big("slips_pred_id").alias("slips_pred_id"), "slips_pred_alert_color")


@query("m8_predictor_table", f"""
WITH {_PRED}, sp AS (SELECT area, CAST(unnest(generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS time FROM (SELECT DISTINCT area FROM q))
SELECT sp.area, CAST(sp.time AS VARCHAR) AS time, COALESCE(c, -9999) AS soil_slips_pred_n, COALESCE(CAST(lv AS BIGINT), -9999) AS soil_slips_pred_alert_level,
  COALESCE(n % 16, -9999) AS soil_slips_obs_n, CASE WHEN q.area IS NULL THEN 'NA' ELSE 'v' END AS seen FROM sp LEFT JOIN q USING (area, time)""")
def m8_table(t: Tables):
    day = lambda s: F.lit(s).cast("date")
    out = PP.predictor_table(_predicted(t), day("2023-12-30"), day("2024-02-02"), names={
        "slips_pred_n": "soil_slips_pred_n", "slips_pred_id": "soil_slips_pred_alert_level", "slips_obs_n": "soil_slips_obs_n"})
    seen = F.when(F.col("rain_period_type") == "NA", "NA").otherwise("v")
    return out.select("area", text("time").alias("time"), "soil_slips_pred_n", "soil_slips_pred_alert_level", "soil_slips_obs_n", seen.alias("seen"))


@query("m9_review_table", f"""
WITH {_PRED} SELECT area, CAST(CASE WHEN n % 16 = 0 THEN 0 WHEN n % 16 <= 2 THEN 1 WHEN n % 16 <= 5 THEN 2 WHEN n % 16 <= 13 THEN 3 ELSE 4 END AS BIGINT) AS obs_id, CAST(lv AS BIGINT) AS slips_pred_id, COUNT(*) AS n FROM q GROUP BY 1, 2, 3""")
def m9(t: Tables):
    from geocadence.operators.alerts import classify_default
    both = classify_default(_predicted(t), "slips_obs_n", "obs").withColumns({"obs_id": big("obs_id"), "slips_pred_id": big("slips_pred_id")})
    return PP.review_table(both, "obs_id", "slips_pred_id", ["area"])


# --- regional soil moisture ------------------------------------------------------------------------
@query("sm_regional_grid", f"""
WITH {_SCATTER}, {SQL_FINE}, s AS (SELECT label, vec_id % 2 AS time, r, c, MAX(vec_id) AS m FROM idx WHERE r BETWEEN 0 AND 19 AND c BETWEEN 0 AND 19 GROUP BY ALL),
mo AS (SELECT time, r, c, arg_max(m / 10.0::DOUBLE, label) FILTER (m % 6 <> 0 AND m <> 101) AS v FROM s GROUP BY time, r, c),
reg AS (SELECT r, c, 7.715::DOUBLE + c * 0.03::DOUBLE AS lon, 44.285::DOUBLE - r * 0.03::DOUBLE AS lat FROM range(0, 20) a(r), range(0, 20) b(c)),
mp AS (SELECT f.row, f.col, f.m, reg.r, reg.c FROM fine f JOIN reg ON abs(f.lon - reg.lon) < 0.06 AND abs(f.lat - reg.lat) < 0.06
  QUALIFY row_number() OVER (PARTITION BY f.row, f.col ORDER BY round({hav('f.lon', 'f.lat', 'reg.lon', 'reg.lat')}, 3), reg.r, reg.c) = 1)
SELECT time, COUNT(*) AS cells, COUNT(v) FILTER (m) AS valid, round(SUM(v) FILTER (m) + 1e-9, 4) AS total FROM mo JOIN mp USING (r, c) WHERE row BETWEEN 5 AND 34 AND col BETWEEN 5 AND 34 GROUP BY time""")
def sm_regional(t: Tables):
    basins = _basin_cells(t).withColumns({"domain_order": F.col("domain"), "time": F.pmod("row", F.lit(2)).cast("bigint"), "value": F.col("value")})
    targets = G.grid_cells(t.spark, FINE).select(F.col("row").alias("trow"), F.col("col").alias("tcol"), "lon", "lat")
    out = regional_soil_moisture(basins, REGION, targets, _fine_mask(t), scale=10.0, no_data=10.1)
    out = out.filter(F.col("row").between(5, 34) & F.col("col").between(5, 34))
    return out.groupBy("time").agg(F.count(F.lit(1)).alias("cells"), F.count("value").alias("valid"), F.round(F.sum("value") + 1e-9, 4).alias("total"))
