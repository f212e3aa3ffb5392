"""Inventory queries: A10, A15, A16, J16, J17, J19, O1-O6, S14b, U5, U6."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geocadence.catalog.registry import Tables, big, query, r6, text
from geocadence.functions.text import run_label_of
from geocadence.functions.times import hour_floor, hours, minute_floor, minutes
from geocadence.operators import inventory as I
from geocadence.operators.scenario import missing_steps
from geocadence.sources.runs import find_each, match_names


def _hhmm(c):
    return F.regexp_replace(F.substring(c.cast("string"), 12, 5), ":", "")


def _days(c):
    return F.col(c).cast("date")


# Runs: one per day and 6-hour slot that has an event, labelled by the slot's first minute.
def _runs(t: Tables):
    return t.events.groupBy(
        _days("ts").alias("day"), F.floor(F.hour("ts") / 6).alias("slot")).agg(F.min("ts").alias("first")) \
        .select("day", _hhmm(F.col("first")).alias("run"), minute_floor(F.col("first")).alias("run_time"))


SQL_RUNS = """runs AS (SELECT CAST(ts AS DATE) AS day, strftime(MIN(ts), '%H%M') AS run, date_trunc('minute', MIN(ts)) AS run_time
  FROM events GROUP BY CAST(ts AS DATE), hour(ts) // 6)"""


@query("j16_latest_run", f"""
WITH {SQL_RUNS}, q AS (SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%H%M') AS hhmm FROM events)
SELECT event_id, CAST(q.day AS VARCHAR) AS day, hhmm, MAX(run) AS run FROM q LEFT JOIN runs ON runs.day = q.day AND run <= hhmm GROUP BY ALL""")
def j16(t: Tables):
    targets = t.events.select("event_id", _days("ts").alias("day"), _hhmm(F.col("ts")).alias("hhmm"))
    return I.latest_run(targets, _runs(t)).withColumn("day", text("day"))


_ASOF = f"""{SQL_RUNS}, q AS (SELECT event_id, ts FROM events),
d AS (SELECT DISTINCT date_trunc('hour', ts) - to_hours(CAST(hour(ts) % 4 AS INTEGER)) AS h FROM events),
b AS (SELECT event_id, ts, MAX(h) AS h FROM q LEFT JOIN d ON h <= date_trunc('hour', ts) AND h >= date_trunc('hour', ts) - INTERVAL 2 HOUR GROUP BY ALL),
c AS (SELECT b.event_id, b.ts, b.h, run_time, abs(date_diff('minute', run_time, date_trunc('minute', ts))) AS delta FROM b LEFT JOIN runs ON day = CAST(ts AS DATE)
  AND abs(date_diff('minute', run_time, date_trunc('minute', ts))) <= 120),
n AS (SELECT event_id, ts, h, run_time FROM c QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY delta, run_time DESC) = 1)"""


@query("j17_asof_tolerance", f"""
WITH {_ASOF}
SELECT event_id, CAST(COALESCE(n.h, d.h) AS VARCHAR) AS picked, CASE WHEN n.h = date_trunc('hour', ts) THEN 'exact' WHEN n.h IS NOT NULL THEN 'backward'
  WHEN d.h IS NOT NULL THEN 'nearest_run' ELSE 'none' END AS pick
FROM n LEFT JOIN d ON d.h = date_trunc('hour', run_time)""")
def j17(t: Tables):
    from geocadence.functions.times import from_hour_index
    targets = t.events.select("event_id", F.col("ts").alias("run_time"))
    data = t.events.select((hour_floor(F.col("ts")) - hours(F.hour("ts") % 4)).alias("time"))  # one hour in four has data
    out = I.select_data_time(targets, data, _runs(t), tolerance_hours=2)
    return out.select("event_id", text(from_hour_index(F.col("picked_hour"))).alias("picked"), "pick")


@query("j17_nearest_run", f"""
WITH {SQL_RUNS}, q AS (SELECT event_id, date_trunc('minute', ts) AS m FROM events)
SELECT event_id, (SELECT CAST(hour(run_time) * 60 + minute(run_time) AS BIGINT) FROM runs WHERE day = CAST(m AS DATE) AND abs(date_diff('minute', run_time, m)) <= 90
  ORDER BY abs(date_diff('minute', run_time, m)), run_time DESC LIMIT 1) AS run_minute FROM q""")
def j17_nearest(t: Tables):
    targets = t.events.select("event_id", F.col("ts").alias("run_time"))
    return I.nearest_run(targets, _runs(t), 90).select("event_id", big("run_minute").alias("run_minute"))


# Files: one per event, grouped by type; the name carries a minute, the file time is a little later.
def _files(t: Tables):
    stamp = F.regexp_replace(F.substring(F.col("ts").cast("string"), 1, 16), "[-: ]", "")
    name = F.concat(F.lit("f_"), stamp, F.lit("_"), F.col("event_id").cast("string"), F.when(F.pmod("event_id", F.lit(9)) == 0, ".tmp").otherwise(".csv"))
    return t.events.select(
        F.col("event_type").alias("group"), _days("ts").alias("day"), F.concat(F.lit("/data/"), F.col("event_type"), F.lit("/"), name).alias("path"),
        (F.col("ts") + minutes(F.pmod("event_id", F.lit(50)))).alias("mtime"), minute_floor(F.col("ts")).alias("name_time"), "event_id",
        run_label_of(F.concat(F.lit("info_run_"), F.substring(stamp, 1, 8), F.lit("_"), F.substring(stamp, 9, 4), F.lit(".json"))).alias("label"))


SQL_FILES = """files AS (SELECT event_type AS "group", CAST(ts AS DATE) AS day, '/data/' || event_type || '/f_' || strftime(ts, '%Y%m%d%H%M') || '_' || event_id || CASE WHEN event_id % 9 = 0 THEN '.tmp' ELSE '.csv' END AS path,
  'f_' || strftime(ts, '%Y%m%d%H%M') || '_' || event_id || CASE WHEN event_id % 9 = 0 THEN '.tmp' ELSE '.csv' END AS name,
  ts + to_minutes(CAST(event_id % 50 AS INTEGER)) AS mtime, date_trunc('minute', ts) AS name_time, event_id, strftime(ts, '%H:%M') AS label FROM events)"""


@query("j19_newest_under_ceiling", f"""
WITH {SQL_FILES} SELECT "group", CAST(day AS VARCHAR) AS day, arg_max(path, {{'a': mtime, 'b': name}}) AS path FROM files WHERE label <= '13:30' GROUP BY 1, day""")
def j19(t: Tables):
    return I.newest_under_ceiling(_files(t), ["group", "day"], "label", "13:30").withColumn("day", text("day"))


@query("u5_newest_file", f"""
WITH {SQL_FILES} SELECT "group", arg_max(path, {{'a': mtime, 'b': name}}) AS path FROM files GROUP BY 1""")
def u5(t: Tables):
    return I.newest_file(_files(t), ["group"])


@query("u6_first_path_per_time", f"""
WITH {SQL_FILES} SELECT "group", CAST(date_trunc('hour', name_time) AS VARCHAR) AS time, MIN(path) AS path FROM files GROUP BY 1, date_trunc('hour', name_time)""")
def u6(t: Tables):
    f = _files(t).withColumn("time", hour_floor(F.col("name_time")))
    return I.first_path_per_time(f, ["group"]).withColumn("time", text("time"))


@query("a10_group_summary", f"""
WITH {SQL_FILES} SELECT "group", CAST(day AS VARCHAR) AS day, COUNT(*) AS seen_count, CAST(MIN(mtime) AS VARCHAR) AS oldest_fs_time, CAST(MAX(mtime) AS VARCHAR) AS newest_fs_time,
  CAST(MIN(name_time) AS VARCHAR) AS oldest_name_time, CAST(MAX(name_time) AS VARCHAR) AS newest_name_time FROM files GROUP BY 1, day""")
def a10(t: Tables):
    out = I.group_summary(_files(t), ["day"])
    return out.withColumns({c: text(c) for c in ("day", "oldest_fs_time", "newest_fs_time", "oldest_name_time", "newest_name_time")})


# For the run catalogue: groups data_rain, data_sm and info; side files in the info group.
def _run_files(t: Tables):
    f = _files(t).join(_runs(t).select("day", "run"), "day")
    k = F.col("group")
    return f.select(
        "day", "run", F.when(k == "click", "data_rain").when(k == "view", "Data_sm").otherwise("info").alias("group"),
        F.when(k == "error", F.concat(F.lit("/i/ME_"), F.col("event_id").cast("string"), F.lit(".json"))).otherwise(F.col("path")).alias("path"),
        "mtime", F.when(F.pmod("event_id", F.lit(4)) != 0, F.col("name_time")).alias("name_time"))


@query("o1_run_catalogue", f"""
WITH {SQL_FILES}, {SQL_RUNS}, tg AS (SELECT CAST(ts AS DATE) AS day, strftime(arg_min(ts, event_id), '%H%M') AS hhmm FROM events WHERE event_type = 'signup' GROUP BY 1),
ch AS (SELECT tg.day, MAX(run) AS run FROM tg JOIN runs ON runs.day = tg.day AND run <= hhmm GROUP BY tg.day),
rt AS (SELECT ch.day, ch.run, runs.run_time FROM ch JOIN runs USING (day, run)),
dt AS (SELECT day, MIN(mtime) AS a, MAX(mtime) AS b, MIN(name_time) FILTER (event_id % 4 <> 0) AS c, MAX(name_time) FILTER (event_id % 4 <> 0) AS d FROM files WHERE "group" IN ('click', 'view') GROUP BY day),
me AS (SELECT day, arg_max('/i/ME_' || event_id || '.json', {{'a': mtime, 'b': 'ME_' || event_id || '.json'}}) AS p FROM files WHERE "group" = 'error' GROUP BY day)
SELECT CAST(day AS VARCHAR) AS day, run, strftime(run_time, '%Y-%m-%d %H:%M') AS algo_run_time, strftime(a, '%Y-%m-%d %H:%M') AS overall_oldest_fs_time, strftime(b, '%Y-%m-%d %H:%M') AS overall_newest_fs_time,
  strftime(c, '%Y-%m-%d %H:%M') AS overall_oldest_name_time, strftime(d, '%Y-%m-%d %H:%M') AS overall_newest_name_time,
  round((epoch_us(run_time) - epoch_us(COALESCE(d, b))) / 3600000000.0 + 1e-9, 6) AS diff_hours_run_minus_latest, CASE WHEN d IS NOT NULL THEN 'filename' WHEN b IS NOT NULL THEN 'filesystem' END AS diff_basis, p AS me_path, CAST(NULL AS VARCHAR) AS mc_path
FROM rt LEFT JOIN dt USING (day) LEFT JOIN me USING (day)""")
def o1(t: Tables):
    targets = t.events.filter("event_type = 'signup'").groupBy(_days("ts").alias("day")).agg(_hhmm(F.min_by("ts", "event_id")).alias("hhmm"))
    out = I.run_catalogue(_run_files(t), targets)
    return out.withColumns({"day": text("day"), "diff_hours_run_minus_latest": r6("diff_hours_run_minus_latest")})


_SEL = f"""{SQL_FILES}, inw AS (SELECT * FROM files WHERE name_time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'),
f AS (SELECT "group", day, name_time, MIN(path) AS path FROM inw GROUP BY 1, 2, 3),
walk AS (SELECT "group", day, MIN(name_time) AS name_time FROM f GROUP BY 1, 2
  UNION ALL SELECT "group", day, name_time FROM (SELECT w."group", w.day, MIN(f.name_time) AS name_time FROM walk w JOIN f ON f."group" = w."group" AND f.day = w.day AND f.name_time >= w.name_time + INTERVAL 60 MINUTE GROUP BY w."group", w.day)),
sel AS (SELECT i.* FROM walk w JOIN f ON f."group" = w."group" AND f.day = w.day AND f.name_time = w.name_time JOIN inw i ON i.path = f.path),
gate AS (SELECT *, epoch_us(TIMESTAMP '2024-01-12 12:00:00') - epoch_us(mtime) BETWEEN 0 AND CAST(72 AS BIGINT) * 3600000000 AS keep FROM sel)"""


def _selection(t: Tables):
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-05 00:00:00", "2024-01-12 12:00:00"))
    files = _files(t).withColumnRenamed("name_time", "data_time").withColumns({"oldest": F.lit(None).cast("timestamp_ntz"), "run_time": hi})
    return files, I.selection_set(files, ["group", "day"], lo, hi, 60, 72), lo, hi


@query("o2_selection_set", f"""WITH RECURSIVE {_SEL} SELECT "group", CAST(day AS VARCHAR) AS day, path, keep FROM gate""")
def o2(t: Tables):
    _, sel, _, _ = _selection(t)
    return sel.select("group", text("day").alias("day"), "path", "keep")


# fixed values: the ways of choosing a window, by name
_WINDOWS = {
    "plain": {}, "observed": {"limit_to_obs": True}, "back": {"days_back": 3}, "back_at": {"days_back": 2, "start_hour": "06:30"},
    "early": {"flatten_hour": "09:15", "days_back": 1}, "late": {"flatten_hour": "07:00"},
}


@query("o2_selection_window", f"""
WITH {SQL_FILES}, s AS (SELECT "group", TIMESTAMP '2024-01-12 00:00:00' + to_hours(length("group")) AS ini, TIMESTAMP '2024-01-13 08:00:00' AS obs, TIMESTAMP '2024-01-14 12:00:00' + to_minutes(length("group")) AS fin FROM (SELECT DISTINCT "group" FROM files)),
w AS (SELECT 'plain' AS way, "group", ini AS a, fin AS b FROM s UNION ALL SELECT 'observed', "group", ini, obs FROM s UNION ALL SELECT 'back', "group", ini - INTERVAL 3 DAY, fin FROM s
  UNION ALL SELECT 'back_at', "group", TIMESTAMP '2024-01-10 06:30:00', fin FROM s UNION ALL SELECT 'early', "group", ini - INTERVAL 2 DAY, fin FROM s UNION ALL SELECT 'late', "group", ini, fin FROM s)
SELECT way, w."group", CAST(a AS VARCHAR) AS window_start, CAST(b AS VARCHAR) AS window_end, COUNT(path) AS files FROM w LEFT JOIN files ON files."group" = w."group" AND name_time BETWEEN a AND b GROUP BY ALL""")
def o2_window(t: Tables):
    files = _files(t)
    size, stamp = F.length("group"), lambda c: F.date_format(c, "yyyyMMddHHmm")
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    runs = files.select("group").distinct().select(
        "group", stamp(at("2024-01-12 00:00:00") + hours(size)).alias("DateIni"), F.lit("202401130800").alias("DateObs"),
        stamp(at("2024-01-14 12:00:00") + minutes(size)).alias("DateEnd"))
    ways = [I.selection_window(runs, now=at("2024-01-14 08:30:00"), **how).withColumn("way", F.lit(way)) for way, how in _WINDOWS.items()]
    windows = reduce(DataFrame.unionByName, ways)
    inside = F.col("name_time").between(F.col("window_start"), F.col("window_end"))
    return windows.join(files.select("group", "name_time"), "group", "left").groupBy(
        "way", "group", text("window_start").alias("window_start"), text("window_end").alias("window_end")).agg(F.count_if(inside).alias("files"))


@query("a15_sync_report", f"""
WITH RECURSIVE {_SEL}, c AS (SELECT "group", COUNT(*) AS candidates, COUNT(*) FILTER (name_time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00') AS within_window FROM files GROUP BY 1),
g AS (SELECT "group", COUNT(*) AS selected, COUNT(*) FILTER (keep) AS selected_after_gate FROM gate GROUP BY 1)
SELECT "group", candidates, within_window, COALESCE(selected, 0) AS selected, COALESCE(selected_after_gate, 0) AS selected_after_gate FROM c LEFT JOIN g USING ("group")""")
def a15(t: Tables):
    files, sel, lo, hi = _selection(t)
    return I.sync_report(files, sel, ["group"], lo, hi)


@query("o3_stale_files", f"""
WITH {SQL_FILES}, s AS (SELECT day + CAST(CASE WHEN event_id % 8 = 0 THEN 1 ELSE 0 END AS INTEGER) AS folder_day, path, name FROM files)
SELECT CAST(folder_day AS VARCHAR) AS folder_day, path FROM s WHERE NOT contains(name, strftime(folder_day, '%Y%m%d'))""")
def o3(t: Tables):
    f = _files(t).withColumn("folder_day", F.date_add("day", F.when(F.pmod("event_id", F.lit(8)) == 0, 1).otherwise(0)))
    out = I.stale_files(f, F.regexp_replace(F.col("folder_day").cast("string"), "-", ""))
    return out.select(text("folder_day").alias("folder_day"), "path")


@query("o4_wrong_extension", f"""WITH {SQL_FILES} SELECT "group", path FROM files WHERE path NOT LIKE '%.csv' AND day BETWEEN DATE '2024-01-03' AND DATE '2024-01-20'""")
def o4(t: Tables):
    f = _files(t).filter(F.col("day").between("2024-01-03", "2024-01-20"))
    return I.wrong_extension(f, ".csv").select("group", "path")


@query("o5_archive_plan", f"""
WITH {SQL_FILES}, r("group", mode) AS (VALUES ('click', 'all'), ('view', 'latest_mtime'), ('error', 'latest_name')),
j AS (SELECT * FROM files JOIN r USING ("group"))
SELECT "group", CAST(day AS VARCHAR) AS day, mode, path FROM j WHERE mode = 'all'
UNION ALL SELECT "group", CAST(day AS VARCHAR), mode, CASE WHEN mode = 'latest_mtime' THEN arg_max(path, {{'a': mtime, 'b': name}}) ELSE arg_max(path, name) END FROM j WHERE mode <> 'all' GROUP BY 1, day, mode""")
def o5(t: Tables):
    rules = t.spark.createDataFrame([("click", "all"), ("view", "latest_mtime"), ("error", "latest_name")], "group string, mode string")
    return I.archive_plan(_files(t), rules, ["group", "day"]).withColumn("day", text("day"))


_BACKFILL = """WITH b AS (SELECT event_type AS area, MIN(date_trunc('hour', ts)) AS lo, MAX(date_trunc('hour', ts)) AS hi FROM events GROUP BY 1),
s AS (SELECT area, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS time FROM b)"""


def _expected_hours(t: Tables):
    have = t.events.select(F.col("event_type").alias("area"), hour_floor(F.col("ts")).alias("time"))
    spine = have.groupBy("area").agg(F.min("time").alias("lo"), F.max("time").alias("hi")).select(
        "area", F.explode(F.sequence("lo", "hi", hours(1))).alias("time"))
    return spine, have


@query("o6_missing_files", f"""{_BACKFILL}
SELECT area, 'grid_sm_' || strftime(time, '%Y%m%d%H%M') || '.nc' AS name FROM s WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_type = area AND date_trunc('hour', ts) = time)""")
def o6(t: Tables):
    spine, have = _expected_hours(t)
    stamp = F.regexp_replace(F.substring(F.col("time").cast("string"), 1, 16), "[-: ]", "")
    return missing_steps(spine, have, ["area", "time"]).select("area", F.concat(F.lit("grid_sm_"), stamp, F.lit(".nc")).alias("name"))


@query("a16_expected_present", f"""{_BACKFILL}, h AS (SELECT DISTINCT event_type AS area, date_trunc('hour', ts) AS time FROM events)
SELECT s.area, COUNT(*) AS expected, COUNT(h.time) AS present FROM s LEFT JOIN h USING (area, time) GROUP BY s.area""")
def a16(t: Tables):
    spine, have = _expected_hours(t)
    hit = have.distinct().withColumn("hit", F.lit(1))
    return spine.join(hit, ["area", "time"], "left").groupBy("area").agg(F.count(F.lit(1)).alias("expected"), F.count("hit").alias("present"))


@query("s14b_one_match", f"""
WITH {SQL_FILES}, m AS (SELECT "group", day, MIN(path) AS path, COUNT(DISTINCT path) AS n FROM files WHERE regexp_matches(name, '^f_[0-9]{{8}}0[0-9]{{3}}_.*[.]csv$') GROUP BY 1, 2)
SELECT g."group", CAST(g.day AS VARCHAR) AS day, CASE WHEN n = 1 THEN path END AS path, CASE WHEN n IS NULL THEN 'none' WHEN n = 1 THEN 'one' ELSE 'several' END AS found
FROM (SELECT DISTINCT "group", day FROM files) g LEFT JOIN m ON m."group" = g."group" AND m.day = g.day""")
def s14b_one(t: Tables):
    files = _files(t)
    return find_each(files.select("group", "day").distinct(), files, "f_????????0???_*.csv", ["group", "day"]).select("group", text("day").alias("day"), "path", "found")


@query("s14b_wildcard_matches", f"""
WITH {SQL_FILES} SELECT path FROM files WHERE regexp_matches(name, '^f_20240115[0-9]{{4}}_.*[.]csv$')""")
def s14b(t: Tables):
    return match_names(_files(t), "f_20240115????_*.csv").select("path")
