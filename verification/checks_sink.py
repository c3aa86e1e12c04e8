"""Sinks and table maintenance (section 2.2), backfill (2.15): each query writes and returns what is then read."""

from pyspark.sql import functions as F

from aeroloom import vocab
from aeroloom.operators import locations, normalize, rollups
from aeroloom.plans import daily as daily_plan, views
from aeroloom.session import saved, scratch_path
from aeroloom.sinks import tables as t
from aeroloom.sources import landing
from verification.checks_aggregate import COPIES, _copies
from verification.checks_source import landed
from verification.feeds import NOW, PROC_DATE, TSI_FED
from verification.registry import add

_SEL = "SELECT ts AS timestamp, native_sensor_id, pm2_5, CAST(ts AS DATE) AS dt FROM tsi"
_COLS = ["timestamp", "native_sensor_id", "pm2_5", "dt"]


def _land_twice(d, force):
    """Land the first half, then everything with doubled values."""
    root = scratch_path(d.spark, "landing")
    rows = d.tsi().withColumnRenamed("ts", "timestamp")
    t.write_landing(rows.filter("timestamp < timestamp_ntz'2024-01-16'"), root, "TSI")
    t.write_landing(rows.withColumn("pm2_5", F.col("pm2_5") * 2), root, "TSI", force=force)
    return landing.scan_landing(d.spark, root, "TSI").select(_COLS)


add("k01_write_landing", lambda d: _land_twice(d, False),
    "SELECT ts AS timestamp, native_sensor_id, CASE WHEN ts < timestamp '2024-01-16' THEN pm2_5 ELSE pm2_5 * 2 END AS pm2_5, CAST(ts AS DATE) AS dt FROM tsi", "pm2_5")
add("k01_write_landing_force", lambda d: _land_twice(d, True),
    "SELECT ts AS timestamp, native_sensor_id, pm2_5 * 2 AS pm2_5, CAST(ts AS DATE) AS dt FROM tsi", "pm2_5")


def _daily_table(d):
    path = scratch_path(d.spark, "daily")
    rows = d.daily().drop("geog").withColumn("dt", F.to_date("day_ts"))
    t.replace_window(rows, path, "2024-01-01", PROC_DATE)
    return path, rows


_DT = "SELECT *, CAST(day_ts AS DATE) AS dt FROM daily"
_STATS = "latitude longitude avg_value min_value max_value"


def _replace_day(d, cleared):
    path, rows = _daily_table(d)
    day = rows.filter("dt = date'2024-01-20'")
    t.replace_day(day.filter("false") if cleared else day.filter("metric_name = 'pm2_5'"), path, "2024-01-20")
    return d.spark.read.schema(rows.schema).parquet(path)


add("k02_replace_day", lambda d: _replace_day(d, False), f"SELECT * FROM ({_DT}) WHERE dt <> date '2024-01-20' OR metric_name = 'pm2_5'", _STATS)
add("k02_replace_day_empty", lambda d: _replace_day(d, True), f"SELECT * FROM ({_DT}) WHERE dt <> date '2024-01-20'", _STATS)


def _replace_window(d):
    """Rewrite a week whose new rows leave two days empty."""
    path, rows = _daily_table(d)
    t.replace_window(rows.filter("dt NOT IN (date'2024-01-25', date'2024-01-28') AND samples > 1"), path, "2024-01-24", PROC_DATE)
    return d.spark.read.schema(rows.schema).parquet(path)


add("k03_replace_window", _replace_window,
    f"SELECT * FROM ({_DT}) WHERE dt < date '2024-01-24' OR (dt NOT IN (date '2024-01-25', date '2024-01-28') AND samples > 1)", _STATS)


def _replace_all(d):
    path = scratch_path(d.spark, "canonical")
    older = locations.canonical_location(d.wu(), d.tsi(), "2024-01-15").drop("canonical_geog")
    t.replace_all(older, path)
    t.replace_all(d.canonical().drop("canonical_geog"), path)
    return d.spark.read.parquet(path)


add("k04_replace_all", _replace_all, "SELECT * FROM canonical", "canonical_latitude canonical_longitude")

_KEYS = ["timestamp", "deployment_fk", "metric_name"]
_ONE = f"""(SELECT timestamp, deployment_fk, metric_name, arg_max(value, event_id) AS value FROM {COPIES} WHERE value IS NOT NULL GROUP BY 1, 2, 3)"""


def _facts(d):
    return rollups.dedupe_last(_copies(d), _KEYS, "event_id").drop("event_id")


def _merge(d, policy):
    """Existing facts are those before the 20th; the merge brings all from the 10th on, ten higher, with copies."""
    path = scratch_path(d.spark, "star")
    t.merge_into(d.spark, path, _facts(d).filter("timestamp < timestamp'2024-01-20'"), _KEYS)
    new = _copies(d).filter("timestamp >= timestamp'2024-01-10'").withColumn("value", F.col("value") + 10)
    t.merge_into(d.spark, path, new, _KEYS, seq="event_id", policy=policy)
    return d.spark.read.parquet(path).select(*_KEYS, "value")


add("k05_upsert", lambda d: _merge(d, "replace"),
    f"SELECT timestamp, deployment_fk, metric_name, CASE WHEN timestamp >= '2024-01-10' THEN value + 10 ELSE value END AS value FROM {_ONE}", "value")
add("k05_upsert_keep", lambda d: _merge(d, "keep"),
    f"SELECT timestamp, deployment_fk, metric_name, CASE WHEN timestamp >= '2024-01-20' THEN value + 10 ELSE value END AS value FROM {_ONE}", "value")


def _changed(d):
    """Only changed rows take the new stamp."""
    old = _facts(d).withColumn("stamp", F.lit("old"))
    new = old.withColumns({"value": F.when(F.hour("timestamp") % 2 == 0, F.col("value") + 1).otherwise(F.col("value")), "stamp": F.lit("new")})
    return t.upsert(old, new, _KEYS, only_if_changed=True)


add("k05_upsert_only_if_changed", _changed,
    f"""SELECT timestamp, deployment_fk, metric_name, CASE WHEN hour(timestamp) % 2 = 0 THEN value + 1 ELSE value END AS value,
        CASE WHEN hour(timestamp) % 2 = 0 THEN 'new' ELSE 'old' END AS stamp FROM {_ONE}""", "value")


def _append_absent(d):
    path = scratch_path(d.spark, "star")
    t.append_absent(d.spark, path, _facts(d).filter("timestamp < timestamp'2024-01-20'"), _KEYS)
    t.append_absent(d.spark, path, _facts(d).filter("timestamp >= timestamp'2024-01-10'").withColumn("value", F.col("value") + 10), _KEYS)
    return d.spark.read.parquet(path).select(*_KEYS, "value")


add("k06_insert_absent", _append_absent,
    f"SELECT timestamp, deployment_fk, metric_name, CASE WHEN timestamp >= '2024-01-20' THEN value + 10 ELSE value END AS value FROM {_ONE}", "value")

_MOVES = """(SELECT 'KNCDURHA' || (s_suppkey * 2) AS native_sensor_id, 35.5::DOUBLE + s_suppkey*0.001::DOUBLE AS latitude, -78.0::DOUBLE AS longitude,
    'moved' AS notes FROM supplier)"""


def _moves(d):
    return d.table("supplier").selectExpr("concat('KNCDURHA', s_suppkey * 2) AS native_sensor_id", "35.5D + s_suppkey*0.001D AS latitude",
                                          "-78.0D AS longitude", "'moved' AS notes")


add("k07_upsert_location", lambda d: locations.upsert_location(d.curated(), _moves(d), NOW).drop("geog"),
    f"""SELECT coalesce(c.native_sensor_id, u.native_sensor_id) AS native_sensor_id, CASE WHEN u.notes IS NOT NULL THEN u.latitude ELSE c.latitude END AS latitude,
        CASE WHEN u.notes IS NOT NULL THEN u.longitude ELSE c.longitude END AS longitude,
        CASE WHEN u.notes IS NOT NULL THEN coalesce(c.status, 'active') ELSE c.status END AS status,
        CASE WHEN u.notes IS NOT NULL THEN coalesce(c.effective_date, date '2024-01-31') ELSE c.effective_date END AS effective_date,
        coalesce(u.notes, c.notes) AS notes, CASE WHEN u.notes IS NOT NULL THEN timestamp '2024-01-31' ELSE c.updated_at END AS updated_at
        FROM curated c FULL JOIN {_MOVES} u ON c.native_sensor_id = u.native_sensor_id""", "latitude longitude")
for _parity in (False, True):
    _revive = "s.native_sensor_id IS NOT NULL" + ("" if _parity else " AND c.status IS NULL")
    add("k08_upsert_status" + ("_parity" if _parity else ""),
        lambda d, p=_parity: locations.upsert_status(d.curated(), d.daily(), NOW, p).drop("geog"),
        f"""SELECT coalesce(c.native_sensor_id, s.native_sensor_id) AS native_sensor_id,
            CASE WHEN c.latitude IS NOT NULL THEN c.latitude ELSE s.latitude END AS latitude,
            CASE WHEN c.latitude IS NOT NULL THEN c.longitude ELSE s.longitude END AS longitude,
            CASE WHEN {_revive} THEN 'active' ELSE c.status END AS status,
            CASE WHEN {_revive} THEN date '2024-01-31' ELSE c.effective_date END AS effective_date,
            CASE WHEN s.native_sensor_id IS NOT NULL THEN 'Auto-populated from sensor_readings_daily' ELSE c.notes END AS notes,
            CASE WHEN s.native_sensor_id IS NOT NULL THEN timestamp '2024-01-31' ELSE c.updated_at END AS updated_at
            FROM curated c FULL JOIN (SELECT native_sensor_id, latitude, longitude FROM (SELECT *, row_number() OVER (PARTITION BY native_sensor_id
            ORDER BY day_ts, latitude, longitude) AS rn FROM daily) WHERE rn = 1) s ON c.native_sensor_id = s.native_sensor_id""", "latitude longitude")
add("k09_seed_locations",
    lambda d: locations.seed_missing(d.curated(), locations.location_candidates(d.canonical()), "native_sensor_id", NOW).drop("geog"),
    """SELECT * FROM curated UNION ALL SELECT native_sensor_id, canonical_latitude, canonical_longitude, NULL, NULL, 'seeded from canonical',
       timestamp '2024-01-31' FROM canonical WHERE native_sensor_id NOT IN (SELECT native_sensor_id FROM curated)""", "latitude longitude")
add("k09_seed_id_map",
    lambda d: locations.seed_missing(d.id_map().filter("native_sensor_id LIKE '%1'"), locations.identity_candidates(d.long(), d.daily()),
                                     "native_sensor_id", NOW),
    """SELECT * FROM id_map WHERE native_sensor_id LIKE '%1' UNION ALL SELECT DISTINCT native_sensor_id, native_sensor_id, NULL::DATE, NULL::DATE,
       'seed:identity', timestamp '2024-01-31' FROM long WHERE native_sensor_id NOT IN (SELECT native_sensor_id FROM id_map WHERE native_sensor_id LIKE '%1')""")


def _stage(d, drop=None):
    path = scratch_path(d.spark, "staging")
    facts = _facts(d)
    t.write_staging(facts.withColumn("value", F.lit(-1.0)).filter("timestamp < timestamp'2024-01-10'"), path, "TSI")
    t.write_staging(facts.filter("metric_name = 'pm25'"), path, "TSI")
    t.write_staging(facts.filter("metric_name <> 'pm25'"), path, "WU")
    if drop:
        t.drop_staging_day(d.spark, path, drop)
    return path


_STAGED = f"(SELECT *, CASE WHEN metric_name = 'pm25' THEN 'tsi' ELSE 'wu' END AS source, CAST(timestamp AS DATE) AS dt FROM {_ONE})"
add("k10_write_staging", lambda d: landing.scan_staging(d.spark, _stage(d)), f"SELECT * FROM {_STAGED}", "value")
add("k11_drop_staging_day", lambda d: landing.scan_staging(d.spark, _stage(d, "2024-01-10")), f"SELECT * FROM {_STAGED} WHERE dt <> date '2024-01-10'", "value")


def _logged(d):
    path = scratch_path(d.spark, "metrics")
    frames = {"WU": d.wu().withColumnRenamed("ts", "timestamp"), "TSI": d.tsi().withColumnRenamed("ts", "timestamp")}
    for since in ("2024-01-10", "2024-01-24"):
        run = rollups.freshness_counts(frames, since).withColumn("meta", F.struct(F.lit(since).alias("since")))
        t.append_run_log(run, path)
    return d.spark.read.parquet(path)


add("k12_append_run_log", _logged, " UNION ALL ".join(
    f"""SELECT '{s}' AS source, max(ts) AS latest_ts, count(*)::BIGINT AS row_count, '{{"since":"{day}"}}' AS meta FROM {s.lower()}
        WHERE ts >= timestamp '{day}'""" for day in ("2024-01-10", "2024-01-24") for s in ("WU", "TSI")))


def _canonical_rewrite(d):
    src, dst = scratch_path(d.spark, "raw"), scratch_path(d.spark, "fixed")
    d.history().selectExpr("native_sensor_id", "timestamp", "CAST(pm25 AS STRING) AS pm2_5", "CAST(NULL AS STRING) AS co2_ppm", "event_id").write.parquet(src)
    t.rewrite_canonical(d.spark, src, dst, vocab.TSI_WIDE_SCHEMA)
    return d.spark.read.parquet(dst).select("native_sensor_id", "timestamp", "pm2_5", "co2_ppm", "humidity")


add("k13_rewrite_canonical", _canonical_rewrite,
    "SELECT native_sensor_id, timestamp, pm25 AS pm2_5, NULL::DOUBLE AS co2_ppm, NULL::DOUBLE AS humidity FROM history", "pm2_5 co2_ppm humidity")
add("k14_ensure_columns", lambda d: normalize.ensure_columns(d.id_map(), "status string, effective_date date, source string"),
    "SELECT *, NULL::VARCHAR AS status, NULL::DATE AS effective_date FROM id_map")


def _laid_out(d):
    path = scratch_path(d.spark, "long")
    t.layout(d.long().withColumn("dt", F.to_date("timestamp")).drop("geog")).write.partitionBy("dt").parquet(path)
    return d.spark.read.parquet(path)


add("k15_layout", _laid_out, "SELECT *, CAST(timestamp AS DATE) AS dt FROM long", "value latitude longitude")


def _viewed(d):
    """Rows and sensors of each of the ten views, which stand on written tables, as the daily run leaves them."""
    daily, canonical = saved(d.daily(), "daily"), saved(d.canonical(), "canonical")
    frames = views.serving_views(d.long(), daily, d.id_map(), canonical, d.curated())
    sensor = lambda name: "sensor_source" if name == "sensor_source_summary" else "native_sensor_id"
    return d.spark.sql(" UNION ALL ".join(f"SELECT '{name}' AS view, count(*) AS n, count(DISTINCT {sensor(name)}) AS ids FROM {name}"
                                          for name in t.register_views(d.spark, frames)))


_VIEWS = {"sensor_canonical_latest": "canonical", "sensor_location_current": "current_loc", "sensor_readings_daily_enriched": "enriched",
          "sensor_readings_long_enriched": """(SELECT l.native_sensor_id FROM long l LEFT JOIN id_map m ON l.native_sensor_id = m.native_sensor_id
              AND (m.effective_start_date IS NULL OR CAST(l.timestamp AS DATE) >= m.effective_start_date)
              AND (m.effective_end_date IS NULL OR CAST(l.timestamp AS DATE) <= m.effective_end_date))""",
          "tsi_sensor_list": "tsi_list", "wu_sensor_list": "wu_list", "tsi_daily_enriched": "(SELECT * FROM all_enriched WHERE sensor_source = 'TSI')",
          "wu_daily_enriched": "(SELECT * FROM all_enriched WHERE sensor_source = 'WU')", "all_sensors_daily_enriched": "all_enriched",
          "sensor_source_summary": "(SELECT DISTINCT sensor_source AS native_sensor_id FROM all_enriched)"}
add("k16_register_views", _viewed,
    " UNION ALL ".join(f"SELECT '{v}' AS view, count(*)::BIGINT AS n, count(DISTINCT native_sensor_id)::BIGINT AS ids FROM {q}" for v, q in _VIEWS.items()))


def _reported(d):
    path = scratch_path(d.spark, "alerts")
    rows = d.history().select("event_id", F.col("timestamp").cast("timestamp").alias("timestamp"), "pm25")
    t.write_report(rows.filter("event_id % 2 = 0"), path, keep_last=1000, ties=["event_id"])
    t.write_report(rows.filter("event_id % 2 = 1"), path, keep_last=1000, ties=["event_id"])
    return d.spark.read.schema(rows.schema).json(path).select("event_id", "pm25")


add("k17_write_report", _reported,
    """SELECT event_id, pm25 FROM (SELECT * FROM (SELECT * FROM history WHERE event_id % 2 = 0 ORDER BY timestamp DESC, event_id DESC LIMIT 1000)
       UNION ALL SELECT * FROM history WHERE event_id % 2 = 1) ORDER BY timestamp DESC, event_id DESC LIMIT 1000""", "pm25")


def _current(d):
    """Alerts by id, written twice: an id that comes again takes its new row."""
    path = scratch_path(d.spark, "current")
    rows = d.history().selectExpr("concat('a', event_id % 500) AS id", "CAST(timestamp AS TIMESTAMP) AS timestamp", "event_id", "pm25")
    t.write_current(rows.filter("event_id % 3 = 0"), path, ties=["event_id"])
    t.write_current(rows.filter("event_id % 3 = 1"), path, ties=["event_id"])
    return d.spark.read.schema(rows.schema).json(path).select("id", "event_id", "pm25")


add("k17_current_alerts", _current,
    """SELECT id, event_id, pm25 FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id % 3 DESC, timestamp DESC, event_id DESC) AS rn
       FROM (SELECT 'a' || (event_id % 500) AS id, * FROM history WHERE event_id % 3 < 2)) WHERE rn = 1""", "pm25")


# --- backfill ---
FIRST_DAY = "2024-01-01"


def _backfilled(d, table, schema, start=FIRST_DAY, end=PROC_DATE):
    warehouse = scratch_path(d.spark, "warehouse")
    daily_plan.backfill(d.spark, landed(d), warehouse, start, end)
    return d.spark.read.schema(schema).parquet(f"{warehouse}/{table}").drop("geog", "dt")


add("b01_backfill_hourly", lambda d: _backfilled(d, "sensor_readings_hourly", daily_plan.HOURLY_SCHEMA),
    "SELECT * FROM hourly", _STATS)
add("b01_backfill_daily", lambda d: _backfilled(d, "sensor_readings_daily", daily_plan.DAILY_SCHEMA),
    "SELECT * FROM daily", _STATS)


def _materialized(d):
    """One source's days are missing from the first tree and come from the second."""
    full, part, warehouse = landed(d), scratch_path(d.spark, "landing"), scratch_path(d.spark, "warehouse")
    rows = d.tsi().withColumnRenamed("ts", "timestamp").filter("to_date(timestamp) <> date'2024-01-25'")
    t.write_landing(rows, part, "TSI")
    daily_plan.materialize_range(d.spark, part, warehouse, FIRST_DAY, PROC_DATE, ["TSI"], fallback_root=full)
    return d.spark.read.parquet(daily_plan.raw_path(warehouse, "TSI")).select("ts", "native_sensor_id", *TSI_FED)


add("b02_materialize_range", _materialized,
    f"SELECT ts, native_sensor_id, {', '.join(TSI_FED)} FROM tsi", " ".join(TSI_FED))


def _merged_range(d):
    """All days staged twice under either source: the second load, with lower values and copies within it, is the one that counts."""
    path, staging = scratch_path(d.spark, "star"), scratch_path(d.spark, "staging")
    t.merge_into(d.spark, path, _facts(d).withColumn("value", F.lit(1e9)), _KEYS)
    t.write_staging(_facts(d).withColumn("value", F.lit(1e6)), staging, "TSI")
    t.write_staging(_copies(d), staging, "WU", seq="event_id")
    daily_plan.merge_range(d.spark, path, staging, FIRST_DAY, PROC_DATE)
    return d.spark.read.parquet(path).select(*_KEYS, "value")


add("b03_merge_range", _merged_range, f"SELECT timestamp, deployment_fk, metric_name, value FROM {_ONE}", "value")


def _misfiled(d):
    """Rows filed under other days than their own, some without a time: the others go to their day, these are kept apart."""
    root, warehouse = scratch_path(d.spark, "landing"), scratch_path(d.spark, "warehouse")
    rows = d.tsi().withColumnRenamed("ts", "timestamp").withColumns(
        {"source": F.lit("TSI"), "agg": F.lit("raw"), "dt": F.when(F.hour("timestamp") < 6, F.date_add(F.to_date("timestamp"), -1)).otherwise(F.to_date("timestamp"))})
    rows = rows.withColumn("timestamp", F.when(F.minute("timestamp") != 7, F.col("timestamp")))
    rows.write.partitionBy("source", "agg", "dt").parquet(root)
    daily_plan.materialize_range(d.spark, root, warehouse, "2023-12-31", PROC_DATE, ["TSI"])
    kept = d.spark.read.parquet(daily_plan.raw_path(warehouse, "TSI")).withColumn("kind", F.lit("kept"))
    left = d.spark.read.parquet(daily_plan.rejected_path(warehouse, "TSI")).withColumn("kind", F.lit("rejected"))
    return kept.unionByName(left).select("ts", "native_sensor_id", "kind", F.col("dt").cast("date").alias("dt"), *TSI_FED)


add("b02_rows_of_other_days", _misfiled,
    f"""SELECT CASE WHEN minute(ts) <> 7 THEN ts END AS ts, native_sensor_id, CASE WHEN minute(ts) <> 7 THEN 'kept' ELSE 'rejected' END AS kind,
        CAST(CASE WHEN minute(ts) <> 7 THEN ts WHEN hour(ts) < 6 THEN ts - interval 1 day ELSE ts END AS DATE) AS dt, {', '.join(TSI_FED)} FROM tsi""", " ".join(TSI_FED))


# --- ingest and analysis ---
def _ingested(d):
    """Telemetry files taken in for all days, then read back from staging."""
    from aeroloom.plans import ingest
    from aeroloom.sources import payloads
    from verification.checks_source import _tsi_files

    root, staging, log = (scratch_path(d.spark, n) for n in ("landing", "staging", "log"))
    ingest.ingest({"TSI": payloads.read_tsi_json(d.spark, _tsi_files(d))}, root, staging, log, FIRST_DAY, PROC_DATE)
    logged = d.spark.read.parquet(log).select("row_count")
    return landing.scan_staging(d.spark, staging).select("timestamp", "deployment_fk", "metric_name", "value", "source").withColumn("row_count", logged.scalar())


add("b04_ingest", _ingested,
    "SELECT timestamp, native_sensor_id AS deployment_fk, metric_name, value, 'tsi' AS source, (SELECT count(*)::BIGINT FROM "
    "(SELECT * FROM sparse WHERE event_id % 13 <> 0 AND CAST(timestamp AS DATE) BETWEEN date '2024-01-01' AND date '2024-01-30')) AS row_count FROM ("
    + " UNION ALL ".join(f"SELECT timestamp, native_sensor_id, '{name}' AS metric_name, {col} AS value FROM sparse WHERE event_id % 13 <> 0 AND {col} IS NOT NULL"
                         for name, col in (("pm2_5", "pm25"), ("temperature", "temperature"), ("humidity", "humidity")))
    + ") WHERE CAST(timestamp AS DATE) BETWEEN date '2024-01-01' AND date '2024-01-30'", "value")


def _ingested_by_hour(d):
    """The same files landed and staged as hourly means, with the run's log."""
    from aeroloom.plans import ingest
    from aeroloom.sources import payloads
    from verification.checks_source import _tsi_files

    root, staging, log = (scratch_path(d.spark, n) for n in ("landing", "staging", "log"))
    ingest.ingest({"TSI": payloads.read_tsi_json(d.spark, _tsi_files(d))}, root, staging, log, FIRST_DAY, PROC_DATE, interval="h")
    run = d.spark.read.parquet(log).filter("length(run_id) = 32 AND run_finished >= run_started AND status = 'success'").first()
    rows = landing.scan_staging(d.spark, staging).select("timestamp", "deployment_fk", "metric_name", "value")
    return rows.withColumns({"row_count": F.lit(run["row_count"]), "agg_interval": F.lit(run["agg_interval"]), "written": F.lit(run["written"])})


_HOURS = "(SELECT date_trunc('hour', timestamp)::TIMESTAMP AS timestamp, native_sensor_id, avg(pm25) AS pm25, avg(temperature) AS temperature, avg(humidity) AS humidity FROM sparse WHERE event_id % 13 <> 0 GROUP BY 1, 2)"
add("b04_ingest_by_hour", _ingested_by_hour,
    f"SELECT *, (SELECT sum(n)::BIGINT FROM (SELECT date_diff('hour', min(timestamp), max(timestamp)) + 1 AS n FROM {_HOURS} GROUP BY native_sensor_id)) AS row_count, 'h' AS agg_interval, true AS written FROM ("
    + " UNION ALL ".join(f"SELECT timestamp, native_sensor_id AS deployment_fk, '{name}' AS metric_name, {col} AS value FROM {_HOURS} WHERE {col} IS NOT NULL"
                         for name, col in (("pm2_5", "pm25"), ("temperature", "temperature"), ("humidity", "humidity"))) + ")", "value")


def _analysed(d):
    from aeroloom.plans import analysis

    out = analysis.analyse(d.history(), 6, ["linear_regression"], ties=["event_id"])
    return out["seasonal"].filter("kind = 'month'").select("period", "mean", "min", "max", "count").withColumns(
        {c: out["metrics"].select(c).scalar() for c in ("model", "best")})


add("b05_analysis", _analysed,
    """SELECT CAST(month(day) AS VARCHAR) AS period, avg(v) AS mean, min(v) AS min, max(v) AS max, count(*)::BIGINT AS count, 'linear_regression' AS model, true AS best
       FROM (SELECT CAST(timestamp AS DATE) AS day, avg(pm25) AS v FROM history WHERE pm25 BETWEEN 0 AND 1000 AND temperature BETWEEN -50 AND 60
       AND humidity BETWEEN 0 AND 100 GROUP BY 1) GROUP BY 1""", "mean min max")
