"""Checks of rollups, unions, reports and streams (A…, U1, O3, ST…, X4, Q…)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import SCOPES, SETTINGS, base, facts, flat, lines, with_base, with_facts, with_lines
from checks.intake import RECONCILED_SQL, _line_files, _reconciled, _two_sides
from checks.registry import check
from mapmeter.functions import relative, times
from mapmeter.operators import ingest, layers, maintenance
from mapmeter.operators.text import parse_text_logs
from mapmeter.plans import reports, rollups, summaries
from mapmeter.schemas import ACCESS_LOG_SCHEMA, OTEL_SCHEMA
from mapmeter.session import fresh_path, state_on_disk
from mapmeter.sources import logs, tables
from mapmeter.streaming import jobs

TZ = "Europe/Paris"
# January only: one hour ahead of UTC
PARIS = {
    "hour": "date_trunc('hour', {})",
    "day": "date_trunc('day', {} + INTERVAL 1 HOUR) - INTERVAL 1 HOUR",
    "month": "date_trunc('month', {} + INTERVAL 1 HOUR) - INTERVAL 1 HOUR",
}
_COLS = ", ".join(rollups.OGC_COLUMNS)
_FLAGS = ("tiled", "is_download", "full_download")


def _dims(spec_columns, details):
    return ", ".join(
        [*spec_columns, *[f"CAST({d} AS VARCHAR) AS {d}" if d in _FLAGS else d for d in details]]
    )


_OGC_DIMS = _dims(rollups.OGC_COLUMNS, rollups.OGC_DETAILS)
_OGC_KEYS = ", ".join(rollups.OGC_COLUMNS + rollups.OGC_DETAILS)
_API_DIMS = _dims(rollups.DATAAPI_COLUMNS, rollups.DATAAPI_DETAILS)
_API_KEYS = ", ".join(rollups.DATAAPI_COLUMNS + rollups.DATAAPI_DETAILS)


def ogc_ctes(where: str = "TRUE") -> str:
    measures = "min(response_time_min) AS response_time_min, max(response_time_max) AS response_time_max"
    up = "CAST(sum(nb_req) AS BIGINT) AS nb_req, quantile_cont(response_time_median, 0.5) AS response_time_median, " + measures
    return (
        f", f AS (SELECT {PARIS['hour'].format('ts')} AS bucket, {_OGC_DIMS}, id, CAST(response_time AS DOUBLE) AS rt FROM facts WHERE app_name <> 'dataapi' AND {where}),"
        f" hour AS (SELECT bucket, {_OGC_KEYS}, count(id) AS nb_req, quantile_cont(rt, 0.5) AS response_time_median, min(rt) AS response_time_min, max(rt) AS response_time_max FROM f GROUP BY ALL),"
        f" day AS (SELECT {PARIS['day'].format('bucket')} AS bucket, {_OGC_KEYS}, {up} FROM hour GROUP BY 1, {_OGC_KEYS}),"
        f" month AS (SELECT {PARIS['month'].format('bucket')} AS bucket, {_OGC_KEYS}, {up} FROM day GROUP BY 1, {_OGC_KEYS})"
    )


def api_ctes() -> str:
    up = "CAST(sum(nb_req) AS BIGINT) AS nb_req, sum(rt_sum) / nullif(sum(rt_cnt), 0) AS avg_time, sum(rt_sum) AS rt_sum, CAST(sum(rt_cnt) AS BIGINT) AS rt_cnt"
    return (
        f", f AS (SELECT {PARIS['hour'].format('ts')} AS bucket, {_API_DIMS}, id, CAST(response_time AS DOUBLE) AS rt FROM facts WHERE app_name = 'dataapi'),"
        f" hour AS (SELECT bucket, {_API_KEYS}, count(id) AS nb_req, avg(rt) AS avg_time, sum(rt) AS rt_sum, count(rt) AS rt_cnt FROM f GROUP BY ALL),"
        f" day AS (SELECT {PARIS['day'].format('bucket')} AS bucket, {_API_KEYS}, {up} FROM hour GROUP BY 1, {_API_KEYS}),"
        f" month AS (SELECT {PARIS['month'].format('bucket')} AS bucket, {_API_KEYS}, {up} FROM day GROUP BY 1, {_API_KEYS})"
    )


def _ogc(spark, sf):
    return rollups.all_levels(facts(spark, sf), rollups.ogc_spec(TZ))


def _api(spark, sf):
    levels = rollups.all_levels(facts(spark, sf), rollups.dataapi_spec(TZ))
    return {grain: df.drop("sketch") for grain, df in levels.items()}


@check(
    "ogc_hourly_from_lines",
    with_lines(
        ", f AS (SELECT date_trunc('hour', ts) AS bucket, app_name, CASE WHEN k % 13 > 0 THEN org_name END AS org_name, status_code, service, request, layers, workspaces,"
        " CAST(tiled AS VARCHAR) AS tiled, CAST(is_download AS VARCHAR) AS is_download, user_agent_family, CAST(CASE WHEN response_time > 0 THEN response_time END AS DOUBLE) AS rt FROM lines WHERE app_name <> 'dataapi')"
        " SELECT bucket, app_name, org_name, status_code, service, request, layers, workspaces, tiled, is_download, user_agent_family, count(*) AS nb_req,"
        " quantile_cont(rt, 0.5) AS response_time_median, min(rt) AS response_time_min, max(rt) AS response_time_max FROM f GROUP BY ALL"
    ),
)
def ogc_hourly_from_lines(spark, sf):
    parsed = parse_text_logs(lines(spark, sf).select(F.col("line").alias("value")), SETTINGS)
    spec = rollups.RollupSpec(
        "ogc_by_org", ("app_name", "org_name", "status_code"),
        ("service", "request", "layers", "workspaces", "tiled", "is_download", "user_agent_family"),
        "median", TZ, rollups.ogc_spec().where,
    )
    return rollups.facts_rollup(parsed, spec)


@check("ogc_hourly_a1", with_facts(ogc_ctes() + " SELECT * FROM hour"))
def ogc_hourly(spark, sf):
    return _ogc(spark, sf)["hour"]


@check("ogc_daily_a2", with_facts(ogc_ctes() + " SELECT * FROM day"))
def ogc_daily(spark, sf):
    return _ogc(spark, sf)["day"]


@check("ogc_monthly_a3", with_facts(ogc_ctes() + " SELECT * FROM month"))
def ogc_monthly(spark, sf):
    return _ogc(spark, sf)["month"]


@check("dataapi_hourly_a4", with_facts(api_ctes() + " SELECT * FROM hour"))
def dataapi_hourly(spark, sf):
    return _api(spark, sf)["hour"]


@check("dataapi_daily_a5", with_facts(api_ctes() + " SELECT * FROM day"))
def dataapi_daily(spark, sf):
    return _api(spark, sf)["day"]


@check("dataapi_monthly_a6", with_facts(api_ctes() + " SELECT * FROM month"))
def dataapi_monthly(spark, sf):
    return _api(spark, sf)["month"]


@check("exact_median_a7", with_facts("SELECT app_name, date_trunc('day', ts) AS day, quantile_cont(response_time, 0.5) AS median FROM facts GROUP BY ALL"))
def exact_median(spark, sf):
    df = flat(spark, sf).withColumn("day", F.date_trunc("day", "ts"))
    return rollups.exact_medians(df, ["app_name", "day"], "response_time")


@check(
    "percentile_state_a8",
    with_facts(", q AS (SELECT app_name, quantile_cont(response_time, 0.45) AS lo, quantile_cont(response_time, 0.55) AS hi, avg(response_time) AS mean FROM facts GROUP BY 1)"
               " SELECT app_name, TRUE AS near_median, mean FROM q"),
)
def percentile_state(spark, sf):
    """Sketches built by day, merged by application; the estimated median lies between the exact 45 %
    and 55 % quantiles."""
    from mapmeter.functions.quantiles import build_state, merge_state, state_mean, state_quantile

    df = flat(spark, sf).withColumn("day", F.date_trunc("day", "ts"))
    days = df.groupBy("app_name", "day").agg(*build_state(F.col("response_time")))
    merged = days.groupBy("app_name").agg(*merge_state()).select(
        "app_name", state_quantile(0.5).alias("q"), state_mean().alias("mean")
    )
    bounds = df.groupBy("app_name").agg(
        F.percentile("response_time", 0.45).alias("lo"), F.percentile("response_time", 0.55).alias("hi")
    )
    return merged.join(bounds, "app_name").select("app_name", F.col("q").between(F.col("lo"), F.col("hi")).alias("near_median"), "mean")


@check(
    "ogc_daily_legacy_a9",
    with_facts("SELECT date_trunc('day', ts) AS bucket, service AS ogc_service, layers AS ogc_layer, request AS ogc_request, count(*) AS nb_req FROM facts WHERE app_name = 'geoserver' GROUP BY ALL"),
)
def ogc_daily_legacy(spark, sf):
    return reports.ogc_daily_legacy(facts(spark, sf))


@check("requests_by_service_a10", with_facts("SELECT service, request, layers, count(app_path) AS nb_requests FROM facts WHERE app_name = 'geoserver' GROUP BY ALL"))
def requests_by_service(spark, sf):
    return reports.requests_by_service(facts(spark, sf))


@check(
    "layer_usage_a11",
    with_facts(", l AS (SELECT id, response_time, user_name, org_name, request_method, status_code, unnest(string_split(layers, ',')) AS layer, service, request, tiled FROM facts WHERE app_name = 'geoserver')"
               " SELECT user_name, org_name, request_method, status_code, layer, service, request, tiled, count(id) AS nb_req, avg(response_time) AS avg_time FROM l GROUP BY ALL"),
)
def layer_usage(spark, sf):
    return layers.layer_usage(maintenance.filter_app(facts(spark, sf), "geoserver"))


def _app_summary_sql(unit: str) -> str:
    return with_facts(
        f"SELECT date_trunc('{unit}', ts) AS bucket, user_name, org_name, request_method, status_code, layers, service, request, tiled, is_download, download_format,"
        " count(id) AS nb_req, avg(response_time) AS avg_time FROM facts GROUP BY ALL"
    )


@check("app_summary_hourly_a12", _app_summary_sql("hour"))
def app_summary_hourly(spark, sf):
    return reports.app_summary(facts(spark, sf), "hour", sketch=True).drop("sketch", "rt_sum", "rt_cnt")


@check("app_summary_daily_a12", _app_summary_sql("day"))
def app_summary_daily(spark, sf):
    return reports.app_summary(facts(spark, sf), "day")


@check("find_duplicates_a13", with_facts("SELECT ts, id, 2 AS nb FROM facts WHERE event_id % 10 = 0"))
def find_duplicates(spark, sf):
    df = facts(spark, sf, "event_id")
    return ingest.find_duplicates(df.unionByName(df.filter("event_id % 10 = 0")))


@check("lines_per_app_a14", with_base("SELECT CASE k % 4 WHEN 0 THEN 'geoserver' WHEN 1 THEN 'geowebcache' ELSE 'cadastrapp' END AS app, count(*) AS nb_lines FROM base WHERE k % 4 < 3 GROUP BY 1"))
def lines_per_app(spark, sf):
    from checks.intake import _RAW

    return maintenance.lines_per_app(base(spark, sf).select(F.expr(_RAW).alias("value")))


# two days whose facts are purged in between
_PURGED = "NOT (ts >= TIMESTAMP '2024-01-23 23:00:00' AND ts < TIMESTAMP '2024-01-25 23:00:00')"


_GAMMA = "(1.005 / 0.995)"


def _quantiles_sql(grain):
    """The quantiles of the facts' own bucket middles, and the exact ones, which they must be close to."""
    middle = f"2 * pow({_GAMMA}, ceil(ln(rt) / ln({_GAMMA}))) / ({_GAMMA} + 1)"
    parts = ", ".join(
        f"round(quantile_cont(e, {q}), 6) AS p{name}, abs(quantile_cont(e, {q}) - quantile_cont(rt, {q})) <= 0.01 * quantile_cont(rt, {q}) AS p{name}_close" for name, q in _QUANTILES.items()
    )
    return with_facts(
        f", f AS (SELECT {PARIS[grain].format('ts')} AS bucket, {_API_DIMS}, id, CAST(response_time AS DOUBLE) AS rt FROM facts WHERE app_name = 'dataapi'),"
        f" g AS (SELECT *, CASE WHEN rt > 0 THEN {middle} WHEN rt <= 0 THEN 0 END AS e FROM f)"
        f" SELECT bucket, {_API_KEYS}, count(id) AS nb_req, sum(rt) AS rt_sum, {parts} FROM g GROUP BY bucket, {_API_KEYS}"
    )


_QUANTILES = {"50": 0.5, "95": 0.95, "99": 0.99}


def _quantiles(spark, sf, grain):
    """A level made of the finer ones, with its quantiles, held against the exact ones of the facts."""
    spec, df = rollups.dataapi_quantiles_spec(TZ), facts(spark, sf)
    level = rollups.all_levels(df, spec)[grain]
    keys = ["bucket", *spec.dims]
    rows = df.filter(spec.where).select(
        times.bucket(grain, F.col("ts"), TZ).alias("bucket"), *spec.columns, *[F.col(f"request_details.{d}").cast("string").alias(d) for d in spec.details], "response_time"
    )
    exact = rows.groupBy(*keys).agg(*[F.percentile("response_time", F.lit(q)).alias(f"exact{n}") for n, q in _QUANTILES.items()])
    near = level.join(exact, [level[k].eqNullSafe(exact[k]) for k in keys]).select(level["*"], *[f"exact{n}" for n in _QUANTILES])
    found = near.select(*keys, "nb_req", "rt_sum", *[relative.quantile(q).alias(f"q{n}") for n, q in _QUANTILES.items()], *[f"exact{n}" for n in _QUANTILES])
    return found.select(
        *keys, "nb_req", "rt_sum", *[F.round(f"q{n}", 6).alias(f"p{n}") for n in _QUANTILES],
        *[(F.abs(F.col(f"q{n}") - F.col(f"exact{n}")) <= 0.01 * F.col(f"exact{n}")).alias(f"p{n}_close") for n in _QUANTILES],
    )


@check("dataapi_hourly_quantiles_a4", _quantiles_sql("hour"))
def dataapi_hourly_quantiles(spark, sf):
    return _quantiles(spark, sf, "hour")


@check("dataapi_daily_quantiles_a5", _quantiles_sql("day"))
def dataapi_daily_quantiles(spark, sf):
    return _quantiles(spark, sf, "day")


@check("dataapi_monthly_quantiles_a6", _quantiles_sql("month"))
def dataapi_monthly_quantiles(spark, sf):
    return _quantiles(spark, sf, "month")


def _true_median_sql(grain):
    return with_facts(
        f", f AS (SELECT {PARIS[grain].format('ts')} AS bucket, {_OGC_DIMS}, id, CAST(response_time AS DOUBLE) AS rt FROM facts WHERE app_name <> 'dataapi')"
        f" SELECT bucket, {_OGC_KEYS}, count(id) AS nb_req, quantile_cont(rt, 0.5) AS response_time_median, min(rt) AS response_time_min, max(rt) AS response_time_max FROM f GROUP BY bucket, {_OGC_KEYS}"
    )


def _true_medians(spark, sf, grain):
    """From stored hourly counts of response times up to the level; the facts are read for the hours only."""
    spec, path = rollups.ogc_spec(TZ), fresh_path(spark, "times")
    rollups.distinct_times(facts(spark, sf), spec).write.parquet(path)
    level = spark.read.parquet(path)
    for finer in rollups.GRAINS[1 : rollups.GRAINS.index(grain) + 1]:
        level = rollups.merge_times(level, spec, finer)
    return rollups.true_medians(level, spec)


@check("true_median_daily_a2", _true_median_sql("day"))
def true_median_daily(spark, sf):
    return _true_medians(spark, sf, "day")


@check("true_median_monthly_a3", _true_median_sql("month"))
def true_median_monthly(spark, sf):
    return _true_medians(spark, sf, "month")


@check(
    "refresh_rollup_a15",
    with_facts(ogc_ctes().replace("FROM facts", f"FROM (SELECT * FROM facts WHERE {_PURGED})", 1)
               + " SELECT 'hour' AS level, * FROM hour UNION ALL SELECT 'day', * FROM day UNION ALL SELECT 'month', * FROM month"),
)
def refresh_rollup(spark, sf):
    """Backfill without the late rows and with days purged since, then an incremental refresh, which must equal a
    full recompute in all keys and measures."""
    spec, folder = rollups.ogc_spec(TZ), fresh_path(spark, "rollups")
    df = facts(spark, sf)
    late = (F.col("ts") >= F.lit("2024-01-20 07:00:00").cast("timestamp")) & F.col("id").endswith("3")
    rollups.refresh_levels(spark, df.filter(~late), folder, spec, "2023-12-01 00:00:00", "2024-03-01 00:00:00")
    rollups.refresh_levels(spark, df.filter(_PURGED), folder, spec, "2024-01-20 07:00:00", "2024-02-03 11:00:00")
    parts = [level.select(F.lit(grain).alias("level"), "*") for grain, level in rollups.stored_levels(spark, folder, spec).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check(
    "refresh_changed_a15",
    with_facts(ogc_ctes()
               + ", late AS (SELECT DISTINCT ts + INTERVAL 1 HOUR AS local FROM facts WHERE id LIKE '%77'),"
               " n AS (SELECT count(DISTINCT CAST(local AS DATE)) AS days, count(DISTINCT date_trunc('month', local)) AS months FROM late)"
               " SELECT 'hour' AS level, *, (SELECT days FROM n) AS rewritten FROM hour UNION ALL SELECT 'day', *, (SELECT days FROM n) FROM day"
               " UNION ALL SELECT 'month', *, (SELECT months FROM n) FROM month"),
)
def refresh_changed(spark, sf):
    """All but a few records are appended and rolled up, then those few, of any age: only the partitions they lie in
    are rewritten, and all three levels equal a full recompute."""
    spec, table, folder = rollups.ogc_spec(TZ), fresh_path(spark, "access_logs"), fresh_path(spark, "rollups")
    df = facts(spark, sf)
    late = F.col("id").endswith("77")
    ingest.append_if_absent(spark, df.filter(~late), table)
    rollups.refresh_changed_levels(spark, table, folder, spec)
    ingest.append_if_absent(spark, df.filter(late), table)
    touched = rollups.refresh_changed_levels(spark, table, folder, spec)
    out = None
    for grain, level in rollups.stored_levels(spark, folder, spec).items():
        part = level.select(F.lit(grain).alias("level"), "*", F.lit(len(touched[grain])).cast("bigint").alias("rewritten"))
        out = part if out is None else out.unionByName(part)
    return out


@check(
    "global_views_a16",
    with_facts(
        ogc_ctes()
        + " SELECT 'ogc_daily_global' AS name, bucket, NULL AS item, CAST(sum(nb_req) AS BIGINT) AS nb_req FROM day GROUP BY bucket"
        " UNION ALL SELECT 'ogc_daily_per_layer', bucket, layer, CAST(sum(nb_req) AS BIGINT) FROM (SELECT bucket, nb_req, unnest(string_split(layers, ',')) AS layer FROM day) GROUP BY ALL"
        " UNION ALL SELECT 'ogc_monthly', bucket, NULL, CAST(sum(nb_req) AS BIGINT) FROM month GROUP BY bucket"
        f" UNION ALL SELECT 'all_daily', {PARIS['day'].format('ts')}, app_name, count(id) FROM facts GROUP BY ALL"
        f" UNION ALL SELECT 'all_monthly', {PARIS['month'].format('ts')}, app_name, count(id) FROM facts GROUP BY ALL"
    ),
)
def global_views(spark, sf):
    levels = _stored(spark, sf)
    views = rollups.global_views(levels["hour"], levels["day"], facts(spark, sf), TZ)
    out = None
    for name, df in views.items():
        item = next((c for c in ("layer", "app_name") if c in df.columns), None)
        part = df.select(
            F.lit(name).alias("name"), "bucket",
            (F.col(item) if item else F.lit(None).cast("string")).alias("item"), "nb_req",
        )
        out = part if out is None else out.unionByName(part)
    return out


@check(
    "ogc_summary_u1",
    with_facts(ogc_ctes() + " SELECT 'hour' AS period, * FROM hour UNION SELECT 'day', * FROM day UNION SELECT 'month', * FROM month"),
)
def ogc_summary(spark, sf):
    return rollups.summary(**_stored(spark, sf))


def _stored(spark, sf):
    """The three levels as a full refresh leaves them on storage."""
    spec, folder = rollups.ogc_spec(TZ), fresh_path(spark, "rollups")
    rollups.refresh_levels(spark, facts(spark, sf), folder, spec, "2023-12-01 00:00:00", "2024-04-01 00:00:00")
    return rollups.stored_levels(spark, folder, spec)


@check(
    "custom_rollup_x4",
    with_facts(f"SELECT {PARIS['day'].format('ts')} AS bucket, org_name, service, count(id) AS nb_req, quantile_cont(CAST(response_time AS DOUBLE), 0.5) AS response_time_median,"
               " min(CAST(response_time AS DOUBLE)) AS response_time_min, max(CAST(response_time AS DOUBLE)) AS response_time_max FROM facts WHERE status_code = 200 GROUP BY ALL"),
)
def custom_rollup(spark, sf):
    spec = rollups.RollupSpec("by_org", ("org_name",), ("service",), "median", TZ, F.col("status_code") == 200)
    return rollups.facts_rollup(facts(spark, sf), spec, "day")


# --- reports -----------------------------------------------------------------------------------

START, END = "2024-01-05 00:00:00", "2024-01-25 00:00:00"
_PERIOD = f"ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}'"
_LAYERED = f", l AS (SELECT *, unnest(string_split(layers, ',')) AS layer FROM facts WHERE {_PERIOD})"
_TOP = "coalesce(tiled, FALSE) = FALSE AND coalesce(service, '') NOT IN ('WMTS', 'TMS')"


@check(
    "top_layers_q1",
    with_facts(_LAYERED + f" SELECT workspaces, layer, count(id) AS nb_req FROM l WHERE {_TOP} AND list_contains(string_split(workspaces, ','), 'ws1') AND org_name = 'o3'"
               " GROUP BY ALL ORDER BY nb_req DESC, workspaces NULLS LAST, layer LIMIT 5"),
)
def top_layers(spark, sf):
    return reports.top_layers(facts(spark, sf), 5, START, END, workspace="ws1", org="o3")


@check(
    "top_layers_o3",
    with_facts(_LAYERED + " SELECT workspaces, layer, count(id) AS nb_req FROM l GROUP BY ALL ORDER BY nb_req DESC, workspaces NULLS LAST, layer LIMIT 10"),
)
def top_layers_all(spark, sf):
    return reports.top_layers(facts(spark, sf), 10, START, END, without_tiles=False)


_LOCAL_DAY = "CAST(ts + INTERVAL 1 HOUR AS DATE)"


@check(
    "top_layers_any_window_o3",
    with_facts(f", l AS (SELECT *, unnest(string_split(layers, ',')) AS layer FROM facts WHERE {_LOCAL_DAY} >= DATE '2024-01-03' AND {_LOCAL_DAY} < DATE '2024-01-29')"
               " SELECT workspaces, layer, count(id) AS nb_req FROM l GROUP BY ALL ORDER BY nb_req DESC, workspaces NULLS LAST, layer LIMIT 10"),
)
def top_layers_any_window(spark, sf):
    """From stored summaries of each day's thirty most requested layers; only layers that can be among the first are
    counted on the facts."""
    path = fresh_path(spark, "layer-days")
    df = facts(spark, sf)
    summaries.daily_layers(df, keep=30, tz=TZ).write.parquet(path)
    return summaries.top_layers(spark, spark.read.parquet(path), df, 10, "2024-01-03", "2024-01-29", TZ)


def _users_sql():
    def users(first, last):
        return f"(SELECT DISTINCT app_name, user_name FROM facts WHERE user_name IS NOT NULL AND {_LOCAL_DAY} >= DATE '{first}' AND {_LOCAL_DAY} < DATE '{last}')"

    return with_facts(
        f", a AS {users('2024-01-01', '2024-01-04')}, b AS {users('2024-01-04', '2024-01-08')},"
        " u AS (SELECT app_name, user_name, a.user_name IS NOT NULL AS in_a, b.user_name IS NOT NULL AS in_b FROM a FULL JOIN b USING (app_name, user_name))"
        " SELECT app_name, count_if(in_a AND NOT in_b) AS lapsed, count_if(in_a AND in_b) AS retained, count_if(in_b AND NOT in_a) AS gained, count_if(in_a) AS active FROM u GROUP BY 1"
    )


@check("lapsed_users_q7", _users_sql())
def lapsed_users(spark, sf):
    """From stored rows of each day's users; exact at any number of them."""
    path = fresh_path(spark, "user-days")
    summaries.user_days(facts(spark, sf), tz=TZ).write.parquet(path)
    return summaries.changed_users(spark.read.parquet(path), ("2024-01-01", "2024-01-04"), ("2024-01-04", "2024-01-08"))


@check(
    "usage_over_time_q2",
    with_facts(f"SELECT {PARIS['day'].format('ts')} AS bucket, org_name, count(id) AS nb_req FROM facts WHERE request = 'getfeature' GROUP BY ALL"
               f" UNION ALL SELECT {PARIS['day'].format('ts')}, NULL, count(id) FROM facts WHERE request = 'getfeature' GROUP BY 1"),
)
def usage_over_time(spark, sf):
    df, where = facts(spark, sf), F.col("request_details.request") == "getfeature"
    total = reports.usage_over_time(df, where).withColumn("org_name", F.lit(None).cast("string"))
    return reports.usage_over_time(df, where, by=["org_name"]).unionByName(total)


@check(
    "usage_by_nation_q2",
    with_facts("SELECT n_name, count(id) AS nb_req FROM facts JOIN customer ON CAST(substr(user_name, 2) AS BIGINT) = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"),
)
def usage_by_nation(spark, sf):
    """Organisations from the user dimension: counted per user first, so that the join is small."""
    users = facts(spark, sf).groupBy("user_name").agg(F.count("id").alias("n"))
    customer = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{sf}/nation.parquet").select("n_nationkey", "n_name")
    return (
        users.join(customer, F.substr("user_name", F.lit(2)).cast("bigint") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name").agg(F.sum("n").alias("nb_req"))
    )


@check(
    "user_layers_q3",
    with_facts(f", l AS (SELECT *, unnest(string_split(layers, ',')) AS layer FROM facts WHERE user_name = 'u7') SELECT {PARIS['day'].format('ts')} AS bucket, layer, count(id) AS nb_req FROM l WHERE layer IN ('l1', 'l2', 'l3') GROUP BY ALL"),
)
def user_layers(spark, sf):
    return reports.user_layers(facts(spark, sf), "u7", ["l1", "l2", "l3"])


@check(
    "user_context_q4",
    with_facts(f"SELECT {PARIS['month'].format('ts')} AS bucket, count(id) AS nb_req FROM facts WHERE user_name = 'u7' AND k % 3 = 1 GROUP BY ALL"),
)
def user_context(spark, sf):
    from mapmeter.functions.legacy import mviewer_map

    url = F.expr("concat('/mviewer/?config=Map', k % 3, '.xml')")
    df = facts(spark, sf, "k").withColumn("context", mviewer_map(url))
    return reports.user_context(df, "u7", F.col("context") == "map1.xml", "2024-01-01 00:00:00", "2024-04-01 00:00:00")


@check("downloads_per_resource_q5", with_facts("SELECT request_path, count(id) AS nb_downloads FROM facts WHERE is_download GROUP BY ALL"))
def downloads_per_resource(spark, sf):
    return reports.downloads_per_resource(facts(spark, sf))


@check(
    "metadata_view_shares_q6",
    with_facts(f"SELECT count_if(k % 4 = 0) AS nb_html, count_if(k % 4 <> 0) AS nb_xml, count_if(k % 4 = 0) / count(*) AS html_share FROM facts WHERE {_PERIOD}"),
)
def metadata_view_shares(spark, sf):
    path = F.expr("concat('/geonetwork/srv/api/records/x', CASE WHEN k % 4 = 0 THEN '' ELSE '/formatters/xml' END)")
    df = facts(spark, sf, "k").withColumn("request_path", path)
    return reports.metadata_view_shares(df, ~F.col("request_path").endswith("/xml"), START, END)


@check("user_activity_q7", with_facts("SELECT user_name, count(id) AS nb_req, max(ts) AS last_seen FROM facts GROUP BY ALL"))
def user_activity(spark, sf):
    return reports.user_activity(facts(spark, sf))


@check("inactive_users_q7", with_facts("SELECT user_name, count(id) AS nb_req, max(ts) AS last_seen FROM facts GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-29 12:00:00'"))
def inactive_users(spark, sf):
    return reports.inactive_users(facts(spark, sf), "2024-03-29 12:00:00", 2)


@check("agents_and_referrers_q8", with_facts("SELECT user_agent_family, referrer, count(id) AS nb_req FROM facts WHERE app_name <> 'dataapi' GROUP BY ALL"))
def agents_and_referrers(spark, sf):
    return reports.agents_and_referrers(_stored(spark, sf)["hour"])


# --- streams -----------------------------------------------------------------------------------


def _fact_files(spark, df):
    path = fresh_path(spark, "stream-in")
    df.write.parquet(path)
    return path


def _collected(query_df, spark, mode="append"):
    """Run a stream over what is there and read its output back."""
    out = fresh_path(spark, "stream-out")
    query = (
        query_df.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", fresh_path(spark, "stream-state"))
        .outputMode(mode).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(query_df.schema).parquet(out)


@check(
    "ingest_stream_st1",
    with_lines("SELECT substr(md5(line), 1, 12) AS id, sec AS ts, app_name, layers, response_size FROM lines"),
)
def ingest_stream(spark, sf):
    table = fresh_path(spark, "access_logs")
    jobs.ingest_stream(
        logs.stream_text_logs(spark, _line_files(spark, sf)), "text", table, fresh_path(spark, "stream-state"), SETTINGS
    ).awaitTermination()
    df = tables.read_access_logs(spark, table)
    return df.select("id", "ts", "app_name", F.col("request_details.layers").alias("layers"), "response_size")


@check("late_bound_st2", with_facts("SELECT date_trunc('hour', ts) AS bucket, count(id) AS nb_req FROM facts WHERE ts < (SELECT date_trunc('hour', max(ts)) FROM facts) - INTERVAL 7 DAY GROUP BY ALL"))
def late_bound(spark, sf):
    """Hours are final, and written, once the watermark has passed them."""
    path = _fact_files(spark, facts(spark, sf))
    stream = spark.readStream.schema(ACCESS_LOG_SCHEMA).parquet(path)
    hours = jobs.bounded_late(stream).groupBy(F.window("ts", "1 hour")).agg(F.count("id").alias("nb_req"))
    out = _collected(hours.select(F.col("window.start").alias("bucket"), "nb_req"), spark)
    return out.select("bucket", "nb_req")


@check(
    "late_rows_st2",
    with_facts(ogc_ctes()
               + ", n AS (SELECT count(*) AS late FROM facts WHERE k % 5 = 0 AND ts <= (SELECT max(ts) FROM facts WHERE k % 5 > 0) - INTERVAL 2 DAY)"
               " SELECT 'hour' AS level, *, (SELECT late FROM n) AS late_rows FROM hour UNION ALL SELECT 'day', *, (SELECT late FROM n) FROM day"
               " UNION ALL SELECT 'month', *, (SELECT late FROM n) FROM month"),
)
def late_rows(spark, sf):
    """A stream of two files, of which the second one's rows are mostly behind the watermark: those are kept apart, and
    the rollups of all levels hold them too, as a full recompute does."""
    source, table, folder, late = (fresh_path(spark, n) for n in ("stream-in", "access_logs", "rollups", "late"))
    df = facts(spark, sf, "k")
    for part in ("k % 5 > 0", "k % 5 = 0"):
        df.filter(part).select(*ACCESS_LOG_SCHEMA.names).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(ACCESS_LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    spec = rollups.ogc_spec(TZ)
    jobs.metered_stream(stream, table, folder, late, fresh_path(spark, "stream-state"), [spec], "2 days").awaitTermination()
    n = spark.read.schema(ACCESS_LOG_SCHEMA).parquet(late).count()
    out = None
    for grain, level in rollups.stored_levels(spark, folder, spec).items():
        part = level.select(F.lit(grain).alias("level"), "*", F.lit(n).cast("bigint").alias("late_rows"))
        out = part if out is None else out.unionByName(part)
    return out


@check("dedupe_stream_st3", with_facts("SELECT CASE WHEN k % 9 = 0 THEN NULL ELSE id END AS id, count(*) AS nb FROM (SELECT id, k FROM facts UNION ALL SELECT id, k FROM facts WHERE event_id % 10 = 0 AND k % 9 = 0) GROUP BY 1"))
def dedupe_stream(spark, sf):
    df = facts(spark, sf, "event_id", "k").withColumn("id", F.expr("CASE WHEN k % 9 = 0 THEN NULL ELSE id END"))
    path = _fact_files(spark, df.unionByName(df.filter("event_id % 10 = 0")).select(*ACCESS_LOG_SCHEMA.names))
    stream = spark.readStream.schema(ACCESS_LOG_SCHEMA).parquet(path)
    out = _collected(jobs.dedupe_stream(stream).select("id"), spark)
    return out.groupBy("id").agg(F.count(F.lit(1)).alias("nb"))


@check("reconcile_stream_st4", RECONCILED_SQL + " SELECT * FROM merged")
def reconcile_stream(spark, sf):
    """The same records as in batch; one far ahead on each side moves the watermark past all others."""
    sides = []
    for side in _two_sides(spark, sf):
        last = side.limit(1).withColumns({"timestamp": F.lit("2030-01-01").cast("timestamp"), "span_id": F.lit("end")})
        files = _fact_files(spark, side.unionByName(last))
        sides.append(spark.readStream.schema(OTEL_SCHEMA).parquet(files))
    with state_on_disk(spark):
        out = _collected(jobs.reconcile_stream(*sides), spark)
    return _reconciled(out.filter("span_id IS NULL OR span_id <> 'end'"))


@check(
    "hourly_stream_st5",
    with_facts("SELECT date_trunc('hour', ts) AS bucket, app_name, count(id) AS nb_req, min(CAST(response_time AS DOUBLE)) AS response_time_min, max(CAST(response_time AS DOUBLE)) AS response_time_max"
               " FROM facts WHERE ts < (SELECT date_trunc('hour', max(ts)) FROM facts) - INTERVAL 7 DAY GROUP BY ALL"),
)
def hourly_stream(spark, sf):
    stream = spark.readStream.schema(ACCESS_LOG_SCHEMA).parquet(_fact_files(spark, facts(spark, sf)))
    return _collected(jobs.hourly_stream(stream, "app_name"), spark).drop("sketch")


@check(
    "expire_st6",
    with_facts("SELECT id, (SELECT count(DISTINCT CAST(ts AS DATE)) FROM facts WHERE ts >= TIMESTAMP '2024-02-01 06:00:00' - INTERVAL 21 DAY) AS days"
               " FROM facts WHERE ts >= TIMESTAMP '2024-02-01 06:00:00' - INTERVAL 21 DAY"),
)
def expire(spark, sf):
    """A stored table after retention: whole days are gone, the border day is cut; the same rows as by filter."""
    path = fresh_path(spark, "access_logs")
    tables.write_access_logs(facts(spark, sf), path)
    maintenance.expire_stored(spark, path, "ts", maintenance.RETENTION["hour"], "2024-02-01 06:00:00", "ts_date")
    days = len(tables.date_folders(spark, path, "ts_date"))
    kept = tables.read_access_logs(spark, path)
    filtered = maintenance.expire(kept, "ts", maintenance.RETENTION["hour"], "2024-02-01 06:00:00", "ts_date")
    return filtered.select("id", F.lit(days).cast("bigint").alias("days"))
