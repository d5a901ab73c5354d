"""Column functions against brute force in Python."""

import re
from datetime import datetime, timedelta, timezone
from urllib.parse import parse_qs, urlparse
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from mapmeter.functions import agents, jsons, ogc, times, urls, values
from mapmeter.functions.base import UNIT, settle_groups
from mapmeter.settings import CLF_PATTERN, COMBINED_PATTERN

URLS = [
    "https://Maps.Example.org:8080/a/b;jsessionid=3?X=1&y=%C3%89+z&styles=&flag&x=2#/metadata/4",
    "/geoserver/ows?service=WMS&request=GetCapabilities",
    "http://user:pw@host.example.org/p",
    "//host/p?q",
    "http://[::1]:80/x",
    "100%?a=100%&b=%zz&=e&c==",
    "/a b|c?x=|&y=é",
    "",
]

QUERIES = [
    "service=wms&styles=&flag&a=1&a=2&x%3d=%26y&&=e&c==&d=100%&e=a+b",
    "&first=1&&last=2&",
    "a=1&a=2&b=%41&%62=3",
    "x=%1f1&y=\x1e2&y=3",
    "bbox=1%2c2%2C3&layers=ws%3aroads,other",
    "a=é&b=%c3%a9&z=%ff&p=%",
    "=",
    "&",
    "",
    "a" * 3000 + "=1&b=" + "y" * 5000,
]


def test_split_url_agrees_with_urlparse(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    for row in df.select("u", urls.split_url(F.col("u")).alias("p")).collect():
        want = urlparse(row.u.lower())
        assert (row.p.host, row.p.path, row.p.query, row.p.fragment) == (
            want.hostname, want.path, want.query, want.fragment,
        )


def test_query_map_agrees_with_parse_qs(spark):
    df = spark.createDataFrame([(q,) for q in QUERIES], "q string")
    staged = urls.settle_query_map(df, "m", F.lower("q")).withColumn("n", urls.query_map(F.col("q")))
    for row in staged.collect():
        want = {k.lower(): v[0].lower() for k, v in parse_qs(row.q.lower()).items()}
        assert row.m == want
        assert row.n == want


def test_query_map_of_null_is_empty(spark):
    df = spark.createDataFrame([(None,)], "q string")
    assert urls.settle_query_map(df, "m", F.col("q")).first().m == {}


@pytest.mark.parametrize("pattern", [CLF_PATTERN, COMBINED_PATTERN])
def test_groups_agree_with_re(spark, pattern):
    head = '10.0.0.1 - jo|Org é|R1,R2 [18/Oct/2023:17:36:10 +0200] "GET /geoserver/ws/wms?a=1 HTTP/1.1" 200 -'
    lines = [
        head,
        head + ' "-" "Agent/1.0 (X11)" - "app" "-" 18ms',
        head.replace("a=1", f"a={UNIT}1") + ' "-" "Agent/1.0" - "app" "-" 18ms',
        "no log line",
        f"{UNIT}odd",
        "",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    for row in settle_groups(df, "g", "value", pattern).collect():
        match = re.match(pattern, row.value)
        assert row.g == ([g or "" for g in match.groups()] if match else None)


@pytest.mark.parametrize("zone", ["Europe/Paris", "Asia/Kolkata", "America/St_Johns", "UTC"])
def test_buckets_agree_with_zoneinfo(spark, zone):
    start = datetime(2024, 3, 30, 20, 10, tzinfo=timezone.utc)
    stamps = [start + timedelta(minutes=37 * i) for i in range(60)]
    stamps += [datetime(2024, 10, 26, 20, 10, tzinfo=timezone.utc) + timedelta(minutes=37 * i) for i in range(60)]
    df = spark.createDataFrame([(int(s.timestamp()),) for s in stamps], "s long").withColumn("ts", F.timestamp_seconds("s"))
    out = df.select("s", *[F.unix_seconds(times.bucket(g, F.col("ts"), zone)).alias(g) for g in ("hour", "day", "month")])
    tz = ZoneInfo(zone)
    for row in out.collect():
        local = datetime.fromtimestamp(row.s, tz)
        day = local.replace(hour=0, minute=0, second=0, microsecond=0, fold=0)
        assert row.day == int(day.timestamp())
        assert row.month == int(day.replace(day=1).timestamp())
        # an hour bucket starts on the local hour and is at most an hour back
        assert 0 <= row.s - row.hour < 3600
        assert datetime.fromtimestamp(row.hour, tz).minute == 0


def test_autumn_hours_stay_apart(spark):
    df = spark.sql("SELECT explode(array(timestamp'2024-10-27 00:30:00', timestamp'2024-10-27 01:30:00')) AS ts")
    assert df.select(times.bucket_hour(F.col("ts"), "Europe/Paris")).distinct().count() == 2


def test_numbers(spark):
    texts = ["1", "18x", "1.9", "99999999999", " 7 ", "1.5f", "", "-", None, "1e3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(values.int_or_none(F.col("t")).alias("i"), values.float_or_none(F.col("t")).alias("f")).collect()
    assert [r.i for r in rows] == [1, None, None, None, 7, None, None, None, None, None]
    assert [r.f for r in rows] == [1.0, None, 1.9, 99999999999.0, 7.0, None, None, None, None, 1000.0]


def test_only_integers_reach_the_cast(spark):
    """A failing cast costs an error in each row; what it would have read is still read."""
    texts = ["\x00 5\x1f", "5\x7f", "-2147483648", "2147483648", "+7", "007", "5\n", "--1", "+", "\u0665", "\u00a05", "5 5", "1_0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.col("t").try_cast("int").alias("cast"), values.int_or_none(F.col("t")).alias("i"))
    assert all(r.i == r.cast for r in df.collect())
    plan = df.select("i")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RLIKE") < plan.index("cast(")


def test_response_time(spark):
    df = spark.createDataFrame([("1.32",), ("0.626",), ("0",), ("18",), (None,), ("x",)], "t string")
    rows = df.select(values.response_time_ms(F.col("t"), "s").alias("s"), values.response_time_ms(F.col("t")).alias("ms")).collect()
    assert [r.s for r in rows] == [1320, 626, None, 18000, None, None]
    assert [r.ms for r in rows] == [1, 0, None, 18, None, None]


def test_users(spark):
    df = spark.createDataFrame([("jo|Org|R1,R2",), ("jo|Org",), ("jo",), ("",), (None,)], "u string")
    got = [tuple(r.x) for r in df.select(values.split_user(F.col("u")).alias("x")).collect()]
    assert got == [
        ("jo", "Org", ["R1", "R2"]), ("jo", "Org", None), ("jo", None, None), (None, None, None), (None, None, None),
    ]


def test_workspaces_and_layers(spark):
    cases = [
        ("/my_ws/ows", "my_ws:a", "my_ws", "a"),
        ("/my_ws/ows", "a,b", "my_ws", "a,b"),
        ("/my_ws/ows", "a,other:b", "my_ws,other", "a,b"),
        ("/ows", "x:a,y:b", "x,y", "a,b"),
        ("/my_ws/gwc/service/wmts", "a", "my_ws", "a"),
        ("/my_ws/service", "a", "", "a"),
        ("/ows", "x:a:b", "x", "a:b"),
    ]
    df = spark.createDataFrame(cases, "path string, given string, ws string, layers string")
    got = ogc.normalise_layers(ogc.workspace_from_path(F.col("path")), F.col("given"))
    for row in df.withColumn("got", got).collect():
        assert (row.got.workspaces, row.got.layers) == (row.ws, row.layers)


def test_last_alias_wins(spark):
    df = spark.sql("SELECT map('layers', 'a', 'typename', 'b') AS m UNION ALL SELECT map('typename', 'b', 'layer', 'c') UNION ALL SELECT map('x', 'y')")
    assert [r[0] for r in df.select(ogc.request_layers(F.col("m"))).collect()] == ["b", "c", None]


def test_lower_keys_keeps_last(spark):
    df = spark.sql("SELECT map('Format', 'a', 'FORMAT', 'b', 'x', 'c') AS m")
    assert df.select(ogc.lower_keys(F.col("m")).alias("m")).first().m == {"format": "b", "x": "c"}


def test_json_kinds(spark):
    texts = ['{"a":1}', "[1]", "3", '"s"', "null", "{bad", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(jsons.json_kind(F.col("t"))).collect()]
    assert got == ["object", "array", "scalar", "scalar", "scalar", None, None]


def test_user_agents(spark):
    texts = [
        "Mozilla/5.0 (X11; Linux x86_64; rv:140.0) Gecko/20100101 Firefox/140.0",
        "Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) AppleWebKit/605.1.15 Version/17.2 Mobile/15E148 Safari/604.1",
        "SomeTool-1.15.1",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.a for r in df.select(agents.user_agent_fields(F.col("t")).alias("a")).collect()]
    assert (got[0].user_agent_family, got[0].user_agent_version, got[0].os_family, got[0].os_version) == ("Firefox", "140.0", "Linux", None)
    assert (got[1].user_agent_family, got[1].user_agent_version, got[1].os_family, got[1].os_version, got[1].device_model) == ("Safari", "17.2", "iOS", "17", "iPhone")
    assert (got[2].user_agent_string, got[2].user_agent_family, got[2].os_family) == ("SomeTool-1.15.1", "Other", None)
