"""Registered queries against their SQL, on the smallest given tables."""

import math
import os

import pytest

import __spark_entry__ as contract
from checks import load

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SAMPLE = (
    "query_map_f3", "bucket_tz_f1", "ogc_details_f25", "append_if_absent_s4", "csv_round_trip_s5_s6", "parse_line_p1",
    "text_logs_to_records_x2", "telemetry_to_records_x2", "reconcile_j6", "ogc_summary_u1", "dataapi_monthly_a6",
    "refresh_rollup_a15", "top_layers_q1", "usage_by_nation_q2", "dedupe_stream_st3", "reconciled_to_facts", "reconcile_stream_st4",
    "lookup_app_j3", "lookup_user_agent_j7", "drain_buffer_s8", "expire_st6", "load_csv_s6", "legacy_line_record_f35", "global_views_a16",
    "append_after_crash_s4", "text_intake_x2", "compact_s9", "refresh_changed_a15", "late_rows_st2", "lapsed_users_q7",
    "dataapi_daily_quantiles_a5", "true_median_monthly_a3", "top_layers_any_window_o3",
)

needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not here")


def test_every_query_has_sql():
    queries, oracles = load()
    assert set(oracles) == set(queries)


def _norm(row):
    return repr(tuple(round(v, 9) if isinstance(v, float) and not math.isnan(v) else v for v in row))


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = contract.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(_norm(r) for r in df.select(*columns).collect())
    result = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(_norm([row[names.index(c)] for c in columns]) for row in result.fetchall())
    assert got == want


@needs_data
def test_flagship(spark):
    assert contract.entry(spark).count() > 0
