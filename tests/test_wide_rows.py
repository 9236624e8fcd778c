"""Work per row of the session and behaviour tables: what is stored, copied, parsed and counted once."""

import glob
import os

from pyspark.sql import functions as F
from test_sessions import CONN, event, raw

from tidewatch.functions.ip import v4_number
from tidewatch.functions.values import SAFE_LOG_TYPES, safe_log_type
from tidewatch.operators.behaviors import facet_summary, session_ref_rows
from tidewatch.operators.hardening import harden_sessions
from tidewatch.operators.sections import SECTION_OF_LOG_TYPE, list_values
from tidewatch.operators.sessions import _list_field, build_sessions
from tidewatch.plans import views
from tidewatch.schemas import RAW_COLUMNS
from tidewatch.sources import adapters
from tidewatch.sources.adapters import SUBNETS, raw_logs


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_list_values_come_from_plain_generators(spark):
    rows = raw(spark, event("dns", "d", uid="C1", answers=["a", "", None, "b"]), event("files", "f", 1, uid="C1", fuid="F", fuids=["G"]), CONN)
    got = list_values(rows, ["conn", "dns", "files"], F.unix_micros("ts"), F.col("raw_id"), "uid")
    assert "lambda" not in optimized(got)
    assert sorted((r.field, r.id, r.pos, r.value) for r in got.collect()) == [
        ("dns.answers", "d", 0, "a"), ("dns.answers", "d", 3, "b"), ("files.fuids", "f", 0, "F"), ("files.fuids", "f", 1, "G")]
    assert list_values(rows, ["conn"], F.unix_micros("ts"), F.col("raw_id"), "uid") is None


def test_hardening_carries_untouched_columns_as_one(spark):
    built = build_sessions(raw(spark, CONN, event("http", "h", 1, uid="C1", host="a")), parts=("certificates", "facts"), updated_at=views.epoch())
    hard = harden_sessions(built, SUBNETS)
    assert hard.columns == built.columns and "_kept" in optimized(hard)
    before, after = built.collect()[0], hard.collect()[0]
    assert all(before[n] == after[n] for n in ("ts", "event_count", "has_http", "conn", "http", "updated_at")) and after.http.host == "a"


def test_hardening_parses_each_address_once(spark):
    hard = harden_sessions(build_sessions(raw(spark, CONN), parts=("certificates", "facts")), SUBNETS)
    plan = optimized(hard)
    assert plan.count(" AS _s_v4#") == 1 and plan.count(" AS _d_v6#") == 1
    assert not [n for n in hard.columns if n.startswith("_")]


def test_v4_addresses_are_read_without_splitting(spark):
    texts = ["10.51.3.4", "255.255.255.255", "0.0.0.0", "01.2.3.4", "1.2.3", "1.2.3.4.5", ".1.2.3", "256.1.1.1", "a.b.c.d", "", None, "fe80::1"]
    numbers = spark.createDataFrame([(t,) for t in texts], "ip string").select("ip", v4_number(F.col("ip")).alias("n"))
    assert "split(" not in optimized(numbers)
    assert [r.n for r in numbers.collect()] == [171115268, 4294967295, 0] + [None] * 9


def test_filter_on_eligibility_does_not_parse_addresses(spark):
    hard = harden_sessions(build_sessions(raw(spark, CONN), parts=("certificates", "facts")), SUBNETS)
    sessions = spark.createDataFrame(hard.collect(), hard.schema)
    filters = [line for line in optimized(session_ref_rows(sessions)).splitlines() if "Filter" in line]
    assert filters and not any("split" in line or "lambda" in line for line in filters)


def test_facets_are_counted_and_shuffled_once(spark):
    key = {"entity": "a", "sensor_key": "s", "window_start": 1}
    values = [("dst_ip", "x", 3), ("dst_ip", "y", 5), ("subject", "z", 1), ("excluded_reason", "why", 2), ("user_agent", "u", 1)]
    rows = spark.createDataFrame([(*key.values(), f, v) for f, v, n in values for _ in range(n)], [*key, "facet", "value"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = facet_summary(rows.groupBy(*rows.columns).agg(F.count("*").alias("n")), limit=1)
        assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
        got = out.collect()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert (got.unique_destination_ip_count, got.http_unique_user_agent_count) == (2, 1)
    assert [tuple(x) for x in got.top_destination_ips] == [("y", 5)] and [tuple(x) for x in got.excluded_reasons] == [("why", 2)]


def test_raw_table_stores_what_the_logs_have(spark, tmp_path):
    events = [(i, t, i / 3, f'{{"k": {i * 7 % 100}}}') for i in range(60) for t in [("click", "view", "purchase", "error", "signup")[i % 5]]]
    spark.createDataFrame(events, "event_id bigint, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    table, view = views.raw_table(spark, str(tmp_path)), raw_logs(spark, str(tmp_path))
    assert table.dtypes == view.dtypes and sorted(map(str, table.collect())) == sorted(map(str, view.collect()))
    path = next(p for (_, d, kind), p in views._STORED.items() if d == str(tmp_path) and kind == "raw")
    assert len(spark.read.parquet(path).columns) < len(RAW_COLUMNS)


def test_raw_table_is_cut_by_rows_not_by_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapters, "SLICE_ROWS", 20)
    events = [(i if i % 9 else None, "view", i / 3, f'{{"k": {i}}}', None) for i in range(60)] * 2
    spark.createDataFrame(events, "event_id bigint, event_type string, value double, props string, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    table, view = views.raw_table(spark, str(tmp_path)), raw_logs(spark, str(tmp_path))
    assert sorted(map(str, table.collect())) == sorted(map(str, view.collect()))
    path = next(p for (_, d, kind), p in views._STORED.items() if d == str(tmp_path) and kind == "raw")
    assert len(glob.glob(f"{path}/part-*.parquet")) >= 3


def test_known_log_types_are_not_matched_again(spark):
    texts = [*SECTION_OF_LOG_TYPE, "quic", "DNS", " ssl ", "a b", "", None, "x/y", "UNKNOWN"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(safe_log_type(F.col("t"))).collect()]
    assert got == [*SECTION_OF_LOG_TYPE, "quic", "dns", "ssl", "a_b", "unknown", "unknown", "x_y", "unknown"]
    assert set(SECTION_OF_LOG_TYPE) <= set(SAFE_LOG_TYPES)


def test_list_values_are_put_in_order_once(spark):
    rows = spark.createDataFrame([("k", [("notice.notes", (1, "a", 0), "n")])],
                                 "key string, entries array<struct<field:string,o:struct<us:bigint,id:string,pos:int>,value:string>>")
    out = rows.select(_list_field("notice", "notes").alias("notes"), _list_field("notice", "subs").alias("subs"))
    assert optimized(out).count("sort_array") == 2
    assert tuple(out.collect()[0]) == (["n"], None)


def test_a_long_list_of_certificates_is_written_once_for_many_sessions(spark, tmp_path):
    from tidewatch.plans.session_queries import kept_events
    from tidewatch.session import configure
    spark.createDataFrame([(0, "view", 1.0, '{"k": 1}')], "event_id bigint, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    text = spark.range(1, numPartitions=1).select(F.expr("array_join(transform(sequence(1, 60000), i -> sha2(cast(i as string), 256)), '|')").alias("ids"))  # 3.9 MB
    rows = spark.range(150, numPartitions=1).join(F.broadcast(text))
    sizes = []
    for name, begin in (("plain", configure), ("a05", lambda s: kept_events(s, str(tmp_path)))):
        begin(spark)
        rows.write.parquet(f"{tmp_path}/{name}")
        sizes.append(sum(os.path.getsize(p) for p in glob.glob(f"{tmp_path}/{name}/part-*")))
        assert spark.read.parquet(f"{tmp_path}/{name}").select("ids").distinct().count() == 1
    configure(spark)
    assert sizes[1] < 8e6 < 100 * 8e5 < sizes[0] and spark.conf.get("parquet.dictionary.page.size") == "1048576"
