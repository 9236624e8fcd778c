"""Session building, merging and hardening on literal rows."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.hardening import harden_sessions
from tidewatch.operators.merge import merge_sessions
from tidewatch.operators.sessions import build_sessions, evidence_rows, kept_event_rows, listed_ids, listed_shared_ids, shared_events, shared_evidence, summed_events, to_documents
from tidewatch.schemas import raw_schema
from tidewatch.sources.tables import SessionTable

T0 = datetime(2026, 5, 6, 16, 0, 0, tzinfo=timezone.utc)


def event(log_type, raw_id, seconds=0, uid="C1", **fields):
    base = {"raw_id": raw_id, "raw_index": "zeek", "ts": T0 + timedelta(seconds=seconds), "log_type": log_type, "sensor": "sensor1",
            "uid": uid, "orig_h": "192.168.25.129", "orig_p": 50000, "resp_h": "93.184.216.34", "resp_p": 443}
    return base | fields


def raw(spark, *rows):
    schema = raw_schema()
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


CONN = event("conn", "r1", conn_state="SF", proto="tcp", service="ssl", orig_bytes=10, resp_bytes=5, local_orig=True, local_resp=False)
SSL = event("ssl", "r2", 1, server_name="example.com", validation_status="ok", cert_chain_fps=["F1", "F2"])
NOTICE = event("notice", "r3", 2, note="SSL::Invalid_Server_Cert", msg="bad")


def test_conn_ssl_notice(spark):
    s = only(build_sessions(raw(spark, CONN, SSL, NOTICE)))
    assert (s.session_id, s.dst_port, s.conn.state, s.event_count, s.protocol, s.bytes) == ("C1", 443, "SF", 3, "tls", 15)
    assert s.has_notice and s.has_tls and s.notice.notes == ["SSL::Invalid_Server_Cert"] and s.direction == "outbound"
    assert [e.id for e in s.evidence] == ["r1", "r2", "r3"]


def test_copied_event_counts_but_is_kept_once(spark):
    s = only(build_sessions(raw(spark, CONN, CONN)))
    assert (s.event_count, len(s.evidence), len(s.zeek["conn"])) == (2, 1, 1)


def test_certificates_are_shared_and_unmatched_ones_dropped(spark):
    certs = [event("x509", "x1", 3, uid=None, fingerprint="F1", cert_subject="CN=a", cert_issuer="CN=a"),
             event("x509", "x2", 4, uid=None, fingerprint="F9", cert_subject="CN=z")]
    other = event("ssl", "r9", 9, uid="C2", cert_chain_fps=["F1"])
    rows = {r.session_id: r for r in harden_sessions(build_sessions(raw(spark, CONN, SSL, other, *certs))).collect()}
    assert set(rows) == {"C1", "C2"}
    assert all("x509" in r.log_types and r.x509.subjects == ["CN=a"] for r in rows.values())
    assert rows["C1"].event_count == 3 and rows["C2"].event_count == 2


def test_synthetic_key_splits_by_minute(spark):
    rows = [event("weird", "a", 1, uid=None), event("weird", "b", 59, uid=None), event("weird", "c", 61, uid=None)]
    got = sorted(r.event_count for r in build_sessions(raw(spark, *rows)).collect())
    assert got == [1, 2]


def test_dns_text_and_unknown_type(spark):
    s = only(build_sessions(raw(spark, event("dns", "d", query="example.com", qtype_name="A", rcode_name="NOERROR"), event("brand_new", "n", 1))))
    assert (s.dns.query_length, s.dns.label_count, s.dns.longest_label_length) == (11, 2, 7)
    assert "brand_new" in s.zeek and not s.dns.is_nxdomain


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_event_order_does_not_matter(spark, order):
    rows = [CONN, SSL, NOTICE]
    s = only(build_sessions(raw(spark, *[rows[i] for i in order]), updated_at=F.lit(T0)))
    assert s.first_seen < s.last_seen and s.log_types == ["conn", "notice", "ssl"] and s.tls.server_name == "example.com"


def test_nothing_of_a_large_session_is_cut(spark):
    certs = [event("x509", f"x{i}", 3 + i, uid=None, fingerprint=f"F{i}", cert_subject=f"CN={i}", basic_constraints_ca=(i == 24)) for i in range(25)]
    hello = event("ssl", "r2", 1, cert_chain_fps=[f"F{i}" for i in range(25)])
    many = [event("conn", f"c{i:03d}", i, ndr_noise=(i == 149), ndr_noise_type="late_noise") for i in range(150)]
    rows = raw(spark, hello, *certs, *many, many[0])
    s = only(harden_sessions(build_sessions(rows, parts=("certificates", "facts"))))
    assert (s.event_count, s.evidence_count, s.normalized_event_count, s.events_truncated) == (177, 176, 176, False)
    assert len(s.x509.subjects) == 25 and s.x509.is_ca and s.evidence is None and "late_noise" in s.noise_tags
    whole = only(harden_sessions(build_sessions(rows)))
    assert (len(whole.evidence), len(whole.zeek["conn"]), whole.evidence_count) == (176, 150, 176)
    long = evidence_rows(rows).collect()
    assert len(long) == 176 and {r.log_type for r in long} == {"conn", "ssl", "x509"}


def test_late_event_is_merged(spark):
    old = harden_sessions(build_sessions(raw(spark, CONN)))
    m = only(merge_sessions(old, build_sessions(raw(spark, SSL))))
    assert (m.merge_state, m.event_count, len(m.evidence), m.has_tls, m.conn.state) == ("updated", 2, 2, True, "SF")


def test_control_plane_resets_exclusion(spark):
    noisy = event("http", "h", ndr_noise=True, ndr_noise_type="package_update", resp_p=80)
    s = only(harden_sessions(build_sessions(raw(spark, noisy))))
    assert s.category == "noise" and s.excluded_from_behavior is False and "package_update" in s.noise_reasons
    s = only(harden_sessions(build_sessions(raw(spark, event("conn", "c", resp_p=9200)))))
    assert s.category == "control_plane" and s.noise_reasons == ["destination_port:9200", "opensearch_api"]


def test_upsert_is_idempotent_and_keeps_the_day(spark, tmp_path):
    table = SessionTable(spark, str(tmp_path / "sessions"))
    assert table.upsert(build_sessions(raw(spark, CONN)))["created"] == 1
    late = dict(SSL, ts=T0 + timedelta(days=1))
    other = event("conn", "q", uid="C7")
    first = table.upsert(build_sessions(raw(spark, late, other)))
    assert (first["created"], first["updated"]) == (1, 1)
    again = table.upsert(build_sessions(raw(spark, late, other)))
    assert (again["created"], again["updated"]) == (0, 2)
    rows = {r.session_id: r for r in table.read().collect()}
    assert len(rows) == 2 and rows["C1"].event_count == 2 and str(rows["C1"].event_date) == "2026-05-06"
    assert to_documents(table.read().drop("event_date")).count() == 2


def test_events_of_a_large_session_stay_rows(spark):
    hello = event("ssl", "r2", 1, cert_chain_fps=["F1"])
    cert = event("x509", "x1", 3, uid=None, fingerprint="F1", cert_subject="CN=a")
    many = [event("conn", f"c{i:03d}", 300 - i) for i in range(150)]
    rows = kept_event_rows(raw(spark, hello, cert, *many, many[0]))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan
    got = {r.log_type: r for r in listed_ids(rows).collect()}
    assert {t: r.n for t, r in got.items()} == {"conn": 150, "ssl": 1, "x509": 1}
    assert got["conn"].ids == "|".join(f"c{i:03d}" for i in reversed(range(150)))


def test_merge_counts_events_of_long_tables(spark):
    sides = [raw(spark, CONN, NOTICE), raw(spark, CONN, SSL, event("x509", "x1", 3, uid=None, fingerprint="F1"))]
    old, new = (build_sessions(r, sections=(), parts=("certificates",), with_key=True) for r in sides)
    m = only(merge_sessions(old, new, events=kept_event_rows(sides[0]).unionByName(kept_event_rows(sides[1]))))
    assert (m.session_id, m.merge_state, m.event_count, m.log_types, m.zeek) == ("C1", "updated", 4, ["conn", "notice", "ssl", "x509"], None)


def test_whole_merge_keeps_certificates_and_events_without_uid(spark):
    from tidewatch.plans.session_queries import whole_batches

    at = lambda row, e: row | {"doc": f'{{"e":{e}}}'}
    rows = raw(spark, at(CONN, 0), at(SSL, 1), at(event("x509", "x1", 3, uid="C9", fingerprint="F1"), 2), at(event("conn", "k1", uid=None, community_id="1:a"), 3),
               at(event("dns", "k2", 5, uid=None, community_id="1:a"), 4), at(event("weird", "y1", 7, uid=None), 6), at(event("weird", "y2", 8, uid=None), 7))
    got = {r.key.split(":")[0]: (r.merge_state, r.event_count, r.log_types) for r in whole_batches(rows).collect()}
    assert got == {"C1": ("updated", 3, ["conn", "ssl", "x509"]), "1": ("updated", 2, ["conn", "dns"]), "synthetic": ("updated", 2, ["weird"])}


def many_certificates():
    """Ten sessions that each show two fingerprints of thirty certificates; one certificate event bears both."""
    hellos = [event("ssl", f"s{i}", i, uid=f"C{i}", cert_chain_fps=["F1", "F2"] if i % 2 else ["F1", "F9"]) for i in range(10)]
    certs = [event("x509", f"x{i:02d}", 100 - i, uid=None, fingerprint=f"F{i % 2 + 1}", cert_subject=f"CN={i}") for i in range(30)]
    return [*hellos, *certs, event("x509", "x00", 100, uid=None, fingerprint="F2"), certs[3], hellos[4]]


def test_shared_events_give_what_the_long_table_gives(spark):
    rows = raw(spark, *many_certificates())
    at = F.struct("us", "raw_id")
    long = evidence_rows(rows).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.max(at).alias("last"))
    assert sorted(long.collect()) == sorted(summed_events(shared_evidence(rows)).collect())
    assert sorted(listed_ids(kept_event_rows(rows)).collect()) == sorted(listed_shared_ids(shared_events(rows)).select("key", "log_type", "n", "ids").collect())


def test_shared_events_have_no_row_per_session_and_certificate(spark):
    events = shared_events(raw(spark, *many_certificates()))
    assert [t.count() for t in events] == [10, 20, 31]  # 10 sessions with up to 30 certificates would be 210 rows


def test_windows_share_only_their_own_certificates(spark):
    hello, cert = event("ssl", "s", uid="C1", cert_chain_fps=["F1"]), event("x509", "x", 3, uid=None, fingerprint="F1")
    first, last = raw(spark, hello), raw(spark, event("conn", "k", 5), cert)
    for sides, n in (((first, last), 2), ((raw(spark, hello, cert), last), 3), ((raw(spark, hello, cert), raw(spark, hello, cert)), 2)):
        long = kept_event_rows(sides[0]).unionByName(kept_event_rows(sides[1])).select("key", "log_type", "raw_id").distinct().count()
        assert only(summed_events(shared_events(sides[0]).union(shared_events(sides[1])))).n == long == n


def test_lists_over_certificates_are_made_once_per_set(spark):
    noisy = event("x509", "x90", 2, uid=None, fingerprint="F1", cert_subject="CN=first", ndr_noise=True, ndr_noise_type="scan", ndr_noise_reason="why")
    own = event("http", "h", 1, uid="C1", ndr_noise=True, ndr_noise_type="own", ndr_noise_reason="why")
    rows = {r.session_id: r for r in build_sessions(raw(spark, *many_certificates(), noisy, own), sections=("x509",), parts=("certificates", "facts")).collect()}
    assert rows["C1"].noise_tags == ["own", "why", "scan"] and rows["C3"].noise_tags == ["scan", "why"]
    assert len(rows["C1"].x509.subjects) == 31 and len(rows["C2"].x509.subjects) == 16 and rows["C2"].x509.subjects[0] == "CN=first"
    assert rows["C2"].x509.fingerprints == ["F1"]
