"""Stores fed by micro-batches: files read, replays, late rows, moved sessions; and the rules' look-back state."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.rules import US
from tidewatch.schemas import conform_raw
from tidewatch.streaming.incremental import Progress, SessionStore, WindowStore, run_in_parts, split_late
from tidewatch.streaming.rule_state import LookBack


def raw(spark, rows):
    """(uid, log type, second, raw id) as raw logs."""
    frame = spark.createDataFrame(rows, "uid string, log_type string, s long, raw_id string")
    shaped = frame.select("uid", "log_type", "raw_id", F.timestamp_seconds("s").alias("ts"), F.lit("sensor1").alias("sensor"), F.lit("10.1.1.1").alias("orig_h"),
                          F.lit("10.1.1.2").alias("resp_h"), F.lit(1000).alias("orig_p"), F.lit(22).alias("resp_p"), F.lit("tcp").alias("proto"))
    return conform_raw(shaped)


def test_an_upsert_reads_the_files_of_its_keys(spark, tmp_path):
    store = SessionStore(spark, f"file://{tmp_path}/s", sections=("conn",), buckets=8)
    first = raw(spark, [(f"C{i}", "conn", 100 + i, f"R{i}") for i in range(64)])
    assert store.upsert(first, 0) == {"created": 64, "updated": 0, "upserted": 64}
    second = raw(spark, [("C7", "dns", 400, "R100"), ("C7", "conn", 107, "R7"), ("new", "conn", 500, "R101")])
    assert store.upsert(second, 1) == {"created": 1, "updated": 1, "upserted": 2}
    assert len(store.sessions.files_read) <= 2 and len(store.events.files_read) <= 2
    rows = {r.key: r for r in store.sessions.read().collect()}
    assert len(rows) == 65 and rows["C7"].event_count == 2 and list(rows["C7"].log_types) == ["conn", "dns"]
    assert store.events.read().count() == 66


def test_late_rows_go_to_the_side_table_and_progress_tells_the_next_start(spark, tmp_path):
    base = f"file://{tmp_path}/l"
    parts = [[(0, "a"), (5000, "b")], [(3300, "in"), (3100, "late"), (9000, "c"), (None, "no time")], [(7300, "in"), (7100, "late")]]
    frames = [spark.createDataFrame(p, "s long, id string").select(F.timestamp_seconds("s").alias("ts"), "id") for p in parts]
    state, passed = Progress(spark, f"{base}/progress"), []
    job = split_late(f"{base}/out", state, 1800, then=lambda rows, number: passed.append((number, rows.count())))
    assert state.next_start(1800).first().start is None
    run_in_parts(spark, base, frames, job)
    job(frames[2], 2)  # the last batch once more
    rows = spark.read.parquet(f"{base}/out").withColumn("late", F.col("late").cast("boolean"))
    assert sorted((r.id, r.late) for r in rows.collect()) == [("a", False), ("b", False), ("c", False), ("in", False), ("in", False), ("late", True), ("late", True), ("no time", False)]
    assert [(r.batch, r.documents_read, r.rows_late) for r in state.read().orderBy("batch").collect()] == [(0, 2, 0), (1, 4, 1), (2, 2, 1)]
    assert passed == [(0, 2), (1, 3), (2, 1), (2, 1)]
    assert state.next_start(1800).select(F.unix_seconds("start")).first()[0] == 9000 - 1800


@pytest.mark.parametrize("distinct", [True, False])
def test_look_back_counts_as_a_scan_would(distinct):
    draw = random.Random(9)
    for _ in range(40):
        span, at, events, look = 50, 0, [], LookBack(50, distinct, [])
        for _ in range(120):
            at += draw.choice([0, 1, 3, 20, 60])
            value = str(draw.randint(0, 6)) if distinct else str(at)
            events.append((at, value))
            look.add(value, at)
            inside = [v for t, v in events if t >= at - span]
            assert look.count(at) == (len(set(inside)) if distinct else len(inside))
            if draw.random() < 0.1:  # stored and loaded again
                look = LookBack(span, distinct, [(v, us, n) for v, (us, n) in look.held.items()])
    assert US == 1_000_000


def test_a_session_that_moves_leaves_no_trace_in_its_old_window(spark, tmp_path):
    from tidewatch.operators.hardening import harden_sessions
    from tidewatch.operators.sessions import build_sessions
    sessions = lambda rows: harden_sessions(build_sessions(raw(spark, rows), sections=("conn", "dns", "http", "files", "tls", "x509", "ssh", "notice", "weird")))
    store = WindowStore(spark, f"file://{tmp_path}/w", buckets=2)
    store.rebuild(sessions([("A", "conn", 1000, "R1"), ("B", "conn", 1900, "R2")]), 0)
    assert store.behaviors.read().count() == 2
    changed = sessions([("A", "conn", 1950, "R1")])
    store.rebuild(changed, 1)
    rows = store.behaviors.read().select(F.unix_seconds("window_start").alias("w"), "quality.session_count_total").collect()
    assert [tuple(r) for r in rows] == [(1800, 2)]


def test_certificates_are_stored_once_and_known_to_later_batches(spark, tmp_path):
    """Certificates of a batch count for the sessions that show them in it; a table without rows may be written."""
    fps = lambda rows: raw(spark, rows).withColumn("cert_chain_fps", F.when(F.col("log_type") == "ssl", F.array(F.lit("F1")))).withColumn(
        "fingerprint", F.when(F.col("log_type") == "x509", F.lit("F1")))
    certs = [(None, "x509", 50 + i, f"X{i}") for i in range(5)]
    hellos = [(f"C{i}", "ssl", 100 + i, f"R{i}") for i in range(8)]
    for fixed in (False, True):
        store = SessionStore(spark, f"file://{tmp_path}/{fixed}", fps(certs) if fixed else None, sections=("conn",), buckets=2)
        store.upsert(fps([("C9", "conn", 1, "R9")]), 0)
        assert store.shown.read() is None
        store.upsert(fps(hellos + certs), 1)
        assert store.events.read().count() == 9 and store.shown.read().count() == 8  # 49 rows with certificates per session
        assert store.upsert(fps([("C1", "dns", 300, "R30")]), 2) == {"created": 0, "updated": 1, "upserted": 1}
        assert {r.key: r.event_count for r in store.sessions.read().collect()}["C1"] == 7


def test_a_finished_batch_leaves_no_scratch_tables(spark, tmp_path):
    from tidewatch.session import ensure_checkpoint_dir
    scratch = lambda: set(glob.glob(f"{ensure_checkpoint_dir(spark)}/batch*"))
    store, before = SessionStore(spark, f"file://{tmp_path}/d", sections=("conn",), buckets=2), scratch()
    store.upsert(raw(spark, [("C1", "conn", 100, "R1")]), 0)
    assert store.upsert(raw(spark, [("C1", "dns", 200, "R2"), ("C2", "dns", 201, "R3")]), 1) == {"created": 1, "updated": 1, "upserted": 2}
    assert scratch() == before and store.sessions.read().count() == 2
