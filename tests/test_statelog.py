"""State logs of streams: snapshots, restarts, appends, listings, closed sessions."""

import os

import pytest
from pyspark.errors import StreamingQueryException

from variloom.operators import runstate as R
from variloom.streaming import stages as X
from variloom.streaming import statelog as L

SCHEMA = "event_id bigint, normal string, tumor string, stage int"


def files(spark, folder, count, rows_each=40, first=0):
    """``count`` files of events; pairs come again in later files, sometimes with an older event."""
    for f in range(first, first + count):
        rows = [(f * 100 + (i if f % 3 else -i), f"n{(f * 7 + i) % 60}", "t", (f + i) % 9 + 1) for i in range(rows_each)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def newest(spark, folder):
    return {tuple(r) for r in R.current_stage(spark.read.schema(SCHEMA).parquet(folder)).select("normal", "tumor", "stage", "event_id").collect()}


def held(spark, log):
    return {tuple(r) for r in log.state(spark).select("normal", "tumor", "stage", "event_id").collect()}


def test_state_equals_a_fold_of_all_events_and_reads_newer_files_only(spark, tmp_path):
    folder = str(tmp_path / "in")
    files(spark, folder, 7)
    stream = X.read_events(spark, folder, spark.createDataFrame([], SCHEMA).schema, "*.parquet", 1)
    log = L.StateLog(str(tmp_path / "log"), stream.schema, ("normal", "tumor"), "event_id", share=1e9, most=3)
    L.keep_state(stream, log).awaitTermination()
    assert held(spark, log) == newest(spark, folder)
    read = {p.split("/log/")[1].rsplit("/", 1)[0] for p in log.read(spark).inputFiles()}
    # the first delta makes a snapshot, every third one after it another
    assert sorted(os.listdir(tmp_path / "log" / "snapshots")) == ["0", "3", "6"] and read == {"snapshots/6"}
    log.expire(spark)
    assert not os.listdir(tmp_path / "log" / "deltas") and os.listdir(tmp_path / "log" / "snapshots") == ["6"]
    files(spark, folder, 2, first=7)
    L.keep_state(stream, log).awaitTermination()
    assert held(spark, log) == newest(spark, folder)
    assert {p.split("/log/")[1].rsplit("/", 1)[0] for p in log.read(spark).inputFiles()} == {"snapshots/6", "deltas/7", "deltas/8"}


def test_snapshots_follow_the_size_of_the_state(spark, tmp_path):
    log = L.StateLog(str(tmp_path / "log"), spark.createDataFrame([], SCHEMA).schema, ("normal", "tumor"), "event_id")
    many = [(i, f"n{i}", "t", 1) for i in range(20000)]
    log.write(spark.createDataFrame(many, SCHEMA), 0)
    assert log.compact(spark) and not log.compact(spark)
    log.write(spark.createDataFrame(many[:5], SCHEMA), 1)
    assert not log.compact(spark) and log.compact(spark, force=True)


def test_a_stop_between_delta_and_snapshot_changes_nothing(spark, tmp_path, monkeypatch):
    folder, path = str(tmp_path / "in"), str(tmp_path / "log")
    files(spark, folder, 5)
    stream = X.read_events(spark, folder, spark.createDataFrame([], SCHEMA).schema, "*.parquet", 1)
    log = L.StateLog(path, stream.schema, ("normal", "tumor"), "event_id", share=0)
    whole = L.StateLog.compact

    def cut_off(self, session, force=False):
        done = whole(self, session, force)
        if "2" in os.listdir(f"{path}/snapshots"):
            os.remove(f"{path}/snapshots/2/_SUCCESS")
            raise RuntimeError("stopped")
        return done

    monkeypatch.setattr(L.StateLog, "compact", cut_off)
    with pytest.raises(StreamingQueryException):
        L.keep_state(stream, log).awaitTermination()
    # the cut-off snapshot is not read, the delta is
    assert {p.split("/log/")[1].rsplit("/", 1)[0] for p in log.read(spark).inputFiles()} == {"snapshots/1", "deltas/2"}
    monkeypatch.setattr(L.StateLog, "compact", whole)
    L.keep_state(stream, log).awaitTermination()
    assert held(spark, log) == newest(spark, folder)


def test_records_are_appended_once_over_a_stop_before_the_commit(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    files(spark, folder, 4)
    stream = X.read_events(spark, folder, spark.createDataFrame([], SCHEMA).schema, "*.parquet", 1)
    log = L.StateLog(str(tmp_path / "log"), stream.schema, ("normal", "tumor"))
    whole, seen = L.StateLog.compact, []

    def stop_once(self, session, force=False):
        done = whole(self, session, True)
        seen.append(done)
        if len(seen) == 2:
            raise RuntimeError("stopped")
        return done

    monkeypatch.setattr(L.StateLog, "compact", stop_once)
    with pytest.raises(StreamingQueryException):
        L.append_first(stream, log, "event_id").awaitTermination()
    L.append_first(stream, log, "event_id").awaitTermination()
    rows = log.read(spark).collect()
    assert len(rows) == len({(r.normal, r.tumor) for r in rows}) == 60 and len(seen) == 5
    # each record is the first of its pair in the batch that brought it, and no earlier batch has the pair
    batches = sorted(rows, key=lambda r: r._batch)
    order = {n: sorted({r.event_id // 100 for r in batches if r._batch == n}) for n in {r._batch for r in batches}}
    assert all(len(v) <= 2 for v in order.values())


def test_state_of_an_empty_stream(spark, tmp_path):
    log = L.StateLog(str(tmp_path / "log"), spark.createDataFrame([], SCHEMA).schema, ("normal", "tumor"))
    assert log.state(spark).count() == 0 and not log.compact(spark)
    log.expire(spark)


def test_listings_and_counters(spark):
    state = [(i, f"c{i % 4}", "X", 1024 * i, 5, i, ("queued", "processing", "finished")[i % 3]) for i in range(20)] + [(99, "none", "X", 1, 1, 1, "processing")]
    state = spark.createDataFrame(state, "row_id bigint, case_id string, cancer_type string, tumor_size bigint, normal_size bigint, stage int, state string")
    jobs = [(i, f"/h/u/t/c{i}/x", "RUNNING", None, "n1", None) for i in range(3)]
    jobs = spark.createDataFrame(jobs, "job_id bigint, command string, job_state string, submit_time string, req_nodes string, nodes string")
    rows = R.listings(state, jobs, limit=3).collect()
    by = {name: [r for r in rows if r.listing == name] for name in ("processing", "queued", "finished", "counts")}
    assert sorted(r.row_id for r in by["processing"]) == [1, 4, 10, 13, 16]
    assert [(r.row_id, r.tumor_size) for r in sorted(by["queued"], key=lambda r: r.row_id)] == [(0, "0B"), (3, "3K"), (6, "6K")]
    assert sorted((r.row_id, r.stage) for r in by["finished"]) == [(i, i) for i in range(2, 20, 3)]
    assert {r.case_id: r.n for r in by["counts"]} == {"running": 5, "waiting_count": 7, "finished": 6}


def test_closed_sessions_come_once_and_leave_the_state(spark, tmp_path):
    folder = str(tmp_path / "in")
    for day in range(1, 6):
        rows = [(f"2024-01-{day:02d} 0{h}:{m:02d}:00", "n", "t") for h in (1, 5) for m in (0, 20, 40)]
        spark.createDataFrame(rows, "ts string, normal string, tumor string").selectExpr("cast(ts as timestamp) ts", "normal", "tumor").coalesce(1).write.mode("append").parquet(folder)
    # files in the order of time
    for k, f in enumerate(sorted((tmp_path / "in").glob("*.parquet"), key=lambda p: spark.read.parquet(str(p)).first().ts)):
        os.utime(f, (1_700_000_000 + k, 1_700_000_000 + k))
    stream = X.read_events(spark, folder, "ts timestamp, normal string, tumor string", "*.parquet", 1)
    out = str(tmp_path / "out")
    query = X.run_batches(X.closed_sessions(stream), "append", out)
    query.awaitTermination()
    got = sorted((str(r.session_start), r.n) for r in X.read_batches(spark, out).collect())
    # the session of day 4 at 5:00 can grow until 6:10; the watermark stands at 5:40
    assert got == [(f"2024-01-{day:02d} 0{h}:00:00", 3) for day in range(1, 5) for h in (1, 5)][:-1]
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 8
