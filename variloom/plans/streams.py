"""Streaming queries, checked against the same result in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from variloom.operators import runstate as R
from variloom.plans import bridge
from variloom.plans.registry import query
from variloom.plans.quality import METRIC_OUT
from variloom.plans.registry import CHECK_VIEWS
from variloom.plans.state import FINISH_SQL, PROGRESS_SQL
from variloom.session import work_path
from variloom.sources import metrics as M
from variloom.streaming import stages as X
from variloom.streaming.statelog import StateLog, append_first, keep_state


def _stream(v, view: str, table: str):
    """A bridge view over a table read as a stream."""
    source = X.read_events(v.spark, v.folder, v.table(table).schema, f"{table}.parquet", max_files=1)
    return v.spark.sql(bridge.VIEWS[view], **{table: source})


def events(v):
    return _stream(v, "stage_events", "events")


def kept(stream, keys, order=None):
    """Newest rows of a stream's keys, from its snapshot and the deltas after it."""
    log = StateLog(work_path(stream.sparkSession, "state"), stream.schema, keys, order)
    keep_state(stream, log).awaitTermination()
    return log.state(stream.sparkSession)


@query("stream_current_stage", "select normal, tumor, stage from {stage_now}")
def stream_current_stage(v):
    return kept(events(v), ("normal", "tumor"), "event_id").select("normal", "tumor", "stage")


@query("stream_counts", "select stage, count(*) as n from {stage_events} group by 1")
def stream_counts(v):
    return X.run_to_end(X.stage_counts(events(v)), "complete", "stage-counts")


@query("stream_windowed", """
select strftime(date_trunc('hour', ts), '%Y-%m-%d %H') as window_start, stage, count(*) as n from {stage_events} group by 1, 2""")
def stream_windowed(v):
    # update mode: the watermark lets go of old windows, each window's last count stands
    out = X.run_to_end(X.stage_windows(events(v)), "update", "stage-windows", ["window_start", "stage"])
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH"))


@query("stream_sessions", """
select normal, tumor, count(*) as sessions, cast(sum(n) as bigint) as events from (
 select normal, tumor, session, count(*) as n from (
  select normal, tumor, sum(cast(prev is null or ts >= prev + interval 30 minutes as int)) over (partition by normal, tumor order by ts, event_id) as session
  from (select *, lag(ts) over (partition by normal, tumor order by ts, event_id) as prev from {stage_events})) group by 1, 2, 3) group by 1, 2""")
def stream_sessions(v):
    out = X.run_to_end(X.stage_sessions(events(v)), "complete", "stage-sessions")
    return out.groupBy("normal", "tumor").agg(F.count("*").alias("sessions"), F.sum("n").alias("events"))


@query("stream_node_status", """
select node, state, jobs_requested from {node_counts}""")
def stream_node_status(v):
    jobs = kept(_stream(v, "jobs", "orders"), ("job_id",))
    return R.node_status(v.nodes, jobs).select("node", "state", "jobs_requested")


@query("stream_progress", PROGRESS_SQL)
def stream_progress(v):
    jobs = kept(_stream(v, "jobs", "orders"), ("job_id",))
    return R.progress(v.processing, jobs).select("case_id", "cancer_type", "node", "submit_time", "requested", "progress")


@query("stream_finished", FINISH_SQL)
def stream_finished(v):
    # finish records are gathered over all batches: what a sample does may not hang on how they were split
    path = X.write_to_end(events(v).where("stage = 9 and event_type <> 'view'").select("normal", "tumor"), "finished")
    return R.finish_transition(v.processing, v.finished, X.read_batches(v.spark, path).select("normal", "tumor"))


CHECK_VIEWS["state_now"] = "select * from {state_log} qualify row_number() over (partition by row_id order by seq desc) = 1"
CHECK_VIEWS["job_part"] = """
select case_id, coalesce(arg_max(nodes, job_id) filter (where nodes is not null), 'Un-assigned') as node,
 arg_max(coalesce(strftime(submit_time, '%Y-%m-%d %H:%M:%S'), 'NA'), job_id) as submit_time, arg_max(replace(req_nodes, ',', ', '), job_id) as requested
 from {cased_jobs} group by 1"""
CHECK_VIEWS["listed"] = """
select s.*, j.node, j.submit_time, j.requested, c.running||' | '||c.pending||' | '||c.failed_total as progress
 from {state_now} s join {job_part} j on s.case_id = j.case_id join {state_counts} c on s.case_id = c.case_id where state = 'processing'"""
_SIZE = """case when {c} >= 1099511627776 then cast({c} // 1099511627776 as string)||'T' when {c} >= 1073741824 then cast({c} // 1073741824 as string)||'G'
 when {c} >= 1048576 then cast({c} // 1048576 as string)||'M' when {c} >= 1024 then cast({c} // 1024 as string)||'K' else cast({c} as string)||'B' end as {c}"""
_SIZES = ", ".join(_SIZE.replace("{c}", c) for c in ("tumor_size", "normal_size"))


@query("stream_listings", f"""
select 'processing' as listing, row_id, case_id, cancer_type, null as tumor_size, null as normal_size, cast(null as int) as stage, submit_time, requested, node, progress, cast(null as bigint) as n from {{listed}}
union all select 'queued', row_id, case_id, cancer_type, {_SIZES}, null, null, null, null, null, null from (select * from {{state_now}} where state = 'queued' order by row_id limit 50)
union all select 'finished', row_id, case_id, cancer_type, {_SIZES}, stage, null, null, null, null, null from {{state_now}} where state = 'finished'
union all select 'counts', null, 'running', null, null, null, null, null, null, null, null, count(*) from {{listed}}
union all select 'counts', null, 'waiting_count', null, null, null, null, null, null, null, null, count(*) from {{state_now}} where state = 'queued'
union all select 'counts', null, 'finished', null, null, null, null, null, null, null, null, count(*) from {{state_now}} where state = 'finished'""")
def stream_listings(v):
    state = kept(_stream(v, "state_log", "events"), ("row_id",), "seq")
    jobs = kept(_stream(v, "jobs", "orders"), ("job_id",))
    return R.listings(state, jobs)


@query("stream_record_finished", """
select normal, tumor, min(event_id) as event_id from {stage_events} where stage = 9 group by 1, 2""")
def stream_record_finished(v):
    stream = events(v).where("stage = 9").select("normal", "tumor", "event_id")
    log = StateLog(work_path(v.spark, "finished"), stream.schema, ("normal", "tumor"))
    append_first(stream, log, "event_id").awaitTermination()
    return log.state(v.spark)


@query("stream_metrics", "select * from {typed_metrics}")
def stream_metrics(v):
    path = work_path(v.spark, "metrics")
    X.run_batches(_stream(v, "metric_json", "events"), "append", path, lambda batch: M.good_metrics(M.parse_metrics(batch))).awaitTermination()
    return X.read_batches(v.spark, path).select(*METRIC_OUT)


@query("stream_sessions_closed", """
select normal, tumor, min(ts) as session_start, count(*) as n from (
 select *, sum(cast(prev is null or ts >= prev + interval 30 minutes as int)) over (partition by normal, tumor order by ts, event_id) as session
  from (select *, lag(ts) over (partition by normal, tumor order by ts, event_id) as prev from {stage_events})) group by normal, tumor, session
 having max(ts) + interval 30 minutes <= (select date_trunc('millisecond', max(ts)) - interval 1 day from {stage_events})""")
def stream_sessions_closed(v):
    path = work_path(v.spark, "sessions")
    X.run_batches(X.closed_sessions(events(v)), "append", path).awaitTermination()
    return X.read_batches(v.spark, path).select("normal", "tumor", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")
