"""Queries on run state: jobs, nodes, queue, stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from variloom.functions import labels as L
from variloom.operators import cohort as C
from variloom.operators import ordering as O
from variloom.operators import runstate as R
from variloom.plans.cohort import ids, pairs, queued
from variloom.plans.registry import CHECK_VIEWS, query
from variloom.sinks.files import to_json_rows

_OTHER = ", ".join(f"'{s}'" for s in R.JOB_STATES)
_COUNTS = ", ".join(f"count(*) filter (where job_state = '{s}') as {s.lower()}" for s in R.JOB_STATES)
CHECK_VIEWS["cased_jobs"] = "select *, split_part(command,'/',5) as case_id from {jobs}"
CHECK_VIEWS["state_counts"] = f"""
select case_id, {_COUNTS}, count(*) filter (where job_state not in ({_OTHER})) as other,
 count(*) filter (where job_state in ('FAILED','SUSPENDED','CANCELLED','TIMEOUT')) as failed_total
 from {{cased_jobs}} group by case_id"""
CHECK_VIEWS["asked"] = "select unnest(string_split(req_nodes, ',')) as node from {jobs}"
CHECK_VIEWS["node_counts"] = """
select n.node, n.state, n.free_mem, n.cores, coalesce(c, 0) as jobs_requested from {nodes} n
 left join (select node, count(*) as c from {asked} group by 1) a on n.node = a.node"""
CHECK_VIEWS["stage_now"] = """
select normal, tumor, arg_max(stage, event_id) as stage, max(event_id) as event_id from {stage_events} group by 1, 2"""

_LABEL = "case " + " ".join(
    "when state in ({}) then '{}'".format(", ".join(f"'{s}'" for s in states), name)
    for name, states in L.NODE_LABELS.items()) + " else 'secondary' end"


@query("job_state_counts", "select * from {state_counts}")
def job_state_counts(v):
    return R.job_state_counts(v.jobs)


PROGRESS_SQL = """
select p.case_id, p.cancer_type, coalesce(j.node, 'Un-assigned') as node, j.submit_time, j.requested,
 s.running||' | '||s.pending||' | '||s.failed_total as progress
 from {processing} p join {state_counts} s on p.case_id = s.case_id join (
  select case_id, arg_max(coalesce(strftime(submit_time, '%Y-%m-%d %H:%M:%S'), 'NA'), job_id) as submit_time,
   arg_max(nodes, job_id) filter (where nodes is not null) as node,
   arg_max(replace(req_nodes, ',', ', '), job_id) as requested from {cased_jobs} group by 1) j on p.case_id = j.case_id"""


@query("progress", PROGRESS_SQL)
def progress(v):
    return R.progress(v.processing, v.jobs).select("case_id", "cancer_type", "node", "submit_time", "requested", "progress")


@query("node_status", f"select *, {_LABEL} as label from {{node_counts}}")
def node_status(v):
    return R.node_status(v.nodes, v.jobs)


@query("node_status_named", f"select *, {_LABEL} as label from {{node_counts}} where node in ('node-1', 'node-3')")
def node_status_named(v):
    return R.node_status(v.nodes, v.jobs, ["node-1", "node-3"])


@query("least_loaded", """
select node, jobs_requested from {node_counts} where state not in ('DOWN', 'DOWN*') order by jobs_requested, node limit 1""")
def least_loaded(v):
    return R.least_loaded(v.nodes, v.jobs).select("node", "jobs_requested")


@query("jobs_by_case", """
select case_id, job_id // 1000 as page, count(*) as jobs, string_agg(job_id||'='||job_state||'@'||coalesce(nodes,'-'), ';' order by job_id) as listing
 from {cased_jobs} group by 1, 2""")
def jobs_by_case(v):
    nested = R.jobs_by_case(v.jobs)
    shown = F.transform(F.array_sort(F.map_entries("jobs")), lambda e: F.concat(
        e["key"].cast("string"), F.lit("="), e["value"]["job_state"], F.lit("@"), F.coalesce(e["value"]["nodes"], F.lit("-"))))
    return nested.select("case_id", "page", F.size("jobs").cast("bigint").alias("jobs"), F.array_join(shown, ";").alias("listing"))


_TIMES = ", ".join(f"case when coalesce({c}, 0) = 0 then 'NA' else strftime(make_timestamp({c} * 1000000), '%a %b %d %H:%M:%S %Y') end as {c}" for c in R.TIME_FIELDS)


@query("job_details", f"""
select job_id, split_part(command, '/', 5) as case_id, {_TIMES}, run_time, run_time_str, comment, req_nodes from {{full_jobs}}""")
def job_details(v):
    return R.project_jobs(v.full_jobs).select(
        "job_id", "case_id", *R.TIME_FIELDS, "run_time", "run_time_str", "comment", F.array_join("req_nodes", ",").alias("req_nodes"))


@query("manager_counts", """
select (select count(*) from {pairs} where case_id in (select case_id from {passed_ids})) as phase1_finished,
 (select count(*) from {state} where state = 'queued') as waiting_count,
 cast(0 as bigint) as running, (select count(*) from {state} where state = 'finished') as finished""")
def manager_counts(v):
    done = C.route(pairs(v), ids(v, "PASSED"), ids(v, "FAILED")).finished
    state = C.seed_state(pairs(v), ids(v, "PASSED"), ids(v, "FAILED"), v.processing_ids)
    return R.manager_counts(done, state)


_QUEUE = "select row_id, case_id, total_size from (select *, cast(regexp_extract(tumor_file, '[0-9]+') as bigint) as row_id from {queued})"


def _queue(v):
    return queued(v).select(F.regexp_extract("tumor_file", "[0-9]+", 0).cast("bigint").alias("row_id"), "case_id", "total_size")


@query("queue_preview", f"""
select row_id, case_id, (select count(*) from {{queued}}) > 50 as more_hidden from ({_QUEUE}) order by row_id limit 50""")
def queue_preview(v):
    return R.queue_preview(_queue(v), "row_id").select("row_id", "case_id", "more_hidden")


@query("take_queue", """
select case_id, max(row_id) as row_id from (select case_id, row_id from {parsed} order by row_id limit 100) group by 1""")
def take_queue(v):
    from variloom.functions.barcode import parse_barcode

    return R.take_queue(parse_barcode(v.manifest), 100, "row_id").select("case_id", "row_id")


_BATCH = f"select case_id from ({_QUEUE}) order by row_id limit 100"


@query("submit_batch", f"""
select case_id, 'queued' as from_state, 'processing' as to_state from ({_BATCH})
 where case_id in (select case_id from {{failed_ids}})""")
def submit_batch(v):
    return R.submit_batch(_queue(v), 100, ids(v, "FAILED"), "row_id")


@query("submit_batch_parity", f"""
select case_id, 'queued' as from_state,
 case when case_id in (select case_id from {{failed_ids}}) then 'processing' end as to_state from ({_BATCH})""")
def submit_batch_parity(v):
    return R.submit_batch(_queue(v), 100, ids(v, "FAILED"), "row_id", "parity")


@query("submit_case", f"""
select distinct case_id, 'queued' as from_state, 'processing' as to_state from {{queued}}
 where case_id = (select case_id from ({_QUEUE}) order by row_id limit 1)""")
def submit_case(v):
    queue = _queue(v)
    first = queue.orderBy("row_id").select("case_id").first()
    return R.submit_case(queue, first.case_id if first else "", True)


#: Finish records: events of the last stage that say more than a look.
CHECK_VIEWS["finish_records"] = "select distinct normal, tumor from {stage_events} where stage = 9 and event_type <> 'view'"


def finish_records(v):
    return R.by_stage(v.stage_events).where("event_type <> 'view'").select("normal", "tumor")


FINISH_SQL = """
select row_id, p.case_id, normal_file, tumor_file, 'processing' as from_state, 'finished' as to_state,
 p.case_id not in (select case_id from {finished}) and row_id = min(row_id) over (partition by p.case_id) as inserted
 from {processing} p join {finish_records} e on e.normal = p.normal_file and e.tumor = p.tumor_file"""


@query("finish_transition", FINISH_SQL)
def finish_transition(v):
    return R.finish_transition(v.processing, v.finished, finish_records(v))


@query("finish_running", """
select s.normal, s.tumor, stage, min(event_id) as event_id from {stage_events} s join {finish_records} e on e.normal = s.normal and e.tumor = s.tumor
 group by 1, 2, 3""")
def finish_running(v):
    return R.finish_running(R.register_running(v.stage_events), finish_records(v)).select("normal", "tumor", "stage", "event_id")


@query("register_running", "select normal, tumor, stage, min(event_id) as event_id from {stage_events} group by 1, 2, 3")
def register_running(v):
    return R.register_running(v.stage_events)


@query("current_stage", "select * from {stage_now}")
def current_stage(v):
    return R.current_stage(v.stage_events)


@query("stage_filter", "select normal, tumor, stage from {stage_now} where stage = 9")
def stage_filter(v):
    return R.by_stage(R.current_stage(v.stage_events)).select("normal", "tumor", "stage")


@query("stage_unfinished", "select normal, tumor, stage from {stage_now} where stage < 9")
def stage_unfinished(v):
    return R.by_stage(R.current_stage(v.stage_events), "<").select("normal", "tumor", "stage")


@query("mirror_stage", """
select p.row_id, p.case_id, s.stage from {processing} p left join {stage_now} s on s.normal = p.normal_file and s.tumor = p.tumor_file""")
def mirror_stage(v):
    return R.mirror_stage(v.processing, R.current_stage(v.stage_events)).select("row_id", "case_id", "stage")


@query("record_finished", """
select normal, tumor, min(event_id) as event_id from {stage_events} where stage = 9 group by 1, 2""")
def record_finished(v):
    # finished records are appended once per pair of files
    ended = R.by_stage(v.stage_events)
    return O.first_per_key(ended, ["normal", "tumor"], "event_id").select("normal", "tumor", "event_id")


@query("reset_state", """
select event_id, stage from {stage_events} where event_type not in ('view', 'error')""")
def reset_state(v):
    return R.reset_rows(v.stage_events, ["view", "error"], "event_type").select("event_id", "stage")


@query("human_sizes", """
select row_id, case when file_size >= 1125899906842624 then cast(file_size // 1125899906842624 as string)||'P'
 when file_size >= 1099511627776 then cast(file_size // 1099511627776 as string)||'T'
 when file_size >= 1073741824 then cast(file_size // 1073741824 as string)||'G'
 when file_size >= 1048576 then cast(file_size // 1048576 as string)||'M'
 when file_size >= 1024 then cast(file_size // 1024 as string)||'K' else cast(file_size as string)||'B' end as size_text
 from {manifest}""")
def human_sizes(v):
    return v.manifest.select("row_id", L.human_size(F.col("file_size")).alias("size_text"))


@query("epoch_labels", """
select job_id, coalesce(strftime(submit_time, '%a %b %d %H:%M:%S %Y'), 'NA') as submitted from {jobs}""")
def epoch_labels(v):
    seconds = F.coalesce(F.unix_seconds(F.col("submit_time").cast("timestamp")), F.lit(0))
    return v.jobs.select("job_id", L.format_epoch(seconds).alias("submitted"))


@query("json_rows", """
select '{{"node":"'||node||'","state":"'||state||'","cores":'||cores||'}}' as json from {nodes}""")
def json_rows(v):
    return to_json_rows(v.nodes.select("node", "state", "cores"))


@query("scan_table", "select * from {processing}")
def scan_table(v):
    from variloom.sources.files import scan_table as scan

    v.processing.createOrReplaceTempView("processing")
    return scan(v.spark, "processing", [*R.RUN_TABLES, *R.METRIC_TABLES])
