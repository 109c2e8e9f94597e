"""Queries on outputs and resource metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from variloom.operators import quality as Q
from variloom.operators import variants as V
from variloom.plans.registry import CHECK_VIEWS, query
from variloom.sources import metrics as M

CHECK_VIEWS["by_sample"] = """
select sample, objects, total_bytes, first_doc, case when total_bytes >= 1125899906842624 then 'PiB' when total_bytes >= 1099511627776 then 'TiB'
  when total_bytes >= 1073741824 then 'GiB' when total_bytes >= 1048576 then 'MiB' when total_bytes >= 1024 then 'KiB' else 'B' end as unit
 from (select split_part(path,'/',5) as sample, count(*) as objects, cast(sum(size_bytes) as bigint) as total_bytes,
  min(doc_id) as first_doc from {objects} group by 1)"""
CHECK_VIEWS["checked"] = """
select *, case when objects = 1 and unit in ('MiB', 'GiB') then 'PASSED' else 'FAILED' end as status from {by_sample}"""
CHECK_VIEWS["good_json"] = "select * from {metric_json} where json_valid(body)"
CHECK_VIEWS["typed_metrics"] = """
select event_id, step, body->>'$.ID' as "ID", cast(body->>'$.MaxResidentSetSize_KBs' as bigint) as "MaxResidentSetSize_KBs",
 cast(body->>'$.ExitStatus' as bigint) as "ExitStatus",
 cast(split_part(body->>'$.ElapsedTime_s', ':', 1) as double) * 60 + cast(split_part(body->>'$.ElapsedTime_s', ':', 2) as double) as elapsed,
 cast(rtrim(body->>'$.CPU_Percent', '%') as double) / 100 as cpu from {good_json}"""


def _status(v):
    first = v.objects.groupBy(F.split_part("path", F.lit("/"), F.lit(5)).alias("sample")).agg(F.min("doc_id").alias("first_doc"))
    return Q.output_status(v.objects).join(first, "sample")


@query("output_status", "select sample, objects, total_bytes, unit, status from {checked}")
def output_status(v):
    return Q.output_status(v.objects)


@query("output_status_strict", """
select sample, case when objects = 1 and unit = 'MiB' then 'PASSED' else 'FAILED' end as status from {by_sample}""")
def output_status_strict(v):
    return Q.output_status(v.objects, Q.STRICT_UNITS).select("sample", "status")


@query("output_status_sum", """
select sample, case when total_bytes >= 1048576 then 'PASSED' else 'FAILED' end as status from {by_sample}""")
def output_status_sum(v):
    return Q.output_status(v.objects, mode="sum").select("sample", "status")


_DONE = "select split_part(path,'/',5) as sample from {objects} where size_bytes < 500000"


@query("qa_totals", f"""
select count(*) filter (where status = 'PASSED') as passed, count(*) filter (where status = 'FAILED') as failed,
 count(*) filter (where status = 'SKIPPED') as skipped
 from (select case when sample in ({_DONE}) then 'SKIPPED' else status end as status from {{checked}})""")
def qa_totals(v):
    done = v.objects.where("size_bytes < 500000").select(F.split_part("path", F.lit("/"), F.lit(5)).alias("sample"))
    return Q.qa_totals(Q.with_skipped(Q.output_status(v.objects), done))


@query("qa_running", """
select sample, cast(sum(case when status = 'PASSED' then 1 else 0 end) over w as bigint) as passed,
 cast(sum(case when status = 'FAILED' then 1 else 0 end) over w as bigint) as failed, cast(0 as bigint) as skipped
 from {checked} window w as (order by first_doc rows between unbounded preceding and current row)""")
def qa_running(v):
    return Q.qa_running(_status(v), "first_doc").select("sample", "passed", "failed", "skipped")


@query("purge_candidates", "select case_id, trim(status) as status from {status_list} where trim(status) = 'FAILED'")
def purge_candidates(v):
    return Q.purge_candidates(v.status_list).select("case_id", F.trim("status").alias("status"))


@query("valid_chrom_files", "select * from {chrom_files} where size_bytes > 100000")
def valid_chrom_files(v):
    return V.valid_chrom_files(v.chrom_files)


@query("chrom_completeness", """
select kind, count(*) as samples, count(*) filter (where n > case when kind = 'snp' then 22 else 20 end) as complete_samples
 from (select sample, kind, count(*) filter (where size_bytes > 100000) as n from {chrom_files} group by 1, 2) group by 1""")
def chrom_completeness(v):
    return V.chrom_completeness(v.chrom_files)


METRIC_OUT = ["event_id", "step", "ID", "MaxResidentSetSize_KBs", "ExitStatus", "elapsed", "cpu"]


def metrics(v):
    return M.good_metrics(M.parse_metrics(v.metric_json))


@query("metrics_typed", "select * from {typed_metrics}")
def metrics_typed(v):
    return metrics(v).select(*METRIC_OUT)


@query("metrics_bad", "select event_id, body from {metric_json} where not json_valid(body)")
def metrics_bad(v):
    return M.bad_metrics(M.parse_metrics(v.metric_json)).select("event_id", "body")


@query("metric_summary", """
select step, count(*) as runs, count(*) filter (where "ExitStatus" <> 0) as failures, max("MaxResidentSetSize_KBs") as max_memory_kb,
 sum(elapsed) as total_elapsed, max(elapsed) as max_elapsed from {typed_metrics} group by 1""")
def metric_summary(v):
    return Q.metric_summary(metrics(v))


@query("exit_status", """select "ID", "ExitStatus" from {typed_metrics} where step = 'error'""")
def exit_status(v):
    return Q.exit_status(metrics(v), "error").select("ID", "ExitStatus")
