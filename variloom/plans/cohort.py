"""Queries on the manifest: parsing, pairing, routing, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from variloom.functions import barcode as B
from variloom.operators import cohort as C
from variloom.operators import ordering as O
from variloom.operators import runstate as R
from variloom.plans.registry import CHECK_VIEWS, query

CASE_SQL = "split_part({c},'-',1)||'-'||split_part({c},'-',2)||'-'||split_part({c},'-',3)"
KEY_SQL = CASE_SQL + "||'-'||split_part({c},'-',4)"


def _case(col: str) -> str:
    return CASE_SQL.replace("{c}", col)


def _key(col: str) -> str:
    return KEY_SQL.replace("{c}", col)


CHECK_VIEWS["parsed"] = f"""
select *, {_case('barcode')} as case_id, {_key('barcode')} as sample_key, substr(split_part(barcode,'-',4),1,2) as type_code,
 case when cast(substr(split_part(barcode,'-',4),1,2) as int) < 10 then 'tumor' else 'normal' end as role,
 split_part(project_short_name,'-',2) as cancer_type from {{manifest}}"""

_SIDE = ", ".join(
    f"arg_min({src}, row_id) filter (where role = '{side}') as {side}_{dst}"
    for side in C.SIDES for dst, src in C.SIDE_FIELDS.items())
CHECK_VIEWS["pairs"] = f"""
select *, tumor_file_size + normal_file_size as total_size from (
 select case_id, arg_min(cancer_type, row_id) as cancer_type, {_SIDE} from {{parsed}} group by case_id)
 where tumor_barcode is not null and normal_barcode is not null"""

_ADJ = ", ".join(
    f"arg_max({src}, row_no) filter (where role = '{side}') as {side}_{dst}"
    for side in C.SIDES for dst, src in C.SIDE_FIELDS.items())
CHECK_VIEWS["adjacent"] = f"""
select *, coalesce(tumor_file_size,0) + coalesce(normal_file_size,0) as total_size from (
 select (row_no - 1) // 2 as "index", arg_min(case_id, row_no) as case_id, arg_min(cancer_type, row_no) as cancer_type, {_ADJ}
 from (select *, row_number() over (order by row_id) as row_no from {{parsed}}) group by 1)"""
CHECK_VIEWS["passed_ids"] = "select case_id from {status_list} where trim(status) = 'PASSED'"
CHECK_VIEWS["failed_ids"] = "select case_id from {status_list} where trim(status) = 'FAILED'"
CHECK_VIEWS["to_run"] = "select * from {pairs} where case_id not in (select case_id from {passed_ids})"
CHECK_VIEWS["queued"] = "select * from {to_run} where case_id not in (select case_id from {processing_ids})"
CHECK_VIEWS["state"] = """
select case_id, total_size, 'finished' as state from {pairs} where case_id in (select case_id from {passed_ids})
union all select case_id, total_size, 'failed' from {to_run} where case_id in (select case_id from {failed_ids})
union all select case_id, total_size, 'queued' from {queued}"""


def pairs(v) -> DataFrame:
    return C.pair_by_case(v.manifest, "row_id")


def ids(v, status: str) -> DataFrame:
    return v.status_list.where(F.trim("status") == status).select("case_id")


def routed(v) -> C.Routed:
    return C.route(pairs(v), ids(v, "PASSED"), ids(v, "FAILED"))


def queued(v) -> DataFrame:
    return C.rebuild_queue(routed(v).to_run, v.processing_ids)


PAIR_OUT = ["case_id", "cancer_type", "tumor_barcode", "normal_barcode", "tumor_file", "normal_file", "total_size"]
PAIR_LIST = ", ".join(PAIR_OUT)


@query("cohort_summary", """
select cancer_type, count(*) as n, cast(sum(total_size) as bigint) as total_size from {pairs} group by cancer_type""")
def cohort_summary(v):
    return pairs(v).groupBy("cancer_type").agg(F.count("*").alias("n"), F.sum("total_size").alias("total_size"))


@query("barcode_fields", """
select row_id, case_id, sample_key, type_code, role, cancer_type,
 'gs://'||split_part(file_gcs_url,'/',3) as bucket from {parsed}""")
def barcode_fields(v):
    return B.parse_barcode(v.manifest).select(
        "row_id", "case_id", "sample_key", "type_code", "role",
        B.cancer_type(F.col("project_short_name")).alias("cancer_type"), B.bucket_of(F.col("file_gcs_url")).alias("bucket"))


@query("case_names", f"""
select job_id, split_part(command,'/',5) as case_id, {_case("split_part(command,'/',5)||'-extra.bam'")} as file_case from {{jobs}}""")
def case_names(v):
    # the case folder of a job, and the case of a file named after it
    case = B.case_from_command(F.col("command"))
    return v.jobs.select("job_id", case.alias("case_id"),
                         B.case_from_file(F.concat(case, F.lit("-extra.bam"))).alias("file_case"))


@query("find_case", "select job_id, job_state from {jobs} where split_part(command,'/',5) = 'TCGA-07-000007'")
def find_case(v):
    return C.find_case(R.project_jobs(v.jobs), "TCGA-07-000007").select("job_id", "job_state")


@query("pair_adjacent", 'select cast("index" as bigint) as pair_index, ' + PAIR_LIST + " from {adjacent}")
def pair_adjacent(v):
    return C.pair_adjacent(v.manifest, "row_id").select(F.col("index").alias("pair_index"), *PAIR_OUT)


@query("pair_mismatches", f"""
select cast("index" as bigint) as pair_index, tumor_barcode, normal_barcode from {{adjacent}}
 where tumor_barcode is null or normal_barcode is null or {_case('tumor_barcode')} <> {_case('normal_barcode')}""")
def pair_mismatches(v):
    return C.pair_mismatches(C.pair_adjacent(v.manifest, "row_id")).select(
        F.col("index").alias("pair_index"), "tumor_barcode", "normal_barcode")


@query("pair_by_case", "select " + PAIR_LIST + " from {pairs}")
def pair_by_case(v):
    return pairs(v).select(*PAIR_OUT)


@query("pair_each_tumor", """
select t.case_id, t.file_name as tumor_file, n.normal_file from {parsed} t
 join (select case_id, arg_min(file_name, row_id) as normal_file from {parsed} where role = 'normal' group by 1) n
 on t.case_id = n.case_id where t.role = 'tumor'""")
def pair_each_tumor(v):
    return C.pair_by_case(v.manifest, "row_id", "each").select("case_id", "tumor_file", "normal_file")


@query("route_finished", "select " + PAIR_LIST + " from {pairs} where case_id in (select case_id from {passed_ids})")
def route_finished(v):
    return routed(v).finished.select(*PAIR_OUT)


@query("route_failed", "select " + PAIR_LIST + " from {to_run} where case_id in (select case_id from {failed_ids})")
def route_failed(v):
    return routed(v).failed.select(*PAIR_OUT)


@query("route_to_run", "select " + PAIR_LIST + " from {to_run}")
def route_to_run(v):
    return routed(v).to_run.select(*PAIR_OUT)


@query("route_without_failed", """
select case_id, total_size from {to_run} where case_id not in (select case_id from {failed_ids})""")
def route_without_failed(v):
    return C.route(pairs(v), ids(v, "PASSED"), ids(v, "FAILED"), exclude_failed=True).to_run.select("case_id", "total_size")


@query("queue_rebuild", "select " + PAIR_LIST + " from {queued}")
def queue_rebuild(v):
    return queued(v).select(*PAIR_OUT)


@query("seed_state", "select case_id, total_size, state from {state}")
def seed_state(v):
    return C.seed_state(pairs(v), ids(v, "PASSED"), ids(v, "FAILED"), v.processing_ids).select(
        "case_id", "total_size", "state")


@query("lookup_cancer_strict", """
select p.case_id, d.code from {pairs} p join (select case_id, arg_max(cancer_type, row_id) as code from {parsed} group by 1) d
 on p.case_id = d.case_id""")
def lookup_cancer_strict(v):
    dim = B.parse_barcode(v.manifest).select(
        "case_id", "row_id", B.cancer_type(F.col("project_short_name")).alias("code"))
    return C.lookup_strict(pairs(v).select("case_id"), dim, "case_id", "code", "row_id")


_FIRST_URL = f"select {_key('barcode')} as sample_key, arg_min(url, list_pos) as url from {{new_list}} group by 1"


@query("lookup_url_first", f"""
select p.case_id, coalesce(t.url, '') as new_tumor_url, coalesce(n.url, '') as new_normal_url from {{pairs}} p
 left join ({_FIRST_URL}) t on {_key('p.tumor_barcode')} = t.sample_key
 left join ({_FIRST_URL}) n on {_key('p.normal_barcode')} = n.sample_key""")
def lookup_url_first(v):
    dim = v.new_list.withColumn("sample_key", B.sample_key(F.col("barcode")))
    return C.lookup_first(pairs(v), dim, "list_pos").select("case_id", "new_tumor_url", "new_normal_url")


CHECK_VIEWS["first_new"] = "select barcode, arg_min(url, list_pos) as url, min(list_pos) as list_pos from {new_list} group by 1"
CHECK_VIEWS["repaired"] = """
select p.case_id, p.tumor_file_url, p.normal_file_url, t.url as tumor_url, n.url as normal_url, t.list_pos as tumor_at, n.list_pos as normal_at
 from {pairs} p left join {first_new} t on p.tumor_barcode = t.barcode left join {first_new} n on p.normal_barcode = n.barcode"""


@query("repair_urls", """
select case_id, coalesce(tumor_url, tumor_file_url) as tumor_file_url, coalesce(normal_url, normal_file_url) as normal_file_url
 from {repaired}""")
def repair_urls(v):
    return C.repair_urls(pairs(v), v.new_list, "list_pos").select("case_id", "tumor_file_url", "normal_file_url")


@query("repair_urls_parity", """
select case_id,
 case when tumor_url is not null and (normal_at is null or tumor_at <= normal_at) then tumor_url else tumor_file_url end as tumor_file_url,
 case when normal_url is not null and (tumor_at is null or normal_at < tumor_at) then normal_url else normal_file_url end as normal_file_url
 from {repaired}""")
def repair_urls_parity(v):
    return C.repair_urls(pairs(v), v.new_list, "list_pos", "parity").select("case_id", "tumor_file_url", "normal_file_url")


@query("bucket_counts", """
select 'gs://'||split_part(url,'/',3) as bucket, count(*) as n from (
 select tumor_url as url from {repaired} union all select normal_url from {repaired}) where url is not null group by 1""")
def bucket_counts(v):
    return C.count_by_bucket(C.repair_urls(pairs(v), v.new_list, "list_pos"))


@query("count_by_cancer", """
select coalesce(c.code, p.cancer_type) as cancer_type, coalesce(n, 0) as n from (values ('AUTO'), ('BUIL'), ('GBM')) c(code)
 full join (select cancer_type, count(*) as n from {pairs} group by 1) p on c.code = p.cancer_type""")
def count_by_cancer(v):
    return C.count_by_cancer(pairs(v), ["AUTO", "BUIL", "GBM"])


@query("contains_join", """
select j.job_id, n.node from {jobs} j join {nodes} n on contains(j.req_nodes, n.node)""")
def contains_join(v):
    lines = v.jobs.select("job_id", F.col("req_nodes").alias("line"))
    return C.contains_join(lines, v.nodes.select("node"), "line", "node").select("job_id", "node")


@query("finished_lines_by_status", """
select p.case_id, trim(s.status) as status, count(*) as n from {parsed} p join {status_list} s
 on contains(p.barcode, s.case_id) group by 1, 2""")
def finished_lines_by_status(v):
    lines = v.manifest.select("row_id", F.col("barcode").alias("line"))
    found = C.contains_join(lines, v.status_list)
    return found.groupBy("case_id", F.trim("status").alias("status")).agg(F.count("*").alias("n"))


_CHROMS = ", ".join(f"('{c}')" for c in C.CHROMOSOMES)


@query("work_units", f"""
select case_id, chrom||'.fa' as reference, regexp_replace(tumor_file,'\\.[^.]*$','')||'.REF_'||chrom||'.bam' as tumor_ref_file,
 regexp_replace(normal_file,'\\.[^.]*$','')||'.REF_'||chrom||'.bam' as normal_ref_file
 from {{pairs}} cross join (values {_CHROMS}) c(chrom)""")
def work_units(v):
    return C.expand_units(pairs(v)).select("case_id", "reference", "tumor_ref_file", "normal_ref_file")


@query("pending_samples", """
select case_id from {pairs} where case_id not in (select case_id from {passed_ids})""")
def pending_samples(v):
    return C.pending_samples(pairs(v).select("case_id"), ids(v, "PASSED"), "case_id")


@query("numbered_queue", """
select row_number() over (order by row_id) as row_no, row_id, barcode from {manifest}""")
def numbered_queue(v):
    return O.numbered(v.manifest.select("row_id", "barcode"), "row_id")


@query("first_last_dup", """
select case_id, arg_min(file_name, row_id) as first_file, arg_max(file_name, row_id) as last_file from {parsed} group by 1""")
def first_last_dup(v):
    files = B.parse_barcode(v.manifest).select("case_id", "row_id", "file_name")
    return O.first_and_last(files, "case_id", "row_id", "file_name")


@query("insert_ignore", """
select case_id, arg_min(file_name, row_id) as file_name from {parsed}
 where case_id not in (select case_id from {finished}) group by 1""")
def insert_ignore(v):
    new = B.parse_barcode(v.manifest).select("case_id", "row_id", "file_name")
    return O.insert_ignore(v.finished, new, "case_id", "row_id").select("case_id", "file_name")
