"""Views that give the driver tables the shapes the operators work on.

Each view is one SQL text that Spark and DuckDB both read. ``{name}`` stands for another
view or a base table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

CASE = "'TCGA-'||lpad(cast({key} % 100 as string),2,'0')||'-'||lpad(cast({key} as string),cast(greatest(6,length(cast({key} as string))) as int),'0')"


def case_of(key: str) -> str:
    return CASE.replace("{key}", key)


VIEWS = {
    # file manifest: many files per case
    "manifest": f"""
select o_orderkey as row_id, 'gdc-'||cast(o_orderkey as string) as file_gdc_id, 'TCGA' as program_name,
 'TCGA-'||substr(c_mktsegment,1,4) as project_short_name,
 {case_of('o_custkey')}||'-'||case o_orderstatus when 'F' then '01A' when 'O' then '10A' else '11A' end||'-01D' as barcode,
 'f'||cast(o_orderkey as string)||'.bam' as file_name, cast(floor(o_totalprice*1000000) as bigint) as file_size,
 case when o_orderpriority = '1-URGENT' then 'Illumina GA' else 'Illumina HiSeq' end as platform,
 'gs://b'||cast(o_custkey % 7 as string)||'/wgs/f'||cast(o_orderkey as string)||'.bam' as file_gcs_url
 from {{orders}} join {{customer}} on o_custkey = c_custkey""",
    # aligned bases, one per row; the part decides locus, sample and kind of site
    "reads": """
select l_orderkey, l_linenumber, 'TCGA-'||p_brand as sample, case when l_linestatus='F' then 'normal' else 'tumor' end as role,
 case l_partkey % 25 when 22 then 'X' when 23 then 'Y' when 24 then 'M' else ''||cast(l_partkey % 25 + 1 as string) end as raw_chrom,
 l_partkey + 1 as pos, cast(l_quantity as int) - 1 as mapq,
 (case when l_returnflag='A' then 16 else 0 end) + (case when l_linenumber=7 then 1024 else 0 end) + (case when l_quantity=50 then 4 else 0 end) as flag,
 20 + l_linenumber as baseq, substr('ACGT', cast(l_partkey % 4 as int)+1, 1) as ref,
 case when (p_size % 5 = 0 and l_linestatus='O' and l_tax>0.045) or (p_size % 5 = 1 and l_tax>0.045)
  or (p_size % 5 = 2 and (l_linestatus='O' or l_tax>0.045)) or p_size % 5 = 3 or (p_size % 5 = 4 and l_tax>0.075)
  then substr('ACGT', cast((l_partkey+1) % 4 as int)+1, 1) else substr('ACGT', cast(l_partkey % 4 as int)+1, 1) end as base
 from {lineitem} join {part} on l_partkey = p_partkey""",
    # reference bases: 32 for each part, one after the other on its chromosome
    "reference_lines": """
select 'chr'||case p_partkey % 25 when 22 then 'X' when 23 then 'Y' when 24 then 'M' else ''||cast(p_partkey % 25 + 1 as string) end as chrom,
 cast(floor(p_partkey / 25) as bigint) * 32 as start, p_partkey, p_size,
 translate(md5(cast(p_partkey as string)), '0123456789abcdef', 'ACGTACGTACGTACGT') as bases from {part}""",
    # reads of several bases on that reference: plain, with a deletion, an insertion, clipped ends
    "long_reads": """
select 'TCGA-'||cast(p_size % 7 as string) as sample, case when l_linestatus='F' then 'normal' else 'tumor' end as role, l_orderkey, l_linenumber, chrom,
 start + 5 as pos, cast(l_quantity as int) - 1 as mapq, case when l_returnflag='A' then 16 else 0 end as flag, p_partkey, start, kind,
 case kind when 'D' then '8M2D10M' when 'I' then '8M2I10M' when 'S' then '3S17M1H' else '12M0I8M' end as cigar,
 case kind when 'D' then substr(bases, 5, 8)||substr(bases, 15, 10) when 'I' then substr(bases, 5, 8)||'GG'||substr(bases, 13, 10)
  when 'S' then 'TTT'||substr(bases, 5, 17) else substr(bases, 5, 20) end as seq
 from (select *, case when (p_size % 4 = 0 and l_linestatus='O' and l_tax>0.02) or (p_size % 4 = 1 and l_tax>0.04) then 'D'
   when (p_size % 4 = 2 and l_linestatus='O') or (p_size % 4 = 3 and l_tax>0.06) then 'I' when l_linenumber = 1 then 'S' else 'P' end as kind
  from {lineitem} join {reference_lines} on l_partkey = p_partkey)""",
    # scheduler snapshot
    "jobs": f"""
select o_orderkey as job_id, '/home/u/tcga/'||{case_of('o_custkey')}||'/j'||cast(o_orderkey as string)||'.slurm' as command,
 case o_orderkey % 10 when 0 then 'FAILED' when 1 then 'RUNNING' when 2 then 'RUNNING' when 3 then 'COMPLETED' when 4 then 'PENDING'
  when 5 then 'SUSPENDED' when 6 then 'CANCELLED' when 7 then 'TIMEOUT' when 8 then 'COMPLETING' else 'NODE_FAIL' end as job_state,
 case when o_orderkey % 17 = 0 then null else o_orderdate end as submit_time,
 'node-'||cast(o_orderkey % 40 as string)||case when o_orderkey % 3 = 0 then ',node-'||cast((o_orderkey+1) % 40 as string) else '' end as req_nodes,
 case when o_orderkey % 4 = 0 then null else 'node-'||cast(o_orderkey % 40 as string) end as nodes from {{orders}}""",
    # scheduler snapshot with all reported fields, times in epoch seconds
    "full_jobs": f"""
select o_orderkey as job_id, '/home/u/tcga/'||{case_of('o_custkey')}||'/j'||cast(o_orderkey as string)||'.slurm' as command, 'RUNNING' as job_state,
 cast(o_orderkey * 86399 as bigint) as submit_time, cast(case when o_orderkey % 3 = 0 then 0 else o_orderkey * 86400 end as bigint) as start_time,
 cast(case when o_orderkey % 7 = 0 then o_orderkey * 3 else 0 end as bigint) as suspend_time, cast(case when o_orderkey % 2 = 0 then null else o_orderkey * 90000 end as bigint) as end_time,
 cast(o_orderkey * 86398 as bigint) as eligible_time, cast(0 as bigint) as resize_time, cast(o_orderkey % 9 as bigint) as run_time, cast(o_orderkey % 60 as string)||':00' as run_time_str,
 o_orderpriority as comment, 'node-'||cast(o_orderkey % 40 as string) as req_nodes, cast(null as string) as nodes from {{orders}}""",
    # node snapshot
    "nodes": """
select 'node-'||cast(s_suppkey as string) as node, case s_nationkey % 6 when 0 then 'DOWN' when 1 then 'IDLE' when 2 then 'MIXED' when 3 then 'ALLOCATED'
  when 4 then 'UNKNOWN' else 'BOOT_FAIL' end as state, s_acctbal as free_mem, 8 as cores from {supplier}""",
    # stage events in arrival order
    "stage_events": """
select event_id, ts, 'n'||cast(user_id as string)||'.bam' as normal, 't'||cast(user_id as string)||'.bam' as tumor,
 cast(1 + event_id % 9 as int) as stage, event_type from {events}""",
    # log of sample states: a sample's last record holds
    "state_log": f"""
select event_id as seq, user_id as row_id, {case_of('user_id')} as case_id, 'C'||cast(user_id % 7 as string) as cancer_type,
 cast(user_id * 98765432 + 1000 as bigint) as tumor_size, cast(user_id * 1234567 as bigint) as normal_size, cast(1 + event_id % 9 as int) as stage,
 case event_type when 'error' then 'queued' when 'signup' then 'queued' when 'view' then 'processing' when 'click' then 'processing' else 'finished' end as state
 from {{events}}""",
    # raw metric records, every 50th cut off
    "metric_json": """
select event_id, event_type, event_type as step, '{{"ID":"s'||cast(user_id as string)||'","ElapsedTime_s":"'||cast(event_id % 7 as string)||':'||lpad(cast(event_id % 60 as string),2,'0')||'.25","CPU_Percent":"'||cast(event_id % 400 as string)||'%","MaxResidentSetSize_KBs":"'||cast(event_id*13 as string)||'","ExitStatus":"'||(case when event_type='error' then '1' else '0' end)||'"'||(case when event_id % 50 = 0 then '' else '}}' end) as body from {events}""",
    # result listing: some samples hold two objects
    "objects": """
select doc_id, 'gs://bkt/results/TCGA-'||lpad(cast(doc_id - (case when doc_id % 5 = 1 then 1 else 0 end) as string),cast(greatest(7,length(cast(doc_id as string))) as int),'0')||'/varscan_results/TCGA-'||cast(doc_id as string)||'.vcf.tar.gz' as path,
 n_chars * (case when doc_id % 2 = 0 then 65536 else 1024 end) as size_bytes from {documents}""",
    # DNA letters of the documents
    "sequences": """
select doc_id as seq_id, regexp_replace(upper(text),'[^ACGT]',''__ALL__) as seq from {documents}""",
    # verification list: a status per case, with its leading space
    "status_list": f"""
select {case_of('c_custkey')} as case_id, case when c_acctbal >= 6000 then ' PASSED' else ' FAILED' end as status
 from {{customer}} where c_acctbal >= 3000""",
    # cases in progress
    "processing_ids": f"select {case_of('c_custkey')} as case_id from {{customer}} where c_acctbal between 1000 and 2000",
    # newer locations of some files
    "new_list": """
select row_id as list_pos, barcode, 'gs://nb'||cast(row_id % 5 as string)||'/'||file_name as url
 from {manifest} where platform = 'Illumina HiSeq'""",
    # samples in progress and finished ones, named by customer; they overlap
    "processing": f"""
select c_custkey as row_id, {case_of('c_custkey')} as case_id, 'n'||cast(c_custkey as string)||'.bam' as normal_file,
 't'||cast(c_custkey as string)||'.bam' as tumor_file, substr(c_mktsegment,1,4) as cancer_type from {{customer}} where c_acctbal < 5000""",
    "finished": f"select {case_of('c_custkey')} as case_id from {{customer}} where c_acctbal > 4000",
    # per-chromosome result files with sizes
    "chrom_files": """
select 'S'||cast(l_suppkey as string) as sample, case when l_returnflag = 'R' then 'indel' else 'snp' end as kind,
 'chr'||cast(l_partkey % 25 + 1 as string) as chrom, cast(sum(floor(l_extendedprice)) as bigint) as size_bytes
 from {lineitem} group by 1, 2, 3""",
    # design parameters as entered, some out of range
    "designs": """
select p_partkey as design_id, cast(p_size * 5 as string) as min_temp, cast(p_partkey % 211 as string) as max_temp,
 case when p_partkey % 13 = 0 then 'x' else cast(p_size * 2.5 as string) end as min_recoded,
 cast(p_partkey % 1200 as string) as min_amp, cast(p_size * 22 as string) as max_amp from {part}""",
}

_NAME = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


class Views:
    """The views above over one folder of tables, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return self.table(name)
        text = VIEWS[name].replace("__ALL__", "")
        return self.spark.sql(text, **{n: getattr(self, n) for n in set(_NAME.findall(text))})


def duck(text: str) -> str:
    """A view's text for DuckDB."""
    return _NAME.sub(r"\1", text).replace("{{", "{").replace("}}", "}").replace("__ALL__", ",'g'")
