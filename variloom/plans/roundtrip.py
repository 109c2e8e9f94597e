"""Queries that write a view in a file format and read it back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window, functions as F

from variloom.operators import cohort as C
from variloom.operators import quality as Q
from variloom.operators import reads as G
from variloom.operators import somatic as P
from variloom.operators import variants as V
from variloom.plans import genome
from variloom.plans.quality import METRIC_OUT, metrics
from variloom.plans.registry import CHECK_VIEWS, query
from variloom.session import work_path
from variloom.sinks import files as K
from variloom.sources import files as S
from variloom.sources import genomics as B


@query("rt_manifest", "select * exclude (row_id) from {manifest}")
def rt_manifest(v):
    path = work_path(v.spark, "manifest")
    v.manifest.drop("row_id").write.option("header", True).csv(path)
    return S.read_manifest(v.spark, path)


_RT_PAIR = ["case_id", "tumor_barcode", "tumor_file_size", "normal_barcode", "normal_file_url", "cancer_type", "total_size"]


@query("rt_pairs", f'select cast("index" as bigint) as pair_index, {", ".join(_RT_PAIR)} from {{adjacent}}')
def rt_pairs(v):
    path = work_path(v.spark, "pairs")
    K.write_pairs(C.pair_adjacent(v.manifest, "row_id"), path)
    return S.read_pairs(v.spark, path).select(F.col("index").alias("pair_index"), *_RT_PAIR)


@query("rt_todo", """
select case when total_size > 300000000000 then 'BLACK' else 'WHITE' end as cohort, cancer_type as cancer, case_id, total_size from {pairs}""")
def rt_todo(v):
    root = work_path(v.spark, "todo")
    numbered = C.pair_by_case(v.manifest, "row_id").withColumn("index", F.lit(1))
    large = F.col("total_size") > 300_000_000_000
    rows = C.write_ready(numbered.withColumn("cohort", F.when(large, "BLACK").otherwise("WHITE")), "cohort")
    K.write_todo(rows.withColumns({"u1": F.lit("gs://x"), "u2": F.lit("gs://y")}), root)
    return S.read_todo(v.spark, root).select("cohort", "cancer", "case_id", "total_size")


@query("rt_ids", "select case_id from {finished}")
def rt_ids(v):
    path = work_path(v.spark, "ids")
    # each id is followed by a blank line; a second list does not exist
    v.finished.select(F.concat("case_id", F.lit("\n")).alias("value")).write.text(path)
    return S.read_ids(v.spark, path).unionByName(S.read_ids(v.spark, path + "-missing"))


@query("rt_status", "select case_id, trim(status) as status from {status_list}")
def rt_status(v):
    path = work_path(v.spark, "status")
    v.status_list.select(F.concat_ws(",", "case_id", "status").alias("value")).write.text(path)
    return S.read_status(v.spark, path)


@query("rt_json", "select node, state, cores from {nodes}")
def rt_json(v):
    path = work_path(v.spark, "json")
    K.write_json_records(v.nodes.select("node", "state", "cores"), path)
    return S.read_json_records(v.spark, path, "node string, state string, cores int")


@query("rt_dict", "select cancer_type as code, count(*) as n from {pairs} group by 1")
def rt_dict(v):
    path = work_path(v.spark, "dict")
    counts = C.count_by_cancer(C.pair_by_case(v.manifest, "row_id"), None)
    # one entry per cancer code
    entry = F.concat(F.lit("'"), F.col("cancer_type"), F.lit("': "), F.col("n").cast("string"))
    line = F.concat(F.lit("{'disease_code': 1, "), F.array_join(F.collect_list(entry), ", "), F.lit("}"))
    counts.agg(line.alias("value")).write.text(path)
    return S.read_count_dict(v.spark, path)


@query("rt_sam", """
select chrom, role, count(*) as n, cast(sum(pos) as bigint) as pos_sum, cast(sum(flag) as bigint) as flag_sum, min(base) as min_base
 from {named_reads} group by 1, 2""")
def rt_sam(v):
    path = work_path(v.spark, "sam")
    reads = v.reads
    line = F.concat_ws("\t", F.concat("role", F.lit(":"), F.col("l_orderkey").cast("string")), F.col("flag").cast("string"), "raw_chrom",
                       F.col("pos").cast("string"), F.col("mapq").cast("string"), F.lit("1M"), F.lit("*"), F.lit("0"),
                       F.lit("0"), "base", F.chr(F.col("baseq") + 33))
    head = reads.select(F.concat(F.lit("@SQ\tSN:"), "raw_chrom", F.lit("\tLN:1000")).alias("value")).distinct()
    head.unionByName(reads.select(line.alias("value"))).write.text(path)
    header, back = B.read_sam(v.spark, path)
    known = G.reheader(header.where("tag = 'SQ'")).select("raw_chrom", "chrom")
    # counted by bases first: the least text of a group needs all its rows sorted, of few different ones it does not
    by_seq = back.join(known, "raw_chrom").groupBy("chrom", F.split_part("qname", F.lit(":"), F.lit(1)).alias("role"), "seq").agg(
        F.count("*").alias("n"), F.sum("pos").alias("pos_sum"), F.sum("flag").alias("flag_sum"))
    return by_seq.groupBy("chrom", "role").agg(
        F.sum("n").alias("n"), F.sum("pos_sum").alias("pos_sum"), F.sum("flag_sum").cast("bigint").alias("flag_sum"), F.min("seq").alias("min_base"))


@query("rt_sam_pileup", "select * exclude (ref) from {piled}")
def rt_sam_pileup(v):
    # from alignment text with CIGAR strings to the same pileup
    path = work_path(v.spark, "sam")
    reads = v.reads
    name = F.concat_ws(":", "sample", "role", F.col("l_orderkey").cast("string"))
    reads.select(F.concat_ws("\t", name, F.col("flag").cast("string"), "raw_chrom", F.col("pos").cast("string"),
                             F.col("mapq").cast("string"), F.lit("1M"), F.lit("*"), F.lit("0"), F.lit("0"), "base",
                             F.chr(F.col("baseq") + 33)).alias("value")).write.text(path)
    _, back = B.read_sam(v.spark, path)
    parts = F.split("qname", ":")
    told = G.reheader(back).withColumns({"sample": F.get(parts, F.lit(0)), "role": F.get(parts, F.lit(1))})
    return P.pileup(P.expand_alignment(G.usable_reads(told)))


@query("rt_vcf", """
select sample, kind, chrom, pos, ref, alt, n_alt, t_alt, status, hc from {routed_calls}""")
def rt_vcf(v):
    path = work_path(v.spark, "vcf")
    K.publish_vcf(V.vcf_lines(genome.routed(v)), path)
    calls = P.process_somatic(V.calls_from_vcf(B.read_vcf(v.spark, path)))
    return calls.select("sample", "kind", "chrom", "pos", "ref", "alt", "n_alt", "t_alt", "status", "hc")


@query("rt_vcf_order", """
select sample, kind, count(*) as records, cast(1 as bigint) as headers, cast(0 as bigint) as misplaced from {routed_calls} group by 1, 2""")
def rt_vcf_order(v):
    # lines in file order: the header first and once, then records in order of name and position
    path = work_path(v.spark, "vcf")
    K.publish_vcf(V.vcf_lines(genome.routed(v)), path)
    lines = v.spark.read.text(path).select(
        "sample", "kind", "value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"))
    field = F.split("value", "\t")
    place = F.when(F.col("value").startswith("#"), F.struct(F.lit(0).alias("body"), F.lit("").alias("chrom"), F.lit(0).cast("bigint").alias("pos"))).otherwise(
        F.struct(F.lit(1).alias("body"), F.get(field, F.lit(0)).alias("chrom"), F.get(field, F.lit(1)).try_cast("bigint").alias("pos")))
    before = F.lag("place").over(Window.partitionBy("sample", "kind").orderBy("file", "at"))
    placed = lines.withColumn("place", place).withColumn("late", (before > F.col("place")).cast("int"))
    return placed.groupBy("sample", "kind").agg(
        F.count_if(F.col("place.body") == 1).alias("records"),
        F.count_if(F.col("value").startswith("##fileformat")).alias("headers"), F.coalesce(F.sum("late"), F.lit(0)).alias("misplaced"))


CHECK_VIEWS["fasta"] = """
select 'chr'||(seq_id % 25 + 1) as chrom, seq_id, i, substr(seq, cast(60 * i + 1 as int), 60) as bases from (
 select seq_id, seq, unnest(range((length(seq) + 59) // 60)) as i from {sequences})"""


@query("rt_fasta", """
select chrom, cast(sum(length(bases)) over (partition by chrom order by seq_id, i rows between unbounded preceding and current row) as bigint)
 - length(bases) as start, bases from {fasta}""")
def rt_fasta(v):
    path = work_path(v.spark, "fasta")
    lines = v.sequences.select(
        F.concat(F.lit("chr"), (F.col("seq_id") % 25 + 1).cast("string")).alias("chrom"), "seq_id",
        F.posexplode(F.regexp_extract_all("seq", F.lit("(.{1,60})"), F.lit(1))).alias("i", "value"))
    ordered = lines.repartitionByRange("chrom", "seq_id", "i").sortWithinPartitions("chrom", "seq_id", "i")
    ordered.select("chrom", "value").write.partitionBy("chrom").text(path)
    return B.read_reference(v.spark, path)


@query("rt_reference_blocks", """
select chrom, b as block, substr(whole, cast(b * 1000 + 1 as int), 1200) as bases from (
 select chrom, whole, unnest(range((length(whole) + 999) // 1000)) as b from (
  select chrom, string_agg(bases, '' order by seq_id, i) as whole from {fasta} group by 1))""")
def rt_reference_blocks(v):
    return B.reference_blocks(rt_fasta(v), 1000, 200)


@query("rt_counts", """
select sample, substr(chrom, 4) as chrom, kind, count(*) as n from {routed_calls} group by 1, 2, 3""")
def rt_counts(v):
    path = work_path(v.spark, "counts")
    K.write_counts(V.variant_counts(genome.routed(v)), path)
    return v.spark.read.schema("sample string, chrom string, kind string, n bigint").option("header", True).csv(path)


@query("rt_append", """
select step, count(*) * 2 as n, cast(sum("ExitStatus") * 2 as bigint) as failures from {typed_metrics} group by 1""")
def rt_append(v):
    path = work_path(v.spark, "records")
    for _ in range(2):
        K.append_records(metrics(v).select(*METRIC_OUT), path)
    return v.spark.read.parquet(path).groupBy("step").agg(F.count("*").alias("n"), F.sum("ExitStatus").alias("failures"))


@query("rt_by_status", "select sample as case_id from {checked} where status = 'PASSED'")
def rt_by_status(v):
    path = work_path(v.spark, "by-status")
    K.write_by_status(Q.output_status(v.objects), path)
    return S.read_ids(v.spark, f"{path}/status=PASSED")


@query("rt_objects", "select lang, cast(sum(strlen(text) + 1) as bigint) as total_bytes from {documents} group by 1")
def rt_objects(v):
    path = work_path(v.spark, "listing")
    v.documents.select("lang", F.col("text").alias("value")).write.partitionBy("lang").text(path)
    listed = S.list_objects(v.spark, path).where(F.col("path").contains("part-"))
    lang = F.regexp_extract("path", "lang=([^/]+)/", 1)
    return listed.groupBy(lang.alias("lang")).agg(F.sum("size_bytes").alias("total_bytes"))


@query("split_counts", "select chrom, count(*) as n, min(pos) as first_pos, max(pos) as last_pos from {named_reads} group by 1")
def split_counts(v):
    path = work_path(v.spark, "split")
    K.split_by_reference(genome.named(v), path)
    return v.spark.read.parquet(path).groupBy("chrom").agg(
        F.count("*").alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


@query("split_one", "select l_orderkey, l_linenumber, pos from {named_reads} where chrom = 'chr7'")
def split_one(v):
    path = work_path(v.spark, "split")
    K.split_by_reference(genome.named(v), path)
    return v.spark.read.parquet(path).where("chrom = 'chr7'").select("l_orderkey", "l_linenumber", "pos")


@query("rt_reset", """
select 'processing' as table_name, count(*) as n from {processing} union all select 'finished', cast(0 as bigint)""")
def rt_reset(v):
    root = work_path(v.spark, "state")
    tables = {"processing": v.processing, "finished": v.finished}
    for name, rows in tables.items():
        rows.write.parquet(f"{root}/{name}")
    K.reset_tables(v.spark, root, {n: d.schema for n, d in tables.items()}, only_finished=True)
    counted = [v.spark.read.parquet(f"{root}/{n}").agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "n") for n in tables]
    return reduce(lambda a, b: a.unionByName(b), counted)
