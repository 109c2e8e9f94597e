"""Queries on reads, pileups, somatic calls and variant tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from variloom.functions.chrom import chrom_rank
from variloom.operators import ordering as O
from variloom.operators import reads as G
from variloom.operators import somatic as P
from variloom.operators import variants as V
from variloom.plans.registry import CHECK_VIEWS, query
from variloom.session import work_path
from variloom.sinks.files import write_fasta
from variloom.sources import genomics as B

CHECK_VIEWS["named_reads"] = """
select *, case when regexp_full_match(raw_chrom, '([1-9]|1[0-9]|2[0-2]|X|Y|M)') then 'chr'||raw_chrom else raw_chrom end as chrom from {reads}"""
CHECK_VIEWS["usable"] = "select * from {named_reads} where mapq >= 1 and (flag & 1796) = 0"


def _n(role: str, cond: str) -> str:
    return f"count(*) filter (where role = '{role}' and {cond})"


_PILE = ", ".join(
    _n(role, f"base = '{b}' and (flag & 16) {'<>' if s == 'r' else '='} 0") + f" as {side}_{b.lower()}_{s}"
    for side, role in P.ROLES.items() for b in P.BASES for s in "fr")
CHECK_VIEWS["piled"] = f"select sample, chrom, pos, max(ref) as ref, {_PILE} from {{usable}} group by 1, 2, 3"
CHECK_VIEWS["base_rows"] = """
select sample, chrom, pos, ref, base, count(*) filter (where role = 'normal') as n, count(*) filter (where role = 'tumor') as t
 from {usable} group by all"""
CHECK_VIEWS["site_counts"] = """
select sample, chrom, pos, max(ref) as ref, arg_max(base, (n + t) * 1000 - ascii(base)) filter (where base <> ref) as alt,
 cast(coalesce(sum(n) filter (where base = ref), 0) as bigint) as n_ref, cast(coalesce(sum(t) filter (where base = ref), 0) as bigint) as t_ref,
 cast(coalesce(arg_max(n, (n + t) * 1000 - ascii(base)) filter (where base <> ref), 0) as bigint) as n_alt,
 cast(coalesce(arg_max(t, (n + t) * 1000 - ascii(base)) filter (where base <> ref), 0) as bigint) as t_alt,
 cast(sum(n) as bigint) as n_depth, cast(sum(t) as bigint) as t_depth from {base_rows} group by 1, 2, 3"""
CHECK_VIEWS["typed_sites"] = """
select *, case when n_alt * 4 >= n_depth * 3 then 'hom' when n_alt * 10 >= n_depth then 'het' else 'ref' end as n_gt,
 case when t_alt * 4 >= t_depth * 3 then 'hom' when t_alt * 10 >= t_depth then 'het' else 'ref' end as t_gt
 from {site_counts} where n_depth >= 8 and t_depth >= 6 and alt is not null"""
CHECK_VIEWS["candidates"] = "select * from {typed_sites} where n_gt <> 'ref' or t_gt <> 'ref'"

# upper hypergeometric tail: alt or more of k_total among depth draws from total
_TAIL = """least(1, sum(exp(lgamma(kk + 1) - lgamma(k + 1) - lgamma(kk - k + 1) + lgamma(total - kk + 1) - lgamma(d - k + 1)
 - lgamma(total - kk - d + k + 1) - lgamma(total + 1) + lgamma(d + 1) + lgamma(total - d + 1))))"""
CHECK_VIEWS["p_tests"] = f"""
select hit, d, kk, total, round({_TAIL}, 9) as p from (
 select distinct hit, d, kk, total, unnest(range(hit, least(kk, d) + 1)) as k from (
  select case when t_alt * (n_ref + n_alt) >= n_alt * (t_ref + t_alt) then t_alt else t_ref end as hit, t_ref + t_alt as d,
   case when t_alt * (n_ref + n_alt) >= n_alt * (t_ref + t_alt) then n_alt + t_alt else n_ref + t_ref end as kk,
   n_ref + n_alt + t_ref + t_alt as total from {{candidates}}
  union select n_alt + t_alt, n_ref + n_alt + t_ref + t_alt, n_alt + t_alt + (n_ref + n_alt + t_ref + t_alt) // 1000,
   2 * (n_ref + n_alt + t_ref + t_alt) from {{candidates}})) group by 1, 2, 3, 4"""
CHECK_VIEWS["called"] = """
select * from (select c.*, s.p as somatic_p, v.p as variant_p,
 case when n_gt = t_gt then 'Germline' when s.p <= 0.05 then case n_gt when 'ref' then 'Somatic' when 'het' then 'LOH' else 'Unknown' end
  when v.p <= 0.99 then 'Germline' end as status
 from {candidates} c
 join {p_tests} s on s.hit = case when t_alt * (n_ref + n_alt) >= n_alt * (t_ref + t_alt) then t_alt else t_ref end and s.d = t_ref + t_alt
  and s.kk = case when t_alt * (n_ref + n_alt) >= n_alt * (t_ref + t_alt) then n_alt + t_alt else n_ref + t_ref end
  and s.total = n_ref + n_alt + t_ref + t_alt
 join {p_tests} v on v.hit = n_alt + t_alt and v.d = n_ref + n_alt + t_ref + t_alt
  and v.kk = n_alt + t_alt + (n_ref + n_alt + t_ref + t_alt) // 1000 and v.total = 2 * (n_ref + n_alt + t_ref + t_alt))
 where status is not null"""
CHECK_VIEWS["processed"] = """
select *, case status when 'Somatic' then t_alt * 10 >= t_depth and n_alt * 20 <= n_depth and somatic_p <= 0.07
 when 'LOH' then n_alt * 10 >= n_depth and somatic_p <= 0.07
 when 'Germline' then n_alt * 10 >= n_depth and t_alt * 10 >= t_depth and variant_p <= 0.07 else false end as hc from {called}"""
CHECK_VIEWS["routed_calls"] = """
select *, case when length(ref) = length(alt) then 'snp' else 'indel' end as kind,
 sample||'_'||chrom||'.'||case when length(ref) = length(alt) then 'snp' else 'indel' end||'.vcf' as file from {processed}"""


def named(v):
    return G.reheader(v.reads)


def piled(v):
    return P.pileup(G.usable_reads(named(v)))


def called(v):
    return P.call_somatic(P.allele_counts(piled(v)))


def routed(v):
    return P.route_variant_kind(P.process_somatic(called(v)))


CALL_OUT = ["sample", "chrom", "pos", "ref", "alt", "n_ref", "n_alt", "t_ref", "t_alt", "n_gt", "t_gt", "status"]
_P_SQL = "round(somatic_p, 6) as somatic_p, round(variant_p, 6) as variant_p"


def _p_out():
    return [F.round(c, 6).alias(c) for c in ("somatic_p", "variant_p")]


@query("chrom_normalized", "select raw_chrom, chrom, count(*) as n from {named_reads} group by 1, 2")
def chrom_normalized(v):
    return named(v).groupBy("raw_chrom", "chrom").agg(F.count("*").alias("n"))


@query("any_renamed", """
select bool_or(chrom <> raw_chrom) as renamed, count(*) filter (where chrom <> raw_chrom) as renamed_rows from {named_reads}""")
def any_renamed(v):
    return G.any_renamed(v.reads)


@query("flagstat", """
select sample, (flag & 512) <> 0 as qc_fail, count(*) as total, count(*) filter (where flag & 256 <> 0) as secondary,
 count(*) filter (where flag & 256 = 0 and flag & 2048 <> 0) as supplementary, count(*) filter (where flag & 1024 <> 0) as duplicates,
 count(*) filter (where flag & 4 = 0) as mapped, count(*) filter (where flag & 2305 = 1) as paired,
 count(*) filter (where flag & 2305 = 1 and flag & 64 <> 0) as read1, count(*) filter (where flag & 2305 = 1 and flag & 128 <> 0) as read2,
 count(*) filter (where flag & 2311 = 3) as proper, count(*) filter (where flag & 2317 = 1) as both_mapped,
 count(*) filter (where flag & 2317 = 9) as singletons from {reads} group by 1, 2""")
def flagstat(v):
    return G.flagstat(v.reads, ["sample"])


@query("coverage_stats", """
select chrom, count(*) as positions, sum(depth) / count(*) as mean_depth, quantile_cont(depth, 0.5) as median_depth, max(depth) as max_depth
 from (select chrom, pos, count(*) as depth from {named_reads} group by 1, 2) group by 1""")
def coverage_stats(v):
    return G.coverage_stats(named(v))


@query("coverage_long", """
select chrom, count(*) as positions, sum(depth) / count(*) as mean_depth, quantile_cont(depth, 0.5) as median_depth, max(depth) as max_depth
 from (select chrom, place, count(*) as depth from (
  select chrom, start + unnest(case kind when 'D' then list_concat(range(5, 13), range(15, 25)) when 'I' then range(5, 23) when 'S' then range(5, 22) else range(5, 25) end) as place
  from {long_reads}) group by 1, 2) group by 1""")
def coverage_long(v):
    return G.coverage_runs(P.aligned_runs(v.long_reads))


@query("usable_reads", "select role, chrom, count(*) as n, cast(sum(mapq) as bigint) as mapq_sum from {usable} group by 1, 2")
def usable_reads(v):
    return G.usable_reads(named(v)).groupBy("role", "chrom").agg(
        F.count("*").alias("n"), F.sum("mapq").cast("bigint").alias("mapq_sum"))


_RANK = "case substr(chrom, 4) when 'X' then 23 when 'Y' then 24 when 'M' then 25 else cast(substr(chrom, 4) as int) end"


@query("coordinate_sorted", f"""
select l_orderkey, l_linenumber, chrom, pos from {{named_reads}} order by {_RANK}, pos, l_orderkey, l_linenumber""")
def coordinate_sorted(v):
    reads = named(v).select("l_orderkey", "l_linenumber", "chrom", "pos")
    return G.coordinate_sort(reads, ["l_orderkey", "l_linenumber"])


CHECK_VIEWS["placed_reads"] = f"select l_orderkey * 8 + l_linenumber as read_no, min(cast({_RANK} as bigint) * 1000000000 + pos) as place from {{named_reads}} group by 1"


@query("is_sorted", """
select count(*) filter (where prev > place) = 0 as is_sorted, count(*) filter (where prev > place) as inversions from (
 select place, lag(place) over (order by read_no) as prev from {placed_reads})""")
def is_sorted(v):
    # one read per number, the first in genome order
    numbered = named(v).withColumn("read_no", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    first = F.min(F.struct(chrom_rank(F.col("chrom")).alias("rank"), "pos", "chrom")).alias("r")
    return G.is_sorted(numbered.groupBy("read_no").agg(first).select("read_no", "r.chrom", "r.pos"), "read_no")


@query("header_sorted", """
select l_orderkey, l_linenumber, chrom, pos, row_number() over (order by case when part < 20 then (part * 7) % 25 else 100 end, chrom, pos, l_orderkey, l_linenumber) as place
 from (select *, case substr(chrom, 4) when 'X' then 22 when 'Y' then 23 when 'M' then 24 else cast(substr(chrom, 4) as int) - 1 end as part from {named_reads})""")
def header_sorted(v):
    # a header in another order than the genome's, without five of the references
    path = work_path(v.spark, "header")
    part = F.col("p_partkey") % 25
    raw = F.when(part == 22, "X").when(part == 23, "Y").when(part == 24, "M").otherwise((part + 1).cast("string"))
    named_parts = v.part.where(part < 20).select(((part * 7) % 25).alias("k"), F.concat(F.lit("@SQ\tSN:"), raw, F.lit("\tLN:1000")).alias("value")).distinct()
    named_parts.repartitionByRange(3, "k").sortWithinPartitions("k").select("value").write.text(path)
    reads = named(v).select("l_orderkey", "l_linenumber", "chrom", "pos")
    ordered = G.coordinate_sort(reads, ["l_orderkey", "l_linenumber"], G.header_order(B.read_sam(v.spark, path)[0]))
    return O.file_row_index(_written(v, ordered), "place")


def _written(v, rows):
    path = work_path(v.spark, "ordered")
    rows.write.parquet(path)
    return v.spark.read.parquet(path)


@query("locus_join", """
select chrom, pos, count(*) filter (where role = 'normal') as normal_depth, count(*) filter (where role = 'tumor') as tumor_depth
 from {usable} group by 1, 2""")
def locus_join(v):
    return G.usable_reads(named(v)).groupBy("chrom", "pos").agg(
        *(F.count_if(F.col("role") == r).alias(f"{r}_depth") for r in ("normal", "tumor")))


@query("pileup", "select * from {piled}")
def pileup(v):
    return piled(v)


@query("somatic_calls", f"select {', '.join(CALL_OUT)}, {_P_SQL} from {{called}}")
def somatic_calls(v):
    return called(v).select(*CALL_OUT, *_p_out())


@query("process_somatic", f"select {', '.join(CALL_OUT)}, hc, {_P_SQL} from {{processed}}")
def process_somatic(v):
    return P.process_somatic(called(v)).select(*CALL_OUT, "hc", *_p_out())


@query("somatic_by_chrom", """
select chrom, status, hc, count(*) as n, round(min(somatic_p), 6) as min_p from {processed} group by 1, 2, 3""")
def somatic_by_chrom(v):
    return P.process_somatic(called(v)).groupBy("chrom", "status", "hc").agg(
        F.count("*").alias("n"), F.round(F.min("somatic_p"), 6).alias("min_p"))


@query("variant_kinds", "select sample, kind, file, count(*) as n from {routed_calls} group by 1, 2, 3")
def variant_kinds(v):
    return routed(v).groupBy("sample", "kind", "file").agg(F.count("*").alias("n"))


@query("variant_counts", """
select sample, substr(chrom, 4) as chrom, kind, count(*) as n from {routed_calls} group by 1, 2, 3""")
def variant_counts(v):
    return V.variant_counts(routed(v))


@query("total_counts", """
select case when grouping(file) = 1 then 'total' else file end as file, count(*) as n from {routed_calls} group by rollup(file)""")
def total_counts(v):
    return V.total_counts(routed(v)).select("file", "n")


@query("chrom_bars", """
select sample, substr(chrom, 4) as chrom, count(*) filter (where kind = 'snp') as snv, count(*) filter (where kind = 'indel') as indel
 from {routed_calls} group by 1, 2 order by 1, 2""")
def chrom_bars(v):
    return V.chrom_bars(V.variant_counts(routed(v)))


@query("lexicographic_files", """
select distinct chrom, file from {routed_calls} order by chrom, file""")
def lexicographic_files(v):
    return V.lexicographic(routed(v).select("chrom", "file").distinct(), "file")


@query("vcf_concat", """
select sample, kind, chrom, pos, ref, alt, status from {routed_calls} order by 1, 2, 3, 4, 5, 6""")
def vcf_concat(v):
    calls = routed(v).select("sample", "kind", "chrom", "pos", "ref", "alt", "status")
    return V.concat_vcf(calls)


@query("manhattan", f"""
select chrom||':'||pos as "SNP", {_RANK} as "CHR", pos as "BP", round(somatic_p, 6) as "P" from {{routed_calls}}""")
def manhattan(v):
    return V.manhattan(routed(v)).withColumn("P", F.round("P", 6))


@query("vcf_records", """
select sample, chrom, pos, chrom||chr(9)||pos||chr(9)||'.'||chr(9)||ref||chr(9)||alt||chr(9)||'.'||chr(9)||'PASS' as head,
 n_depth + t_depth as dp, n_alt, t_alt, status, hc from {routed_calls}""")
def vcf_records(v):
    # rendered as VCF text, parsed again, and filtered a second time from the parsed fields
    from variloom.sources.genomics import parse_vcf_fields

    lines = V.vcf_lines(routed(v)).select("sample", "kind", F.split("line", "\t").alias("f"), "line")
    parsed = parse_vcf_fields(lines)
    again = P.process_somatic(V.calls_from_vcf(parsed))
    head = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"))
    return again.select("sample", "chrom", "pos", head.alias("head"), (F.col("n_depth") + F.col("t_depth")).alias("dp"),
                        "n_alt", "t_alt", "status", "hc")


CHECK_VIEWS["usable_long"] = "select * from {long_reads} where mapq >= 1"
# the change sits at the last base before it, the twelfth of the part's bases; every read covers that place
CHECK_VIEWS["change_counts"] = """
select sample, chrom, start + 12 as pos, any_value(p_partkey) as p_partkey, count(*) filter (where role = 'normal') as n_depth, count(*) filter (where role = 'tumor') as t_depth,
 count(*) filter (where role = 'normal' and kind = 'D') as n_d, count(*) filter (where role = 'tumor' and kind = 'D') as t_d,
 count(*) filter (where role = 'normal' and kind = 'I') as n_i, count(*) filter (where role = 'tumor' and kind = 'I') as t_i
 from {usable_long} group by all"""
CHECK_VIEWS["indel_sites"] = """
select sample, chrom, pos, case when ins then substr(bases, 12, 1) else substr(bases, 12, 3) end as ref,
 case when ins then substr(bases, 12, 1)||'GG' else substr(bases, 12, 1) end as alt,
 n_depth - (case when ins then n_i else n_d end) as n_ref, t_depth - (case when ins then t_i else t_d end) as t_ref,
 case when ins then n_i else n_d end as n_alt, case when ins then t_i else t_d end as t_alt, n_depth, t_depth
 from (select c.*, bases, n_i + t_i >= n_d + t_d as ins from {change_counts} c join {reference_lines} r on r.p_partkey = c.p_partkey where n_i + t_i + n_d + t_d > 0)"""
_CHAIN = ["site_counts", "typed_sites", "candidates", "p_tests", "called", "processed", "routed_calls"]
for _name in _CHAIN[1:]:
    _text = CHECK_VIEWS[_name].replace("{site_counts}", "{indel_sites}")
    for _other in _CHAIN[1:]:
        _text = _text.replace("{" + _other + "}", "{indel_" + _other + "}")
    CHECK_VIEWS[f"indel_{_name}"] = _text

BLOCK = 1000


def _long(v):
    """Insertions and deletions, pileup and reference blocks: reads are alignment text, the reference is FASTA text."""
    path = work_path(v.spark, "long-reads")
    reads = v.long_reads
    name = F.concat_ws(":", "sample", "role", F.col("l_orderkey").cast("string"))
    quality = F.rpad(F.lit("I"), F.length("seq"), "I")
    reads.select(F.concat_ws("\t", name, F.col("flag").cast("string"), "chrom", F.col("pos").cast("string"), F.col("mapq").cast("string"), "cigar",
                             F.lit("*"), F.lit("0"), F.lit("0"), "seq", quality).alias("value")).write.text(path)
    parts = F.split("qname", ":")
    back = B.read_sam(v.spark, path)[1].withColumns({"sample": F.get(parts, F.lit(0)), "role": F.get(parts, F.lit(1))})
    usable = G.usable_reads(G.reheader(back))
    fasta = work_path(v.spark, "fasta")
    write_fasta(v.reference_lines.select("chrom", "start", "bases"), fasta)
    return P.expand_changes(usable), P.pileup(P.expand_alignment(P.near_reads(usable), P.MATCHED)), B.reference_blocks(B.read_reference(v.spark, fasta), BLOCK, 200)


def indels(v):
    changes, pile, blocks = _long(v)
    return P.route_variant_kind(P.process_somatic(P.call_somatic(P.indel_counts(changes, pile, blocks, BLOCK))))


@query("pileup_reference", """
select sample, chrom, start + i as pos, substr(bases, cast(i as int), 1) as ref, count(*) filter (where role = 'normal') as normal_depth, count(*) filter (where role = 'tumor') as tumor_depth
 from (select u.*, bases, unnest(case kind when 'D' then list_concat(range(5, 13), range(15, 25)) when 'I' then range(5, 23) when 'S' then range(5, 22) else range(5, 25) end) as i
  from {usable_long} u join {reference_lines} r on r.p_partkey = u.p_partkey) group by all""")
def pileup_reference(v):
    _, pile, blocks = _long(v)
    depth = {side: sum((F.col(f"{side[0]}_{b.lower()}_{s}") for b in P.BASES for s in "fr"), F.lit(0)) for side in ("normal", "tumor")}
    return P.with_reference(pile, blocks, BLOCK).select("sample", "chrom", "pos", "ref", *(d.cast("bigint").alias(f"{side}_depth") for side, d in depth.items()))


@query("indel_calls", f"select {', '.join(CALL_OUT)}, kind, hc, {_P_SQL} from {{indel_routed_calls}}")
def indel_calls(v):
    return indels(v).select(*CALL_OUT, "kind", "hc", *_p_out())


_BOTH = "(select sample, chrom, kind from {routed_calls} union all select sample, chrom, kind from {indel_routed_calls})"


@query("variant_counts_both", f"select sample, substr(chrom, 4) as chrom, kind, count(*) as n from {_BOTH} group by 1, 2, 3")
def variant_counts_both(v):
    return V.variant_counts(V.concat_vcf(routed(v), indels(v)))


@query("chrom_bars_both", f"""
select sample, substr(chrom, 4) as chrom, count(*) filter (where kind = 'snp') as snv, count(*) filter (where kind = 'indel') as indel
 from {_BOTH} group by 1, 2 order by 1, 2""")
def chrom_bars_both(v):
    return V.chrom_bars(V.variant_counts(V.concat_vcf(routed(v), indels(v))))
