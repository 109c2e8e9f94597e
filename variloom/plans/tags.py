"""Queries on DNA sequences: codons, windows, tag pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from variloom.functions import sequence as S
from variloom.operators import tags as T
from variloom.plans.registry import CHECK_VIEWS, query

#: Parameters of the registered design queries.
PARAMS = T.TagParams(min_temp=60, max_temp=72, min_recoded=30, min_distance=100, max_distance=400)

_CODES = ", ".join(f"('{a}', {i}, '{c}')" for a, cs in S.SYNONYMS.items() for i, c in enumerate(cs))
_AMINOS = ", ".join(f"('{c}', '{a}')" for c, a in S.amino_table().items())
CHECK_VIEWS["syn"] = f"select * from (values {_CODES}) s(aa, ord, codon)"
CHECK_VIEWS["aminos"] = f"select * from (values {_AMINOS}) s(codon, aa)"
_DIST = " + ".join(f"cast(substr({{a}},{i},1) <> substr({{b}},{i},1) as int)" for i in (1, 2, 3))


def _dist(a: str, b: str) -> str:
    return _DIST.replace("{a}", a).replace("{b}", b)


CHECK_VIEWS["best_syn"] = f"""
select codon, case when max(d) > 0 then arg_max(other, d * 100 - ord) else codon end as best, max(d) as score from (
 select a.codon, s.codon as other, s.ord, {_dist('a.codon', 's.codon')} as d from {{aminos}} a join {{syn}} s on a.aa = s.aa) group by codon"""
CHECK_VIEWS["codon_rows"] = """
select seq_id, i, substr(seq, cast(3 * i + 1 as int), 3) as codon from (
 select seq_id, seq, unnest(range(length(seq) // 3)) as i from {sequences})"""
CHECK_VIEWS["best_rows"] = "select seq_id, i, c.codon, best, score from {codon_rows} c join {best_syn} b on c.codon = b.codon"
CHECK_VIEWS["recoded"] = """
select seq_id, start, old, new, score, 2 * (length(new) - length(replace(replace(new,'A',''),'T','')))
  + 4 * (length(new) - length(replace(replace(new,'C',''),'G',''))) as mt, score / 24 * 100 as pc
 from (select seq_id, i - 7 as start, string_agg(codon, '') over w as old, string_agg(best, '') over w as new,
   cast(sum(score) over w as int) as score, count(*) over w as n
  from {best_rows} window w as (partition by seq_id order by i rows between 7 preceding and current row)) where n = 8"""


def _kept(p: T.TagParams) -> str:
    return f"select * from {{recoded}} where mt between {p.min_temp} and {p.max_temp} and pc >= {p.min_recoded}"


CHECK_VIEWS["kept_windows"] = _kept(PARAMS)


_LOW, _HIGH = PARAMS.steps
# the best partners of a window by a frame, without a join of windows
CHECK_VIEWS["partners"] = f"""
select seq_id, start as left_start, cast(n as int) as partners, cast(score + top // 1048576 as int) as score, 1048575 - top % 1048576 as right_start from (
 select *, count(*) over w as n, max(score * 1048576 + 1048575 - start) over w as top from {{kept_windows}}
 window w as (partition by seq_id order by start range between {_LOW} following and {_HIGH} following)) where n > 0"""
CHECK_VIEWS["best_lefts"] = """
select seq_id, left_start, score from {partners} qualify score = max(score) over (partition by seq_id)"""
# only windows that reach the top meet the windows at each exact start in their range
CHECK_VIEWS["best_of"] = f"""
select a.seq_id, a.start as left_start, b.start as right_start, (b.start - a.start + 8) * 3 as distance,
 a.score as left_score, b.score as right_score, t.score as score, a.new as left_new, b.new as right_new
 from (select *, left_start + unnest(range({_LOW}, {_HIGH} + 1)) as at_start from {{best_lefts}}) t join {{kept_windows}} a on a.seq_id = t.seq_id and a.start = t.left_start
 join {{kept_windows}} b on b.seq_id = t.seq_id and b.start = t.at_start where a.score + b.score = t.score"""
CHECK_VIEWS["last_of"] = "select * from {best_of} qualify row_number() over (partition by seq_id order by left_start desc, right_start desc) = 1"

PAIR_OUT = ["seq_id", "left_start", "right_start", "distance", "left_score", "right_score", "score", "left_new", "right_new"]


@query("kept_windows", "select seq_id, start, score, cast(mt as double) as mt from {kept_windows}")
def kept_windows(v):
    return T.filter_windows(T.recode_windows(v.sequences), PARAMS).select("seq_id", "start", "score", "mt")


@query("sequence_checks", """
select doc_id, case when not regexp_full_match(regexp_replace(lower(text), '\\s+', '', 'g'), '[acgt]*') then 'alphabet' else '' end
 ||'|'||case when length(regexp_replace(text, '\\s+', '', 'g')) < 100 then 'length' else '' end as errors from {documents}""")
def sequence_checks(v):
    checked = T.validate_sequences(v.documents.select("doc_id", F.col("text").alias("seq")))
    shown = [F.when(F.array_contains("errors", e), e).otherwise("") for e in ("alphabet", "length")]
    return checked.select("doc_id", F.concat_ws("|", *shown).alias("errors"))


@query("clean_sequence", """
select doc_id, md5(translate(regexp_replace(text, '\\s+', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')) as digest from {documents}""")
def clean_sequence(v):
    return v.documents.select("doc_id", F.md5(S.clean_sequence(F.col("text"))).alias("digest"))


@query("codons", "select seq_id, i, codon from {codon_rows}")
def codons(v):
    return T.codon_table(v.sequences).select("seq_id", "i", "codon")


@query("translate", """
select c.seq_id, string_agg(case a.aa when 'STOP' then '*' else a.aa end, '' order by i) as protein
 from {codon_rows} c join {aminos} a on c.codon = a.codon group by 1""")
def translate(v):
    letters = F.transform(S.codons(F.col("seq")), lambda c: F.replace(S.translate(c), F.lit("STOP"), F.lit("*")))
    return v.sequences.where(F.length("seq") >= 3).select("seq_id", F.array_join(letters, "").alias("protein"))


@query("codon_usage", """
select a.aa, c.codon, count(*) as n from {codon_rows} c join {aminos} a on c.codon = a.codon group by 1, 2""")
def codon_usage(v):
    return T.codon_table(v.sequences).groupBy("aa", "codon").agg(F.count("*").alias("n"))


@query("best_synonym", """
select c.codon, b.best, b.score from (select distinct codon from {codon_rows}) c join {best_syn} b on c.codon = b.codon""")
def best_synonym(v):
    seen = T.codon_table(v.sequences).select("codon").distinct()
    best = S.best_synonym(F.col("codon"))
    return seen.select("codon", best.alias("best"), S.codon_distance(F.col("codon"), best).alias("score"))


@query("synonyms", """
select c.codon, string_agg(s.codon, ',' order by s.ord) as synonyms from (select distinct codon from {codon_rows}) c
 join {aminos} a on c.codon = a.codon join {syn} s on s.aa = a.aa group by 1""")
def synonyms(v):
    seen = T.codon_table(v.sequences).select("codon", "aa").distinct()
    return seen.select("codon", F.array_join(S.synonyms(F.col("aa")), ",").alias("synonyms"))


@query("codon_distance", f"""
select seq_id, i, {_dist('codon', 'best')} as distance from {{best_rows}}""")
def codon_distance(v):
    codon = F.col("codon")
    return T.codon_table(v.sequences).select("seq_id", "i", S.codon_distance(codon, S.best_synonym(codon)).alias("distance"))


@query("codon_windows", """
select seq_id, i as start, substr(seq, cast(3 * i + 1 as int), 24) as old from (
 select seq_id, seq, unnest(range(greatest(length(seq) // 3 - 7, 0))) as i from {sequences})""")
def codon_windows(v):
    return T.codon_windows(v.sequences)


@query("melting_temp", """
select seq_id, cast(2 * (length(seq) - length(replace(replace(seq,'A',''),'T','')))
 + 4 * (length(seq) - length(replace(replace(seq,'C',''),'G',''))) as double) as short_mt,
 case when length(seq) > 13 then round(64.9 + 41.0 * ((length(seq) - length(replace(replace(seq,'C',''),'G',''))) - 16.4) / length(seq), 6)
 else cast(2 * (length(seq) - length(replace(replace(seq,'A',''),'T',''))) + 4 * (length(seq) - length(replace(replace(seq,'C',''),'G',''))) as double) end as long_mt
 from {sequences}""")
def melting_temp(v):
    seq = F.col("seq")
    return v.sequences.select("seq_id", S.melting_temp(seq).alias("short_mt"), F.round(S.melting_temp(seq, "long"), 6).alias("long_mt"))


@query("recode_windows", "select seq_id, start, old, new, score, cast(mt as double) as mt, pc from {recoded}")
def recode_windows(v):
    return T.recode_windows(v.sequences)


@query("percent_changed", "select seq_id, start, pc from {recoded}")
def percent_changed(v):
    return T.recode_windows(v.sequences).select("seq_id", "start", S.percent_changed(F.col("new"), F.col("old"), T.WINDOW_BASES).alias("pc"))


@query("window_filter", f"""
select seq_id, count(*) as windows, count(*) filter (where not temp_ok) as rejected_temp,
 count(*) filter (where temp_ok and not pc_ok) as rejected_percent, count(*) filter (where temp_ok and pc_ok) as kept
 from (select seq_id, mt between {PARAMS.min_temp} and {PARAMS.max_temp} as temp_ok, pc >= {PARAMS.min_recoded} as pc_ok from {{recoded}})
 group by 1""")
def window_filter(v):
    return T.window_rejects(T.recode_windows(v.sequences), PARAMS)


@query("window_pairs", """
select seq_id, left_start, partners, score, right_start from {partners}""")
def window_pairs(v):
    return T.window_partners(v.sequences, PARAMS)


@query("best_pairs", f"select {', '.join(PAIR_OUT)} from {{best_of}}")
def best_pairs(v):
    return T.best_pairs(v.sequences, PARAMS).select(*PAIR_OUT)


@query("last_pairs_parity", f"""
select a.seq_id, a.start as left_start, b.start as right_start, a.score + b.score as score from (
  select * from (select k.*, count(*) over w as n from {{kept_windows}} k
   window w as (partition by seq_id order by start range between {_LOW} following and {_HIGH} following)) where n > 0
  qualify row_number() over (partition by seq_id order by start desc) = 1) a
 join {{kept_windows}} b on b.seq_id = a.seq_id and b.start between a.start + {_LOW} and a.start + {_HIGH}
 qualify row_number() over (partition by a.seq_id order by b.start desc) = 1""")
def last_pairs_parity(v):
    return T.best_pairs(v.sequences, PARAMS, "parity").select("seq_id", "left_start", "right_start", "score")


@query("tag_pairs", """
select seq_id, count(*) as ties, max(score) as score, min(distance) as min_distance from {best_of} group by 1""")
def tag_pairs(v):
    return T.design_tags(v.sequences, PARAMS).groupBy("seq_id").agg(
        F.count("*").alias("ties"), F.max("score").alias("score"), F.min("distance").alias("min_distance"))


@query("pair_ties", """
select o.*, n.ties, n.min_distance, n.first_left, n.first_right from {last_of} o join (
 select seq_id, count(*) as ties, min(distance) as min_distance, min(left_start) as first_left, arg_min(right_start, left_start * 1048576 + right_start) as first_right from {best_of} group by 1) n on n.seq_id = o.seq_id""")
def pair_ties(v):
    return T.pair_ties(v.sequences, PARAMS)


#: Windows of any change: some have no other synonym, so sums of 0 occur.
ALL_PARAMS = T.TagParams(min_temp=60, max_temp=72, min_recoded=0, min_distance=100, max_distance=400)
_TAILED = "select seq_id, seq||repeat('ATGTGG', cast(seq_id % 60 as int)) as seq from {sequences}"
for _name in ("codon_rows", "best_rows", "recoded"):
    CHECK_VIEWS[f"tailed_{_name}"] = CHECK_VIEWS[_name].replace("{codon_rows}", "{tailed_codon_rows}").replace("{best_rows}", "{tailed_best_rows}").replace("{sequences}", f"({_TAILED})")
CHECK_VIEWS["tailed_pairs"] = f"""
select *, case when score > 0 then any_far else pos_far end as last_to from (
 select *, count(*) over w as n, max(start) over w as any_far, max(case when score > 0 then start end) over w as pos_far from (
  select * from {{tailed_recoded}} where mt between 60 and 72) window w as (partition by seq_id order by start range between {_LOW} following and {_HIGH} following)) where n > 0"""
CHECK_VIEWS["tailed_last"] = "select seq_id, max(start) filter (where last_to is not null) as l, max(start) as e, arg_max(any_far, start) as last_right, arg_max(last_to, start) filter (where last_to is not null) as r from {tailed_pairs} group by 1"


@query("parity_tail", f"""
select t.seq_id, t.l as left_start, t.r as right_start, t.e as last_left, t.last_right, cast(coalesce(sum(p.n) filter (where t.l is null or p.start > t.l), 0)
 + (select count(*) from {{tailed_recoded}} k where k.seq_id = t.seq_id and k.mt between 60 and 72 and k.start > t.r and k.start <= t.l + {_HIGH}) as bigint) as tail
 from {{tailed_last}} t join {{tailed_pairs}} p on p.seq_id = t.seq_id group by t.seq_id, t.l, t.r, t.e, t.last_right""")
def parity_tail(v):
    tailed = v.spark.sql(_TAILED, sequences=v.sequences)
    return T.parity_tail(tailed, ALL_PARAMS)


@query("apply_tags", """
select s.seq_id, md5(substr(seq, 1, cast(3 * left_start as int))||left_new||substr(seq, cast(3 * left_start + 25 as int), cast(3 * (right_start - left_start) - 24 as int))
 ||right_new||substr(seq, cast(3 * right_start + 25 as int))) as digest, length(seq) as size from {sequences} s join {last_of} p on s.seq_id = p.seq_id""")
def apply_tags(v):
    tagged = T.apply_tags(v.sequences, T.pair_ties(v.sequences, PARAMS))
    return tagged.select("seq_id", F.md5("tagged").alias("digest"), F.length("tagged").cast("bigint").alias("size"))


@query("design_checks", """
select design_id, concat_ws(',',
 case when min_temp::double not between 0 and 200 then 'min_temp' end, case when max_temp::double not between 0 and 200 then 'max_temp' end,
 case when min_temp::double > max_temp::double then 'temp_range' end,
 case when coalesce(try_cast(min_recoded as double), -1) not between 0 and 100 then 'min_recoded' end,
 case when min_amp::double not between 100 and 1000 then 'min_amp' end, case when max_amp::double not between 100 and 1000 then 'max_amp' end,
 case when min_amp::double > max_amp::double then 'amp_range' end) as errors from {designs}""")
def design_checks(v):
    return T.validate_design(v.designs).select("design_id", F.array_join("errors", ",").alias("errors"))
