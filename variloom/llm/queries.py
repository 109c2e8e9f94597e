"""The operators as registered queries, with their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variloom.llm import chat, decontam, embeddings, langid, linededup, minhash, mixing, negatives, pii, pst, sharding, suffixes, trie
from variloom.llm.tables import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


@query("op2_decontamination", r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
 b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
 p as (select distinct item_id, len, array_to_string(w[k:k + len - 1], ' ') as pattern from (
   select *, unnest(range(1, cast(len(w) - len + 2 as bigint))) as k from (select item_id, w, least(13, len(w)) as len from b where len(w) > 0))),
 o as (select doc_id, len, k, array_to_string(w[k:k + len - 1], ' ') as pattern from (
   select doc_id, w, l.len, unnest(range(1, cast(greatest(len(w) - l.len + 2, 1) as bigint))) as k from d, (select distinct len from p) l)),
 h as (select doc_id, item_id, k, o.len from o join p on o.pattern = p.pattern and o.len = p.len),
 c as (select doc_id, count(distinct n) as n_hit from (select doc_id, unnest(range(k, k + len)) as n from (select distinct doc_id, k, len from h)) group by 1),
 i as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from h group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
 coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join c on d.doc_id = c.doc_id left join i on d.doc_id = i.doc_id""")
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontam.judged(decontam.find_passages(docs, table(spark, folder, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op10_mixing")
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    sizes = mixing.word_counts(table(spark, folder, "documents"))
    return mixing.mix_sources(sizes).select("doc_id", "size", "source_size", "target", "taken")


@query("op1_language_id")
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.learn(docs.where(held_out(F.col("doc_id"), 5) != 0))
    return langid.predict(docs.select("doc_id", (held_out(F.col("doc_id"), 5) == 0).alias("held_out"), "text"), *model).drop("text")


@query("op5_minhash", r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
 s as (select distinct doc_id, array_to_string(w[k:k + least(3, len(w)) - 1], ' ') || '|' || least(3, len(w)) as g from (
   select *, unnest(range(1, cast(greatest(len(w) - 1, 2) as bigint))) as k from w where len(w) > 0)),
 n as (select doc_id, count(*) as n from s group by 1),
 e as (select a.doc_id as a, b.doc_id as b from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2
   having 100 * count(*) >= 85 * ((select n from n where n.doc_id = a.doc_id) + (select n from n where n.doc_id = b.doc_id) - count(*))),
 r(node, low) as (select distinct a, a from e union select e.b, r.low from r join e on e.a = r.node)
select w.doc_id, coalesce(n, 0) as n_shingles, least(w.doc_id, coalesce(low, w.doc_id)) as component_id, w.doc_id = least(w.doc_id, coalesce(low, w.doc_id)) as kept
from w left join n on n.doc_id = w.doc_id left join (select node, min(low) as low from r group by 1) m on m.node = w.doc_id""")
def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), size=3, threshold=0.85)


@query("op4_lm_scoring")
def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    out = held_out(F.col("doc_id"), 7) == 2
    scored = pst.score(table(spark, folder, "documents").select("doc_id", "text"), ~out)
    return scored.withColumn("held_out", out)


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffixes.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = linededup.drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op6_embedding_dedup", """
with recursive v as (select vec_id, label, cast(embedding as double[]) as x from embeddings where label is not null and embedding is not null),
 e as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id where list_cosine_similarity(a.x, b.x) >= 0.98),
 r(node, low) as (select distinct a, a from e union select e.b, r.low from r join e on e.a = r.node),
 m as (select node, min(low) as low from r group by 1), n as (select a, count(*) as n from e group by 1)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(low, vec_id)) as component_id, vec_id = least(vec_id, coalesce(low, vec_id)) as kept
from embeddings left join m on node = vec_id left join n on n.a = vec_id""")
def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.link_vectors(table(spark, folder, "embeddings"))


@query("op8_chat_formatting", """
with l as (select conv_id, max(turn) as cut from conversations where role = 'assistant' group by 1),
 t as (select 0 as side, c.* from conversations c join l using (conv_id)
   union all select 1, c.* from conversations c join l using (conv_id) where turn < cut
   union all select 1, l.conv_id, c.turn, c.role, c.text from l join conversations c on c.conv_id = xor(l.conv_id, 1) where c.turn >= cut),
 n as (select side, conv_id, role, text, row_number() over (partition by side, conv_id order by turn, role, text) as k from t),
 f as (select conv_id, coalesce(min(case when a.k is null or b.k is null or a.role is distinct from b.role or a.text is distinct from b.text then k end), max(k) + 1) - 1 as shared
   from (select * from n where side = 0) a full join (select * from n where side = 1) b using (conv_id, k) group by 1),
 p as (select n.*, shared, k > shared as after, '<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10) as head,
   '<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) as piece
   from n join f using (conv_id)),
 q as (select *, sum(length(piece)) over (partition by conv_id, side, after order by k) as upto from p)
select conv_id as pair_id, any_value(shared) as prompt_turns, coalesce(string_agg(piece, '' order by k) filter (side = 0 and not after), '') as prompt,
 coalesce(string_agg(piece, '' order by k) filter (side = 0 and after), '') as chosen, coalesce(string_agg(piece, '' order by k) filter (side = 1 and after), '') as rejected,
 coalesce(string_agg(cast(cast(upto - length(piece) + length(head) as bigint) as varchar) || '-' || cast(cast(upto - 1 as bigint) as varchar), ',' order by k) filter (side = 0 and after and role = 'assistant'), '') as chosen_mask,
 coalesce(string_agg(cast(cast(upto - length(piece) + length(head) as bigint) as varchar) || '-' || cast(cast(upto - 1 as bigint) as varchar), ',' order by k) filter (side = 1 and after and role = 'assistant'), '') as rejected_mask
from q group by 1""")
def op8_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    made = chat.preference_pairs(*chat.swapped_endings(table(spark, folder, "conversations")))
    for c in ("chosen_mask", "rejected_mask"):
        made = made.withColumn(c, F.array_join(F.transform(c, lambda m: F.concat_ws("-", m["begin"].cast("string"), m["end"].cast("string"))), ","))
    return made.withColumn("prompt_turns", F.col("prompt_turns").cast("long"))


@query("op9_pii_surrogates")
def op9_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pseudonymise(table(spark, folder, "documents").select("doc_id", "text"), key="production-key")


@query("op12_sharding", """
with tab as (select list(list_reduce([n::bigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) order by n) as t from range(256) r(n)),
 d as (select doc_id, coalesce(text, '') as x, coalesce(cast(doc_id as varchar), '') as i from documents),
 k as (select doc_id, cast(length(hex(x)) // 2 + 1 as bigint) as size, cast('0x' || substr(md5(x), 1, 15) as bigint) as h, cast('0x' || substr(md5(i), 1, 15) as bigint) as g,
   xor(list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(x), '..'), lambda b: cast('0x' || b as bigint))), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) as text_crc32
   from d, tab),
 o as (select *, sum(size) over () as total, sum(size) over (order by h, g, doc_id rows unbounded preceding) - size as pos, row_number() over (order by h, g, doc_id) as rank from k),
 m as (select *, min(pos) over (partition by h) as group_at, sum(size) over (partition by h) as group_size from o),
 s as (select *, cast((case when group_size * 64 * 16 <= total then 2 * group_at + group_size else 2 * pos + size end) * 16 // (2 * total) as integer) as shard from m)
select doc_id, size, cast(text_crc32 as bigint) as text_crc32, 'bytes' as law, shard, cast(rank - min(rank) over (partition by shard) as bigint) as slot, cast(null as integer) as grown_shard from s""")
def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.place(table(spark, folder, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op11_conversation_trie", """
with tab as (select list(list_reduce([n::bigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) order by n) as t from range(256) r(n)),
 t as (select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as k from conversations where conv_id is not null),
 i as (select c, c - c % 100 as base, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(c as varchar), ''), lambda s: cast(ascii(s) as bigint))), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) % 6 as h
   from (select distinct c from t), tab),
 m as (select i.c, 0 as own, k, r, x from i join t on t.c = i.base where k <= h union all select i.c, 1, k, r, x from i join t on t.c = i.c where k > h),
 p as (select c, row_number() over w as depth, length(x) as len, string_agg(sha256(r) || sha256(x), '') over w as path from m window w as (partition by c order by own, k rows unbounded preceding)),
 a as (select c, depth, len, path from p union all select c, 0, 0, '' from i),
 n as (select path, any_value(depth) as depth, any_value(len) as len, min(c) as conv_id, count(*) as n_convs from a group by path),
 f as (select c, max_by(path, depth) as path from a group by c),
 e as (select path, string_agg(cast(c as varchar), ',' order by c) as ids from f group by path),
 k as (select left(path, length(path) - 128) as path, count(*) as n from n where depth > 0 group by 1),
 s as (select a.path, sum((n.n_convs - 1) * n.len) as saved, count(*) filter (k.n is null) as leaves
   from n join a on a.c = n.conv_id and a.depth <= n.depth left join k on k.path = n.path group by 1)
select n.conv_id, cast(n.depth as bigint) as depth, o.conv_id as parent_conv_id, n.n_convs, coalesce(k.n, 0) as n_children, s.leaves as n_leaves, cast(s.saved as bigint) as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from n join s on s.path = n.path left join k on k.path = n.path left join e on e.path = n.path left join n o on n.depth > 0 and o.path = left(n.path, length(n.path) - 128)""")
def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(*trie.swap_openings(trie.numbered_turns(table(spark, folder, "conversations"))))


@query("op13_hard_negatives", """
with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
   from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
 s as (select a.vec_id as a, b.vec_id as b, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
 p as (select a, b, score from (select *, row_number() over (partition by a order by score desc, b) as k from s where same) where k <= 5),
 n as (select p.a, p.b, p.score as p, s.b as n, s.score, row_number() over (partition by p.a, p.b order by s.score desc, s.b) as k
   from p join s on s.a = p.a and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score)
select a as anchor_id, b as positive_id, cast(k as integer) as rank, n as negative_id, p as positive_score, score as negative_score from n where k <= 10""")
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), negatives.scaled(F.col("embedding")).alias("v"))
    return negatives.mine(rows, F.col("id") % 100 == 0)
