"""The corpus operators' queries over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioflow.llm import cover_tree, decontam, hard_negatives, langid, licenses, line_dedup, mixing, packing, prefix_trie, secret_scan, simhash, site_quality, weak_rules
from helioflow.llm.common import held_out, read

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.language_spans(docs, langid.fit(docs))
    return found.select("doc_id", held_out("doc_id", 4).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op4_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host: the document's source; path: its language's section there."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return site_quality.site_quality(docs, labels, F.col("source"), F.concat_ws("/", "source", "lang"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.scores(read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.with_drops(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "text", F.coalesce(F.size("drop"), F.lit(0)).alias("n_dropped"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_sequences(read(spark, sf_dir, "documents"), tokenizer_path())


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"]
    return weak_rules.judged(read(spark, sf_dir, "documents")).select(*base)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


def op11_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(read(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation begins with up to five turns of the first one of its hundred."""
    turns = read(spark, sf_dir, "conversations")
    return prefix_trie.prefix_trie(turns, lambda c: c - c % 100, lambda c: F.crc32(c.cast("string")) % 6, 5).drop("ref_conv", "ref_turn")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth row is an anchor; every seventh has another label."""
    rows = read(spark, sf_dir, "embeddings")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(moved, F.col("id") % 50 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_licenses, op2_language, op3_simhash, op4_site_quality, op5_mixing, op6_line_dedup, op7_packing, op8_decontam, op9_weak_rules, op10_secrets,
        op11_cover_tree, op12_prefix_trie, op13_hard_negatives, pipeline,
    ]
    return {f.__name__: f for f in own}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP8_SQL = rf"""
with d as (
  select doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+') if x <> ''] as w
  from documents where doc_id is not null
), b as (
  select item_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+') if x <> ''] as w
  from benchmark where item_id is not null
), ds as (
  select distinct doc_id, unnest([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 3, 2))]) as s from d where len(w) > 0
), bs as (
  select distinct item_id, unnest([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 3, 2))]) as s from b where len(w) > 0
), n as (
  select item_id, count(*) as n_shingles from bs group by item_id
)
select doc_id, item_id, count(*) as n_shared, n_shingles, count(*) / n_shingles as containment
from ds join bs using (s) join n using (item_id)
group by doc_id, item_id, n_shingles
having count(*) / n_shingles >= {decontam.THRESHOLD}
"""


OP11_SQL = f"""
with recursive v as (
  select row_number() over () as r, vec_id, label, x as x
  from (select vec_id, label, [cast(y as double) for y in embedding] as x from embeddings)
), good as (select * from v where label is not null and len(x) > 0 and len([y for y in x if isfinite(y)]) = len(x) and len([y for y in x if y <> 0]) > 0),
links as (
  select a.r as a, b.r as b, b.vec_id from good a join good b on a.label = b.label and a.r <> b.r and len(a.x) = len(b.x) where list_cosine_similarity(a.x, b.x) >= {cover_tree.THRESHOLD}
), reach as (select r as a, r as b from v union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select a, min(vec_id) as component_id from reach join v on v.r = reach.b group by a),
n as (select a, count(*) as n_links from links group by a)
select vec_id, coalesce(n_links, 0) as n_links, component_id, coalesce(vec_id = component_id, component_id is null) as kept
from v left join n on n.a = r left join least on least.a = r
"""

#: CRC-32 of the decimal id bit by bit; lists of turns are the nodes.
OP12_SQL = """
with recursive ids as (select distinct conv_id as c, cast(conv_id as varchar) as s from conversations where conv_id is not null),
crc as (
  select c, s, cast(4294967295 as bigint) as v, 0 as k from ids union all
  select c, s, case when x % 2 = 1 then xor(x >> 1, cast(3988292384 as bigint)) else x >> 1 end, k + 1
  from (select c, s, k, case when k % 8 = 0 then xor(v, cast(ord(s[k // 8 + 1]) as bigint)) else v end as x from crc where k < 8 * len(s))
), heads as (
  select c, c - c % 100 as b, xor(v, cast(4294967295 as bigint)) % 6 as h from crc where k = 8 * len(s)
), t as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i from conversations where conv_id is not null
), r as (
  select h.c, 0 as own, i, role, text from heads h join t on t.c = h.b and i <= h union all select h.c, 1, i, role, text from heads h join t on t.c = h.c and i > h
), n as (
  select c, row_number() over (partition by c order by own, i) as d, struct_pack(role := role, text := text) as turn from r
), p as (
  select c, d, list(turn) over (partition by c order by d) as path from n union all select c, 0, [] from ids
), q as (select *, max(d) over (partition by c) as n from p),
v as (
  select path, any_value(d) as d, min(c) as conv_id, count(*) as n_convs, case when any_value(d) = 0 then 0 else length(any_value(path)[-1].text) end as chars,
    sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where d = n), '')) as ends_sha256 from q group by path
), up as (select u.conv_id, u.d, v.conv_id as parent_conv_id from v u join v on v.path = u.path[1:u.d - 1] and u.d > 0),
kids as (select parent_conv_id as conv_id, d - 1 as d, count(*) as n_children from up group by 1, 2),
full_v as (select v.*, coalesce(n_children, 0) as n_children, parent_conv_id from v left join kids using (conv_id, d) left join up using (conv_id, d))
select v.conv_id, v.d as depth, any_value(v.parent_conv_id) as parent_conv_id, any_value(v.n_convs) as n_convs, any_value(v.n_children) as n_children,
  count(*) filter (where u.n_children = 0) as n_leaves, cast(sum((u.n_convs - 1) * u.chars) as bigint) as saved_tokens, any_value(v.ends_sha256) as ends_sha256
from full_v v join full_v u on u.d >= v.d and u.path[1:v.d] = v.path group by v.conv_id, v.d
"""


OP13_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [floor(256 * cast(x as double)) for x in embedding] as q
  from embeddings where vec_id is not null and label is not null and len([x for x in embedding if isfinite(x)]) = len(embedding)
), s as (
  select a.vec_id as anchor_id, v.vec_id, v.label = a.label as same, cast(list_inner_product(a.q, v.q) as bigint) as score
  from v a join v on a.vec_id <> v.vec_id and len(a.q) = len(v.q) where a.vec_id % 50 = 0
), p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), n as (
  select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as rank, vec_id as negative_id, positive_score, score as negative_score
  from p join s using (anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_decontam": OP8_SQL, "op11_cover_tree": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_hard_negatives": OP13_SQL}
