"""The queries of this subpackage, one for each operator, and the SQL another engine answers them with where it can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    centroids,
    chat,
    decontamination,
    exact_dedup,
    fuzzy_lines,
    hard_negatives,
    jaccard_join,
    language,
    licences,
    oracle,
    packing,
    pii,
    tokens,
    toxicity,
)
from tidemark.llm.store import read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_conversations(read(spark, sf_dir, "conversations"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_documents(read(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("key")


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_documents(read(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(read(spark, sf_dir, "documents"), keep="max")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.line_report(read(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, label = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), F.col("label")
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mined(vectors, F.col("vec_id") % 100 == 0)


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(read(spark, sf_dir, "embeddings"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_token_counts,
        op3_chat_formatting,
        op4_language_id,
        op5_decontamination,
        op6_licence_scan,
        op7_exact_dedup,
        op8_packing,
        op9_line_dedup,
        op10_jaccard_join,
        op11_hard_negatives,
        op12_centroid_clusters,
        op13_personal_data,
    )
}

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL = {
    "op11_hard_negatives": oracle.HARD_NEGATIVES,
    "op12_centroid_clusters": oracle.CENTROID_CLUSTERS,
    "op13_personal_data": oracle.PERSONAL_DATA,
    "op3_chat_formatting": r"""
        with t as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
            union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]')
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
               sum(length(role) + 24 + length(regexp_replace(
                   text, '([<\[])(\\*)(\|im_(?:start|end)\|>|/?s>|/?INST\]|/?SYS>>)', '\1\\\2\3', 'g')))::bigint as formatted_chars,
               true as round_trip
        from t group by conv_id""",
    "op7_exact_dedup": """
        with t as (select doc_id, coalesce(text, '') as t from documents)
        select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
               doc_id is not distinct from max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
        from t""",
    "op10_jaccard_join": f"""
        with recursive w as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x20\\x09-\\x0D]+') as w
            from documents),
        s as (
            select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as g
            from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) as i from w where len(w) > 0)),
        n as (select doc_id, count(*) as n from s group by doc_id),
        link as (
            select a.doc_id as a, b.doc_id as b
            from s a join s b on a.g = b.g and a.doc_id <> b.doc_id
            join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
            group by a.doc_id, b.doc_id, x.n, y.n
            having 100 * count(*) >= 80 * (x.n + y.n - count(*))),
        reach as (select doc_id as id, doc_id as other from documents union select r.id, l.b from reach r join link l on l.a = r.other)
        select r.id as doc_id, coalesce(max(n.n), 0) as n_shingles, min(r.other) as component_id
        from reach r left join n on n.doc_id = r.id group by r.id""",
    "op5_decontamination": f"""
        with d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
            from documents),
        i as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
            from benchmark),
        iw as (
            select distinct item_id, least(len(w), 13) as m, array_to_string(list_slice(w, k, k + least(len(w), 13) - 1), ' ') as g
            from (select *, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) as k from i where len(w) > 0)),
        sizes as (select distinct m from iw),
        dw as (
            select doc_id, m, k, array_to_string(list_slice(w, k, k + m - 1), ' ') as g
            from (select doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) as k from d, sizes where len(w) >= m)),
        hit as (select dw.doc_id, dw.m, dw.k, iw.item_id from dw join iw on dw.m = iw.m and dw.g = iw.g),
        word as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(k, k + m - 1)) as p from hit) group by doc_id),
        item as (
            select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
            from (select distinct doc_id, cast(item_id as varchar) as id from hit) group by doc_id)
        select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(d.w), false) as contaminated
        from d left join word using (doc_id) left join item using (doc_id)""",
}
