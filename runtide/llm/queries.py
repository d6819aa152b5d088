"""The queries of the corpus operators, with production parameters over whole tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtide.llm.byte_bpe import with_ids
from runtide.llm.decontaminate import contaminated
from runtide.llm.minhash import edited_neighbours
from runtide.llm.pii import pseudonymised
from runtide.llm.pseudo_likelihood import score_documents
from runtide.llm.quality import held_out, train_quality, with_quality
from runtide.llm.repair import token_files
from runtide.llm.resample import importance_ranks
from runtide.llm.shared import read_table
from runtide.llm.signature_trees import similar_groups
from runtide.llm.simhash import simhash_groups
from runtide.llm.strtree import hard_negatives
from runtide.llm.suffixes import without_repeats
from runtide.llm.urls import judged_urls, labelled_urls, train_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Stands for a secret; a user of the operator passes one of their own.
PSEUDONYM_KEY = "corpus-pseudonyms"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op4_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash_groups(read_table(spark, sf, "documents"), words=3, most=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_attention_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    scored = with_quality(docs, train_quality(docs, read_table(spark, sf, "labels")), "score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op1_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


@query
def op5_pii_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return pseudonymised(docs, PSEUDONYM_KEY, count="n_values").select("doc_id", "text", "n_values")


@query
def op9_duckdb_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    found = with_ids(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)
    return found.drop("text")


@query
def op10_minhash_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return edited_neighbours(read_table(spark, sf, "documents"), 4 * partitions)


#: The rules of the query, fixed values: (rule, verdict).
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


@query
def op7_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    found = judged_urls(pages, rules, train_urls(labelled_urls(spark)))
    named = {"url_host": "host", "url_path": "path", "url_rule": "rule", "url_verdict": "verdict"}
    return found.select("page_id", *(F.col(old).alias(new) for old, new in named.items()))


@query
def op2_repair_token_files(spark: SparkSession, sf: str) -> DataFrame:
    found = token_files(read_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op6_masked_pseudo_likelihood(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_documents(read_table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"])
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return scored.select("doc_id", mean.alias("score"), "n_words", "log_likelihood")


@query
def op3_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return without_repeats(read_table(spark, sf, "documents")).drop("kept")


@query
def op12_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return importance_ranks(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


@query
def op11_strtree_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLE_SQL["op11_strtree_hard_negatives"] = """
with v as (
    select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as q
    from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select a.r, a.vec_id as anchor_id, a.label = v.label as same, v.vec_id, list_dot_product(a.q, v.q)::bigint as score
    from v as a join v on a.r <> v.r
    where a.vec_id % 100 = 0
), p as (
    select r, anchor_id, vec_id as positive_id, score as positive_score, row_number() over (partition by r order by score desc, vec_id) as place
    from s where same qualify place <= 5
), n as (
    select p.*, s.vec_id as negative_id, s.score as negative_score,
        row_number() over (partition by p.r, place order by s.score desc, s.vec_id) as rank
    from p join s on p.r = s.r and not s.same and 80 * positive_score <= 100 * s.score and 100 * s.score <= 100 * positive_score
    qualify rank <= 5
)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from n
"""


@query
def op13_signature_tree_join(spark: SparkSession, sf: str) -> DataFrame:
    return similar_groups(read_table(spark, sf, "documents"))


ORACLE_SQL["op13_signature_tree_join"] = r"""
with recursive words as (
    select row_number() over () as r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
), sets as (
    select r, doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else
        list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
    from words
), classes as (
    select min(r) as c, list_sort(s) as s, min(doc_id) as first from sets where len(s) > 0 group by list_sort(s)
), tokens as (select c, len(s) as n, hash(unnest(s)) as t from classes),
links as (
    select a.c as a, b.c as b from tokens a join tokens b on a.t = b.t and a.c < b.c
    group by a.c, b.c, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), pairs as (select a, b from links union all select b, a from links),
reach as (
    select c as a, c as b from classes union select reach.a, pairs.b from reach join pairs on reach.b = pairs.a
), named as (
    select reach.a as c, min(classes.first) as component_id from reach join classes on classes.c = reach.b group by reach.a
)
select doc_id, len(sets.s)::bigint as n_shingles, coalesce(component_id, doc_id) as component_id
from sets left join classes on classes.s = list_sort(sets.s) left join named on named.c = classes.c
"""
