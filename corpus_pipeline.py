"""From raw documents to token ids: quality, near-duplicates, benchmark leaks, personal data, encoding.

Each stage takes (spark, docs, sf_dir) and looks at all rows that the one before it kept. Any column may be null, rows may
repeat, tables may be empty: the operators' docstrings say what that gives.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtide.llm.byte_bpe import with_ids
from runtide.llm.decontaminate import contaminated
from runtide.llm.pii import pseudonymised
from runtide.llm.quality import train_quality, with_quality
from runtide.llm.queries import PSEUDONYM_KEY
from runtide.llm.shared import read_table, settle
from runtide.llm.simhash import one_of_each_group


#: Hashes of leaked texts go into so many buckets at most; those are broadcast.
BUCKETS = 1 << 19


def own_name(label: str) -> str:
    """A column name that no table has."""
    return f"{label}_{uuid.uuid4().hex}"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more; the model learns from labelled documents among them."""
    model = train_quality(docs, read_table(spark, sf_dir, "labels"))
    score = own_name("score")
    return with_quality(docs, model, score).where(F.col(score) >= 0.7).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group whose fingerprints link at 2 bits or fewer."""
    return one_of_each_group(docs, words=3, most=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item; rows are told apart by the SHA-256 of their text, so those without an id are judged too.

    Texts whose bucket has no leaked one pass where they lie; only the others are shuffled, and decided by the whole hash.
    """
    key, gone, bucket, taken = own_name("key"), own_name("gone"), own_name("bucket"), own_name("taken")
    marked = docs.withColumn(key, F.sha2(F.coalesce("text", F.lit("")), 256))
    leaked = contaminated(marked.select(key, "text"), read_table(spark, sf_dir, "benchmark"), keys=(key,))
    leaked = settle(leaked.select(F.col(key).alias(gone)).distinct(), "leaked")
    place = lambda name: F.pmod(F.xxhash64(name), F.lit(BUCKETS))
    places = F.broadcast(leaked.select(place(gone).alias(taken)).distinct())
    dealt, among = marked.withColumn(bucket, place(key)), F.col(bucket) == F.col(taken)
    clear = dealt.join(places, among, "left_anti")
    near = dealt.join(places, among, "left_semi").join(leaked, F.col(key) == F.col(gone), "left_anti")
    return clear.union(near).drop(key, bucket)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced by pseudonyms; `n_chars` follows the text where it changed."""
    count = own_name("count")
    out = pseudonymised(docs, PSEUDONYM_KEY, count=count)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(count) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.drop(count)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and the SHA-256 of the bytes that the ids decode to.

    Executors hold the memory of the stages before. So Arrow batches of whole texts are small from here on (a setting of the session
    that changes no result), and workers keep fewer pieces.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    found = with_ids(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, kept=100_000)
    return found.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: Models, links and grammars are not SQL's: `tests/llm/test_pipeline.py` holds the rows against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = settle(docs, f"after-{name}")
    return docs
