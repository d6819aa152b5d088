import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from runtide.llm.queries import PSEUDONYM_KEY
from runtide.llm.pii import pseudonymised
from runtide.llm.quality import train_quality, with_quality
from runtide.llm.shared import read_table
from runtide.llm.simhash import _fingerprint
from tests.conftest import SF


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """300 documents of the test data with odd rows, and the tables beside them."""
    at = str(tmp_path_factory.mktemp("small"))
    docs = read_table(spark, SF, "documents").where("doc_id < 300")
    first = docs.where("doc_id = 7").first()
    leak = read_table(spark, SF, "benchmark").where("length(text) > 200").orderBy("item_id").first()["text"]
    odd = [(9001, None, None, None, None), (9002, "", "en", "x", 0), (None, first["text"], "en", "x", 1), (9003, first["text"], "en", "x", 1), (9003, first["text"], "en", "x", 1)]
    odd += [(None, first["text"] + " " + leak, "en", "x", 1), (9004, "mail to a.person@mail.example.com " + first["text"][::2], "en", "x", 1)]
    docs.union(spark.createDataFrame(odd, docs.schema)).write.parquet(f"{at}/documents.parquet")
    for name in ("labels", "benchmark"):
        read_table(spark, SF, name).write.parquet(f"{at}/{name}.parquet")
    return at


def test_stages_as_plain_loops(spark, small):
    docs = read_table(spark, small, "documents")
    columns = docs.columns
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, small).cache()
        rows[name] = docs.collect()
        if name != "encoding":
            assert docs.columns == columns
        if name == "quality":
            scored = with_quality(before, train_quality(before, read_table(spark, small, "labels")), "s")
            assert sorted(map(str, scored.where("s >= 0.7").drop("s").collect())) == sorted(map(str, rows[name]))
            bad = read_table(spark, small, "labels").join(before, "doc_id").where("quality = 0")
            assert docs.join(bad, "doc_id", "left_semi").count() <= 0.05 * bad.count()
        elif name == "near_dedup":
            source = before.collect()
            prints = [_fingerprint((r["text"] or "").encode(), 3) for r in source]
            group = list(range(len(source)))
            find = lambda i: i if group[i] == i else find(group[i])
            for i in range(len(source)):
                for j in range(i):
                    if (prints[i] ^ prints[j]).bit_count() <= 2:
                        group[find(i)] = find(j)
            want = {}
            for i, r in enumerate(source):
                key = (r["doc_id"] is None, r["doc_id"] or 0)
                want[find(i)] = min(want.get(find(i), (True, 1 << 60)), key)
            assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows[name]) == sorted(want.values())
        elif name == "decontamination":
            items = [" ".join(r["text"].lower().split()) for r in read_table(spark, small, "benchmark").collect()]
            held = lambda r: any(i in " ".join((r["text"] or "").lower().split()) for i in items)
            assert any(held(r) for r in before.collect()) and not any(held(r) for r in rows[name])
            assert len([r for r in before.collect() if not held(r)]) == len(rows[name])
        elif name == "personal_data":
            want = {r["doc_id"]: r["text"] for r in pseudonymised(before, PSEUDONYM_KEY).collect()}
            assert {r["doc_id"]: r["text"] for r in rows[name]} == want
            assert not any("a.person@mail" in (r["text"] or "") for r in rows[name])
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in rows["personal_data"]}
    for r in rows["encoding"]:
        assert r["ids"] == library.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    whole = corpus_pipeline.run(spark, small).select("doc_id", "n_tokens", F.xxhash64("ids")).collect()
    assert sorted(map(str, whole)) == sorted(str(r) for r in docs.select("doc_id", "n_tokens", F.xxhash64("ids")).collect())


def test_empty_and_clashing(spark, small):
    none = read_table(spark, small, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, small).count() == 0
    extra = read_table(spark, small, "documents").limit(20).selectExpr("*", "1 as fp", "2 as row", "'k' as component", "3 as score", "4 as gram")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        extra = stage(spark, extra, small)
        assert extra.columns[-5:] == ["fp", "row", "component", "score", "gram"], name


def test_only_texts_like_leaked_ones_are_shuffled(spark, small, monkeypatch):
    docs, found = read_table(spark, small, "documents"), []
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if very many texts were leaked
    try:
        for buckets in (corpus_pipeline.BUCKETS, 2, 1):
            monkeypatch.setattr(corpus_pipeline, "BUCKETS", buckets)
            rest = corpus_pipeline.decontamination(spark, docs, small)
            found.append(sorted(map(str, rest.collect())))
            assert "BroadcastHashJoin" in (plan := rest._jdf.queryExecution().executedPlan().toString()) and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert found[0] == found[1] == found[2] and 0 < len(found[0]) < docs.count()
