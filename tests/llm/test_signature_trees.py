import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from runtide.llm import signature_trees
from runtide.llm.queries import ORACLE_SQL, QUERIES
from runtide.llm.signature_trees import _bitmap, _spanning, block_pairs, similar_groups, similar_sets
from tests.conftest import SF

NAME = "op13_signature_tree_join"


def plain_set(text, n=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def plain(rows, n=5, least=80):
    sets = [plain_set(text, n) for _, text in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) and part[i] != part[j]:
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    out = []
    for k, (doc, _) in enumerate(rows):
        ids = [rows[i][0] for i in range(len(rows)) if part[i] == part[k] and rows[i][0] is not None]
        out.append((doc, len(sets[k]), min(ids, default=None)))
    return sorted(out, key=repr)


def check(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "3 as row", "'x' as class", "1 as n", "2 as token").repartition(3)
    assert sorted(map(tuple, similar_groups(docs, **settings).collect()), key=repr) == plain(rows, **settings)


def edited(rng, words, share):
    return [rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words]


def corpus(seed, groups=12, members=9):
    """Groups of edited copies around the threshold, all with a common passage, and a hot group of very near copies."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(12)]
    texts = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(rng.choice((8, 30, 60, 130)))]
        for m in range(members):
            texts.append(" ".join(passage * (m % 3 == 0) + edited(rng, base, rng.choice((0.0, 0.01, 0.02, 0.04)))))
    base = [f"h{k}" for k in range(90)]
    texts += [" ".join([*base[:k], "Z", *base[k:]]) for k in range(60)] + [" ".join(base)] * 40 + [" ".join(passage)] * 5
    rng.shuffle(texts)
    return list(enumerate(texts, 10))


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # hot blocks in many chunks, deep trees, all joins in a shuffle
        for name, value in (("CHUNK", 7), ("HELD", 9), ("SEEN", 3), ("TRIED", 1), ("FAN", 2), ("_STEP", 64), ("BROADCAST_ROWS", 0)):
            monkeypatch.setattr(signature_trees, name, value)
    check(spark, corpus(1))


def test_other_lengths_and_thresholds(spark):
    check(spark, corpus(2, 6, 6), n=2, least=60)
    check(spark, corpus(3, 6, 6), n=1, least=95)


def test_signatures_rule_out_no_similar_pair():
    rng = np.random.default_rng(6)
    for least in (50, 80):
        sets = []
        for _ in range(60):
            base = rng.integers(0, 2**63, int(rng.integers(1, 400)), dtype=np.uint64)
            for _ in range(4):
                some = base[rng.random(len(base)) < rng.choice((0.8, 0.9, 1.0))]
                sets.append(np.unique(np.concatenate((some, rng.integers(0, 2**63, 1 + len(base) // 20, dtype=np.uint64)))))
        part = np.arange(len(sets))
        part[:8] = 0
        got = [(int(x), int(y)) for a, b, _ in block_pairs([_bitmap(s).tobytes() for s in sets], np.array([len(s) for s in sets]), part, least) for x, y in zip(a, b, strict=True)]
        assert len(set(map(frozenset, got))) == len(got) and all(part[x] != part[y] for x, y in got)
        for i, x in enumerate(sets):
            for j in range(i):
                common = len(np.intersect1d(x, sets[j]))
                if 100 * common >= least * (len(x) + len(sets[j]) - common) and part[i] != part[j]:
                    assert (i, j) in got or (j, i) in got
        assert len(got) < len(sets) ** 2 / 8  # most pairs are ruled out
        maps, sizes = [_bitmap(s).tobytes() for s in sets], np.array([len(s) for s in sets])
        joined = part.copy()
        for x, y in _spanning(block_pairs(maps, sizes, part, least), part):
            assert joined[x] != joined[y]
            joined[joined == joined[y]] = joined[x]
        assert all(joined[x] == joined[y] for x, y in got)


def test_odd_rows(spark):
    rows = [(5, None), (4, ""), (3, " \n\t"), (2, "One two"), (9, "one  TWO"), (None, "one two"), (None, "alone words here"), (7, "É a b c d e"), (8, "é a b c d e")]
    rows += [(20, "w " * 30_000), (21, "w " * 31_000), (22, " ".join(f"t{k}" for k in range(30_000))), (23, " ".join(f"t{k}" for k in range(100, 30_100))), (2, "One two")]
    check(spark, rows)
    assert similar_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    sets, links = similar_sets(spark.createDataFrame([(22, rows[11][1]), (23, rows[12][1])], "doc_id long, text string"))
    assert sets.columns == ["row", "doc_id", "text", "n", "digest", "class"]
    assert [r["common"] for r in links.collect()] == [29_896]


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = duck.sql(ORACLE_SQL[NAME])
    got = QUERIES[NAME](spark, SF)
    assert [k for _, k in got.dtypes] == ["bigint"] * 3 and [str(t) for t in want.types] == ["BIGINT"] * 3
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_lists_of_rare_shingles_stay_where_they_are(spark):
    described = spark.createDataFrame([(k, f"d{k % 7}" if k else None, [k, 9]) for k in range(10)], "row long, digest string, rare array<long>")
    described = described.selectExpr("row", "cast(digest as binary) as digest", "rare")
    classes = described.where("digest is not null").groupBy("digest").agg(F.min("row").alias("class"), F.count("*").alias("df"))
    found = signature_trees._representatives(described, classes)
    assert sorted(r["row"] for r in found.collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


def test_representatives_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(signature_trees, "BROADCAST_ROWS", 1)
    check(spark, corpus(5, groups=5))


def test_blocks_of_a_lead_get_each_bitmap_once(spark):
    # Many blocks of the same few sets, one that is large and one that is too large for a task.
    shared = [(t, c, 40) for t in range(60) for c in range(6) if c == 0 or t >> (c - 1) & 1]
    shared += [(100, c, 40) for c in range(200)] + [(101, c, 40) for c in range(5000)]
    blocks = signature_trees._blocks(spark.createDataFrame(shared, "token long, class long, n long"), 80)
    described = spark.range(5000).select(F.col("id").alias("row"), F.lit(b"12345678").alias("bitmap"))
    for every, chunks in ((False, 2), (True, 3)):
        sent = signature_trees._sent(blocks.withColumn("part", F.col("class")), described, every).collect()
        assert len({(r["task"], r["class"]) for r in sent}) == len(sent) and all(r["bitmap"] == b"12345678" for r in sent)
        places = sorted((bytes(p["block"]), p["i"], p["j"], r["class"]) for r in sent for p in r["places"])
        assert len(set(places)) == len(places) == blocks.where("df <= 2048").count() + 5000 * chunks
        small = blocks.where("df <= 64")
        # At most one row for each set of a lead, which the 32 blocks have in common far more than not.
        assert len([r for r in sent if len(r["places"]) > 1]) and len(sent) - 200 - 5000 * chunks <= small.count() / 2
