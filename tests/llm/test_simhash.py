import numpy as np
import xxhash

from runtide.llm.shared import components
from runtide.llm.simhash import _fingerprint, fingerprint_links, home_anchors, near_anchors, one_of_each_group, simhash_groups


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_of_texts():
    for text in ("", " \n", "One", "a b", "a b c d E f é g  h\x0bi", "x " * 400):
        assert _fingerprint(text.encode(), 3) == plain_fingerprint(text)
    text = "alpha beta gamma delta epsilon zeta eta"
    assert _fingerprint(text.encode(), 3, slab=2) == plain_fingerprint(text)


def test_anchors_cover_all_within_reach():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, 200, dtype=np.uint64)
    row, anchor = near_anchors(fps, 3, 2)
    reached = set(zip(row.tolist(), anchor.tolist(), strict=True))
    assert len(reached) == len(row)
    for i, x in enumerate(fps.tolist()):
        for _ in range(20):
            y = x ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64)))
            assert (i, int(home_anchors(np.array([y], np.uint64), 3)[0])) in reached


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    fps = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 60)]
    for x in fps[:40]:
        for k in (1, 2, 3):
            y = x % 2**64
            for bit in rng.choice(64, k, replace=False):
                y ^= 1 << int(bit)
            fps.append(y - 2**64 if y >= 2**63 else y)
    fps = sorted(set(fps))
    want = {(x, y) for x in fps for y in fps if x < y and ((x ^ y) % 2**64).bit_count() <= 2}
    got = fingerprint_links(spark.createDataFrame([(x,) for x in fps], "fp long"), 2).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_components_of_chain_star_and_nothing(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_of_odd_rows(spark):
    rows = [(5, "a b c d", 1), (3, "A  B c\td", 1), (9, None, 2), (8, "", 2), (8, "", 2), (None, "a b c d", 3), (1, "z", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int").withColumn("component_id", F_lit())
    got = sorted(((r[0], r[2]) for r in simhash_groups(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 8), (8, 8), (8, 8), (None, 3), (1, 1)], key=str)
    assert simhash_groups(docs.limit(0)).count() == 0
    assert simhash_groups(spark.createDataFrame([(None, "q")], "doc_id long, text string")).first()["component_id"] is None


def test_one_of_each_group_whatever_the_columns(spark):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (7, "quite another text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as __fp", "'r' as __row", "2 as fp", "3 as row", "4 as __gone")
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 7]


def F_lit():
    from pyspark.sql import functions as F

    return F.lit("clash")
