import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from runtide.llm import strtree
from runtide.llm.queries import ORACLE_SQL, QUERIES
from runtide.llm.strtree import Tree, hard_negatives
from tests.conftest import SF

NAME = "op11_strtree_hard_negatives"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every=100, positives=5, negatives=5, least=80, most=100):
    kept = []
    for vec_id, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    key = lambda s: (-s[0], s[1] is None, s[1] or 0)
    for k, (anchor, label, q) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        scores = [(sum(a * b for a, b in zip(q, o, strict=False)), i, lab) for j, (i, lab, o) in enumerate(kept) if j != k]
        for ps, p, _ in sorted((s for s in scores if s[2] == label), key=key)[:positives]:
            found = sorted((s for s in scores if s[2] != label and least * ps <= 100 * s[0] <= most * ps), key=key)
            yield from ((anchor, p, r + 1, n, ps, ns) for r, (ns, n, _) in enumerate(found[:negatives]))


def check(spark, rows, **settings):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "1 as row", "'x' as tile", "2 as rank").repartition(3)
    every = settings.pop("every", 100)
    got = hard_negatives(frame, F.col("vec_id") % every == 0, **settings)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(rows, every, **settings), key=repr)


def test_tree_equals_brute_force():
    rng = np.random.default_rng(4)
    points = rng.integers(-200, 200, (3000, 8)).astype(float)
    points[1000:2000] = points[0]  # a third of the rows are equal
    labels, ids, rows = rng.integers(0, 3, 3000), rng.permutation(3000), np.arange(3000)
    tree = Tree(points, labels, ids, rows)
    assert np.diff(tree.start).max() <= strtree.LEAF_ROWS and sorted(tree.rows) == list(rows)
    for r in range(0, 3000, 250):
        low, high = np.array([-1e9, 1000.0, 5.0]), np.array([1e9, 30_000.0, -5.0])
        for same in (True, False):
            got = [(w, int(tree.rows[n]), s) for w, n, s in tree.search(points[r], r, labels[r], same, low, high, 7)]
            score = points @ points[r]
            want = []
            for w in range(3):
                fit = np.flatnonzero((score >= low[w]) & (score <= high[w]) & ((labels == labels[r]) == same) & (rows != r))
                want += [(w, int(i), int(score[i])) for i in sorted(fit, key=lambda i: (-score[i], ids[i]))[:7]]
            assert sorted(got) == sorted(want)


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # many tiles, hot ones in pieces, anchors in blocks
        for name, value in (("TILE_ROWS", 40), ("PIECE_ROWS", 30), ("ANCHORS", 5), ("LEAF_ROWS", 4), ("FAN", 2)):
            monkeypatch.setattr(strtree, name, value)
    rng = random.Random(2)
    rows = [(k, rng.randrange(4), [rng.gauss(0, 0.3) for _ in range(6)]) for k in range(300)]
    rows += [(k, rng.randrange(2), [0.5, 0.5, 0.5, 0.5, 0.0, 0.0]) for k in range(300, 420)]
    check(spark, rows, every=20)
    check(spark, rows[:60], every=7, positives=2, negatives=9, least=50, most=90)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (100, None, [1.0, 1.0]), (200, 1, None), (300, 2, [nan, 1.0]), (400, 2, [inf, 1.0]), (500, 2, [None, 1.0])]
    rows += [(None, 1, [0.9, 0.5]), (None, 2, [0.9, 0.5]), (600, 2, []), (700, 3, [0.25]), (1, 2, [0.9, 0.5]), (2, 1, [-1.0, -1.0]), (3, 4, [1.0, 0.4, 9.0])]
    check(spark, rows)
    check(spark, [(100, 1, []), (2, 1, []), (3, 2, [])])
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives(empty, F.col("vec_id") % 100 == 0).count() == 0
    check(spark, [(100, 1, [2.0**22, 3.0]), (5, 1, [2.0**22, 1.0]), (7, 2, [2.0**22, 0.5])])
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives(spark.createDataFrame([(0, 1, [1e30])], empty.schema), F.col("vec_id") % 100 == 0)


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    got = QUERIES[NAME](spark, SF)
    want = duck.sql(ORACLE_SQL[NAME])
    assert [str(t) for t in want.types] == ["BIGINT", "BIGINT", "INTEGER", "BIGINT", "BIGINT", "BIGINT"] and [k for _, k in got.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
