import hashlib
import random

import numpy as np
import pyarrow as pa

from runtide.llm.minhash import _STEP, _shingles, edited_neighbours, likeness, signatures, similar_pairs
from runtide.llm.shared import text_buffers


def of(texts):
    return signatures(*text_buffers(pa.array(texts, pa.string())))


def test_signatures_estimate_jaccard():
    rng = random.Random(7)
    base = [str(rng.random()) for _ in range(_STEP + 500)]
    other = base[: _STEP // 2] + [str(rng.random()) for _ in range(2500)]
    one = {tuple(base[i : i + 5]) for i in range(len(base) - 4)}
    two = {tuple(other[i : i + 5]) for i in range(len(other) - 4)}
    rows = of([" ".join(base), " ".join(other), " ".join(base) + " ", "", None, "a b", "a  b", "a c"])
    assert abs(likeness(rows[0], rows[1]) - len(one & two) / len(one | two)) < 0.2
    assert (rows[0] == rows[2]).all() and (rows[3] == rows[4]).all() and (rows[5] == rows[6]).all() and likeness(rows[5], rows[7]) < 0.2
    # Alone or among others, a text has the same signature.
    assert (of([" ".join(other)])[0] == rows[1]).all()
    assert len(_shingles(*text_buffers(pa.array(["a b c d e f", "", "a b", "x y z u v w"])))[0]) == 5


def plain(rows):
    order = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0), hashlib.sha256((r[1] or "").encode()).digest()), reverse=True)
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        text, following = text or "", following or ""
        half = len(text) // 2
        yield doc, len(text), text[: len(text) - half] + following[:half], text, following


def check(spark, rows, ranges):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as fingerprint", "1 as share").repartition(3)
    got = edited_neighbours(frame, ranges).collect()
    want = [
        (doc, n, hashlib.sha256(edited.encode()).hexdigest(), *(x.astype(">u4").tobytes().hex() for x in of([text, edited])), *(float(likeness(of([text])[0], of([x])[0])) for x in (edited, following)))
        for doc, n, edited, text, following in plain(rows)
    ]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_neighbours_as_spelled_out(spark):
    rng = random.Random(8)
    text = lambda n: " ".join("".join(rng.choices("abcé日", k=3)) for _ in range(n))
    rows = [(i * 7 % 101 * 3, text(rng.randrange(0, 60))) for i in range(101)]
    check(spark, rows, 1)
    check(spark, rows, 16)
    check(spark, [*rows, rows[5], rows[5], (rows[5][0], "other"), (None, "q r s"), (None, None), (-5, None), (10**12, "")], 8)
    check(spark, [(1, "only one row of many words")], 4)
    check(spark, [(1, "same"), (1, "same")], 4)
    check(spark, [(2, "x" * 300_000), (1, "word " * 60_000)], 4)
    assert edited_neighbours(spark.createDataFrame([], "doc_id long, text string"), 4).count() == 0


def test_similar_pairs_verified(spark):
    rng = random.Random(9)
    draw = lambda n: [str(rng.randrange(10**6)) for _ in range(n)]
    docs, want = [], set()
    for i in range(12):
        base = draw(200)
        near = base[:100] + ["new"] + base[101:]
        half = base[:100] + draw(100)
        docs += [(4 * i, base), (4 * i + 1, near), (4 * i + 2, half), (4 * i + 3, base)]
        want.add((4 * i, 4 * i + 1))
    docs = [(k, " ".join(w)) for k, w in docs] + [(900, None), (901, ""), (None, "a b c d e f g"), (None, "a b c d e f g")]
    members, pairs = similar_pairs(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as digest"))
    assert {(r["a"], r["b"]) for r in pairs.collect()} == want
    found = [(r["doc_id"], r["class_id"]) for r in members.collect()]
    assert len(found) == len(docs) and (3, 0) in found and (901, 900) in found and (None, None) in found
    assert np.array([r["jaccard"] for r in pairs.collect()]).min() >= 0.8
