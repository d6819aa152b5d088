import hashlib
import random

import numpy as np
import pytest

from runtide.llm import suffixes
from runtide.llm.suffixes import LENGTH, suffix_order, without_repeats


def plain(rows):
    seen, out = set(), []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - LENGTH + 1):
            part = raw[i : i + LENGTH]
            if part in seen:
                gone[i : i + LENGTH] = [True] * LENGTH
            seen.add(part)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_order_equals_sorting():
    rng = np.random.default_rng(3)
    for n, most in ((0, 3), (1, 3), (2, 3), (3, 1), (50, 2), (400, 2), (400, 256), (900, 4)):
        t = rng.integers(0, most + 1, n)
        if n == 900:
            t[300:600] = t[:300]  # long repeats
            t[700:] = 1
        order = suffix_order(t, 100)
        assert sorted(order.tolist()) == list(range(n))
        padded = t.tolist() + [0] * 200
        heads = [tuple(padded[i : i + 100]) for i in order.tolist()]
        assert heads == sorted(heads)


def test_suffix_order_of_repeats_beyond_the_names():
    # Equal over more values than names tell, and told apart after that.
    for seed in (2, 5, 8, 11):
        rng = np.random.default_rng(seed)
        block = rng.integers(1, 3, rng.integers(245, 270))
        t = np.concatenate([x for _ in range(32) for x in (block[rng.integers(0, 3) :], rng.integers(0, 4, rng.integers(1, 4)))])
        order = suffix_order(t, 100)
        assert sorted(order.tolist()) == list(range(len(t)))
        padded = t.tolist() + [0] * 100
        heads = [tuple(padded[i : i + 100]) for i in order.tolist()]
        assert heads == sorted(heads)


@pytest.mark.parametrize("many", [16, 2])
def test_removal_as_spelled_out(spark, monkeypatch, many):
    monkeypatch.setattr(suffixes, "MANY", many)  # with 2, starts of nearly all repeated anchors are dealt one by one
    monkeypatch.setattr(suffixes, "_BATCH", 1 << 11)
    rng = random.Random(15)
    draw = lambda n: "".join(rng.choices("abcdé fgh日", k=n))
    base, passage, line = draw(900), draw(150), draw(99)
    texts = [
        base, base, base[:300] + "X" + base[301:], draw(50) + passage + draw(70), passage, passage[:-1], draw(30) + passage + draw(10) + passage, "ab" * 300, "ab" * 250 + "c",
        line, line, None, "", "x" * 99, "x" * 100, "x" * 101, base[450:] + base[:450], draw(2000), base[100:199] + "!" + base[200:330], "y" + base[7:120],
    ]
    rows = [(k, t) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as i").repartition(3)
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in without_repeats(frame).collect())
    assert got == plain(rows)


def test_odd_rows(spark):
    text = "many different words of one text " + "".join(map(str, range(100)))
    frame = spark.createDataFrame([(None, text), (4, text), (4, text), (4, None)], "doc_id int, text string")
    got = sorted(((r["doc_id"] is None, r["n_bytes"], r["n_removed"]) for r in without_repeats(frame).collect()))
    n = len(text)
    assert got == [(False, 0, 0), (False, n, 0), (False, n, n), (True, n, n)]
    assert without_repeats(frame.limit(0)).count() == 0
