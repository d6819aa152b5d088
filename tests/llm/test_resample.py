import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from runtide.llm import resample
from runtide.llm.queries import QUERIES
from runtide.llm.resample import features, importance_ranks, radix_ranks
from runtide.llm.shared import text_buffers
from tests.conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain(docs, target):
    """(doc_id, n_features, weight, score, rank) by loops."""
    corpus, wanted = np.zeros(10_000, int), np.zeros(10_000, int)
    made = [(doc, *plain_features(text)) for doc, text in docs]
    for _, _, found in made:
        np.add.at(corpus, found, 1)
    for text in target:
        np.add.at(wanted, plain_features(text)[1], 1)
    S, T = int(corpus.sum()), int(wanted.sum())
    gain = [math.floor(1000 * math.log((int(t) + 1) * (S + 10_000) / ((int(s) + 1) * (T + 10_000)))) for s, t in zip(corpus, wanted, strict=True)]
    out = []
    for doc, n, found in made:
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    pool = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(pool[: 5 * len(pool) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("slice_bytes", [1 << 20, 40, 7])
def test_features_equal_plain_ones_in_pieces_of_any_size(monkeypatch, slice_bytes):
    monkeypatch.setattr(resample, "SLICE_BYTES", slice_bytes)
    rng = random.Random(3)
    texts = ["", None, "One", "ab-cd  É é\x7fA{b", "a" * 62 + " " + "b" * 63 + " " + "c" * 64 + " " + "d" * 65, "x " * 30, "\x00", "e" * 5000 + " f g"]
    texts += [" ".join("".join(rng.choice("abÄ9") for _ in range(rng.randrange(1, 90))) for _ in range(rng.randrange(9))) for _ in range(40)]
    got = [[] for _ in texts]
    for found, text, _ in features(*text_buffers(pa.array(texts, pa.string())), 10_000):
        for b, t in zip(found.tolist(), text.tolist(), strict=True):
            got[t].append(b)
    assert [sorted(x) for x in got] == [sorted(plain_features(t)[1]) for t in texts]


def test_ranks_equal_sorting(spark, monkeypatch):
    monkeypatch.setattr(resample, "BLOCK_BITS", 4)
    monkeypatch.setattr(resample, "DIGIT_BITS", 3)
    rng = random.Random(5)
    # A third of the rows have one score; null keys, ties and negative values.
    data = [(k, 77 if k % 3 else rng.randrange(-300, 300), None if k % 50 == 0 else rng.randrange(40)) for k in range(400)]
    frame = spark.createDataFrame(data, "row long, score long, id long").repartition(5)
    got = {r["row"]: r["rank"] for r in radix_ranks(frame, "row", [("score", True), ("id", False)]).collect()}
    order = sorted(data, key=lambda r: (-r[1], r[2] is None, r[2] or 0))
    assert sorted(got.values()) == list(range(1, 401))
    by_rank = sorted(data, key=lambda r: got[r[0]])
    assert [r[1:] for r in by_rank] == [r[1:] for r in order]
    assert radix_ranks(frame.limit(0), "row", [("score", True)]).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, None)], "row long, score long")
    assert sorted(r["rank"] for r in radix_ranks(nulls, "row", [("score", False)]).collect()) == [1, 2]


def test_odd_rows(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(50)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for k in range(120)]
    rows += [(7, None), (None, " ".join(words)), (None, ""), (500, ""), (501, "w1 " * 9000), (501, "w1 " * 9000), (502, "W2 " * 40), (503, "w2 " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "9 as rank", "'x' as score", "0 as row")
    target = spark.createDataFrame([("w2 w2 w2 w3",), (None,)], "text string")
    got = sorted((tuple(r) for r in importance_ranks(docs, target).collect()), key=repr)
    assert got == plain(rows, ["w2 w2 w2 w3", None])
    assert importance_ranks(docs.limit(0), target).count() == 0
    assert importance_ranks(docs, target.limit(0)).count() == len(rows)


def test_query_equals_loops(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = QUERIES["op12_importance_resampling"](spark, SF)
    assert {k for _, k in got.dtypes} == {"bigint"}
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, target)
