import random

import numpy as np
import pyarrow as pa

from runtide.llm import decontaminate
from runtide.llm.decontaminate import align, contaminated
from runtide.llm.shared import grams, text_buffers, words


def plain_align(a, b):
    best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_the_plain_one():
    rng = random.Random(4)
    for _ in range(60):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(0, 20))] for _ in range(2))
        assert align(np.array(a, np.uint32), np.array(b, np.uint32))[0] == plain_align(a, b)


def test_words_of_all_texts():
    texts = ["One two, ONE!", None, "", "é É zwei", "x" * 3_000_000, "a " * 900_000 + "one", "one"]
    data, offsets = text_buffers(pa.array(texts))
    h, start, stop, of_text = words(data, offsets)
    assert np.diff(of_text).tolist() == [3, 0, 0, 3, 1, 900_001, 1]
    assert h[0] == h[2] == h[-1] == h[-2] and h[3] == h[4] and h[0] != h[1]
    assert data[start[-1] : stop[-1]].tobytes() == b"one" and data[start[1] : stop[1]].tobytes() == b"two"
    g, whole = grams(h[:8], np.array([0, 3, 3, 3, 6, 7, 8]), 2)
    assert whole.tolist() == [True, True, False, True, True, False, False]


def test_leaks_are_found_and_clean_texts_left(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(400)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, draw(30)) for i in range(8)]
    docs, want = [], set()
    for i, words_ in items:
        docs.append((10 * i, draw(50) + words_ + draw(40)))
        edited = list(words_)
        for k in (5, 14, 23):
            edited[k] = "changed"
        docs.append((10 * i + 1, draw(20) + [w.upper() + "," for w in edited] + draw(2000)))
        docs.append((10 * i + 2, words_[:8] + draw(60)))
        docs.append((10 * i + 3, draw(200)))
        want |= {(10 * i, i), (10 * i + 1, i)}
    docs = [(k, " ".join(w)) for k, w in docs]
    docs += [docs[0], (None, docs[0][1]), (900, None), (901, ""), *((1000 + k, docs[0][1]) for k in range(300))]
    want |= {(None, 0)} | {(1000 + k, 0) for k in range(300)}
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "doc_id as item_id", "text as words")
    bench = spark.createDataFrame(
        [*((i, " ".join(w)) for i, w in items), (50, None), (51, "too short"), (None, docs[3][1]), (0, "~ later text")],
        "item_id long, text string",
    )
    got = contaminated(frame, bench).collect()
    assert len(got) == len(want) and {(r["doc_id"], r["item_id"]) for r in got} == want
    assert {r["score"] for r in got if r["doc_id"] == 0} == {1.0}
    assert all(0.5 <= r["score"] < 1 for r in got if r["doc_id"] and r["doc_id"] % 10 == 1 and r["doc_id"] < 900)
    assert contaminated(frame.limit(0), bench).count() == 0
    assert contaminated(frame, bench.limit(0)).count() == 0


def test_edits_every_few_words_equal_alignment_of_all_pairs(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(3000)]
    items = [(i, rng.sample(vocabulary, 15 + i % 3)) for i in range(12)]
    docs = []
    for i, words_ in items:
        for every in (5, 6):
            # The first half of the items also leaks as it is.
            copies = [words_] * (i < 6) + [[f"new{k}" if k % every == every - 1 else w for k, w in enumerate(words_)]]
            docs += [(len(docs) + k, rng.sample(vocabulary, 40) + c + rng.sample(vocabulary, 40)) for k, c in enumerate(copies)]
    # Words put in at one place: the seed lies a whole item's length before the end of the alignment.
    docs.append((len(docs), items[0][1][:5] + rng.sample(vocabulary, 9) + items[0][1][5:]))
    docs.append((len(docs), [w for _ in range(40) for w in items[1][1] + rng.sample(vocabulary, 20)]))
    want = {}
    for d, text in docs:
        for i, words_ in items:
            score = align(*(np.array([hash(w) & 0xFFFFFFFF for w in x], np.uint32) for x in (words_, text)))[0] / (2 * len(words_))
            if score >= 0.5:
                want[d, i] = score
    frame, bench = (
        spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{name} long, text string") for rows, name in ((docs, "doc_id"), (items, "item_id"))
    )
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in contaminated(frame, bench).collect()}
    assert len(want) >= 36 and got == want


def test_common_grams_are_no_seeds_where_rare_ones_are_left(spark, monkeypatch):
    rng = random.Random(7)
    draw = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line = "all rights reserved by the authors of this text".split()
    half, whole = line[:4] + draw(14), list(line)  # an item with a common run, and one that is nothing else
    docs = [(k, " ".join(draw(10) + line + draw(10))) for k in range(150)]
    docs += [(900, " ".join(draw(30) + half + draw(30))), (901, " ".join(draw(5) + draw(3000) + draw(5)))]
    bench = spark.createDataFrame([(1, " ".join(half)), (2, " ".join(whole)), (3, " ".join(draw(2500)))], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    seen = []
    plain = decontaminate.seed_passages
    monkeypatch.setattr(decontaminate, "seed_passages", lambda d, k, seeds, n: seen.extend(seeds.collect()) or plain(d, k, seeds, n))
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(frame, bench).collect()}
    assert got == {(900, 1)} | {(k, 2) for k in range(150)}
    # Of the first item only grams beyond the common run; the long third one widens no other's margin.
    assert max(r["margin"] for r in seen) == 2 * 18
