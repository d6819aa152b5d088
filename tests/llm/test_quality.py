import numpy as np

from runtide.llm.quality import FEATURES, PASSAGE_BYTES, QualityModel, encode_passages, fit, train_quality, with_quality
from runtide.llm.shared import read_table, text_buffers
from tests.conftest import SF


def encoded(texts):
    import pyarrow as pa

    data, offsets = text_buffers(pa.array(texts, pa.string()))
    return [x[b:e] for _, x, bag in encode_passages(data, offsets) for b, e in zip(bag[:-1], bag[1:], strict=True)]


def test_passages_cover_every_byte():
    long = "Word of a long text. " * 120_000
    bags = encoded([None, "", "abc DEF 12", long, "x" * PASSAGE_BYTES])
    assert [len(b) for b in bags] == [1, 1, 1, -(-len(long) // PASSAGE_BYTES), 1]
    assert all(b.shape[1] == FEATURES for b in bags)
    assert np.allclose(bags[2][0, :4], [0.3, 0.3, 0.2, 0.2])
    assert bags[0][0, -1] == 1 and (bags[0] == bags[1]).all()


def test_attention_finds_the_bad_passage():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 8, 400)
    bags = np.concatenate(([0], np.cumsum(sizes)))
    x = rng.normal(0, 1, (bags[-1], FEATURES)).astype(np.float32)
    y = (np.arange(400) % 2).astype(np.float32)
    bad = bags[:-1] + rng.integers(0, 100, 400) % sizes
    x[bad[y == 0], 2] += 6
    model = fit(x[: bags[300]], bags[:301], y[:300])
    p = model.scores(x[bags[300] :], bags[300:] - bags[300])
    assert ((p > 0.5) == (y[300:] == 1)).mean() > 0.95


def test_scores_of_held_out_labels(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    model = train_quality(docs, labels)
    scored = with_quality(docs, model, "score")
    pairs = scored.join(labels, "doc_id").where("pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2").collect()
    right = [(r["score"] >= 0.7) == (r["quality"] == 1) for r in pairs]
    assert len(right) > 50 and sum(right) / len(right) > 0.95


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (2, "")], "doc_id long, text string")
    docs = docs.selectExpr("*", "doc_id as y", "text as score")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = train_quality(docs, none)
    assert model == QualityModel(1.0)
    assert [r["q"] for r in with_quality(docs, model, "q").collect()] == [1.0] * 4
    odd = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert train_quality(docs, odd).constant == 1.0
    assert train_quality(docs.limit(0), odd).constant == 1.0
    assert with_quality(docs.limit(0), model).count() == 0


def test_long_documents_teach(spark):
    """Labelled texts above 32 KB only, under text ids: bad ones are bad in some passages all over."""
    rng = np.random.default_rng(21)
    draw = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n))
    rows, labels = [], []
    for k in range(40):
        good = k % 2
        text = " ".join(draw(60) + ("" if good else " |!!| 0000 $$ ## " * 6) for _ in range(100))
        rows.append((f"d{k}", text)), labels.append((f"d{k}", good, 0))
    assert min(len(t) for _, t in rows) > 64 * PASSAGE_BYTES
    docs, known = spark.createDataFrame(rows, "doc_id string, text string"), spark.createDataFrame(labels, "doc_id string, quality int, toxic int")
    model = train_quality(docs, known, longest_bag=16)
    assert model.weights is not None
    fresh = spark.createDataFrame([(1, draw(6000)), (0, " ".join(draw(50) + " |!!| 0000 $$ ## " * 6 for _ in range(100)))], "good int, text string")
    got = {r["good"]: r["s"] for r in with_quality(fresh, model, "s").collect()}
    assert got[1] > 0.7 > got[0]
