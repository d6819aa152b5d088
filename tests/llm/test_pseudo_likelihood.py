import random

import numpy as np
import pyarrow as pa

from runtide.llm import pseudo_likelihood
from runtide.llm.pseudo_likelihood import (
    FREQUENT, GROUP, OTHERS, SYMBOLS, _Reader, first_weights, flat, learn_batch, log_probabilities, score_documents, train, unflat, vocabulary, with_pseudo_likelihood, within_classes, word_counts,
)
from runtide.llm.shared import read_table, text_buffers, words
from tests.conftest import SF


def test_probabilities_of_all_words_sum_to_one():
    rng = np.random.default_rng(12)
    w = {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in first_weights().items()}
    padded = rng.integers(0, SYMBOLS, 9)
    total = 0.0
    for symbol in range(SYMBOLS):
        padded[4] = symbol
        total += np.exp(log_probabilities(w, padded, np.array([4]))[0])
    assert abs(total - 1) < 1e-3 and GROUP * GROUP == SYMBOLS
    assert (flat(unflat(flat(w))) == flat(w)).all()


def test_gradient_steps_raise_the_likelihood():
    rng = np.random.default_rng(13)
    padded = np.tile(rng.integers(0, SYMBOLS, 12), 400)
    place, w = np.arange(2, len(padded) - 2), first_weights()
    seen = {k: np.full_like(v, 1e-4) for k, v in w.items()}
    before = log_probabilities(w, padded, place).mean()
    for _ in range(60):
        learn_batch(w, seen, padded, place, 0.1)
    assert log_probabilities(w, padded, place).mean() > before + 3


def test_shuffled_texts_score_lower(spark):
    docs = read_table(spark, SF, "documents").select("doc_id", "text")
    known = vocabulary(docs)
    weights = train(docs.where("doc_id % 5 > 0"), known)
    held = docs.where("doc_id % 5 = 0").collect()
    rng = random.Random(14)
    rows = []
    for r in held:
        words = r["text"].split()
        rng.shuffle(words)
        rows += [(r["doc_id"], r["text"], 0), (r["doc_id"], " ".join(rng.choices(["zq", "qz9", "xx7y", "vvw"], k=len(words))), 1)]
    got = with_pseudo_likelihood(spark.createDataFrame(rows, "doc_id long, text string, kind int"), known, weights).collect()
    mean = lambda kind: np.mean([r["log_likelihood"] / r["n_words"] for r in got if r["kind"] == kind and r["n_words"]])
    plain = -np.log(SYMBOLS)
    assert mean(0) > plain + 0.5 and mean(0) > mean(1)


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "..."), (2, "one two"), (2, "one two"), (3, "long " * 400_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as word", "8 as n")
    got = sorted(((r["n_words"], r["log_likelihood"]) for r in score_documents(docs).collect()))
    assert got[0] == got[1] == got[2] == (0, 0.0) and got[3] == got[4] and got[3][1] < 0 and got[5][0] == 400_000
    assert score_documents(docs.limit(0)).count() == 0
    a, padded, place, of_text = next(_Reader(np.zeros(0, np.uint64)).documents(pa.array(["a b", "", "c"])))
    assert of_text.tolist() == [0, 2, 2, 3] and place.tolist() == [2, 3, 8] and len(padded) == 11


def test_rare_words_of_a_class_score_by_their_own_counts(spark):
    many = [f"w{k}" for k in range(FREQUENT)]
    hashes = words(*text_buffers(pa.array([" ".join(f"r{k}" for k in range(3000))])))[0]
    same = np.flatnonzero((hashes & np.uint64(OTHERS - 1)) == (hashes[0] & np.uint64(OTHERS - 1)))[:3]
    a, b, c = (f"r{k}" for k in same)
    rows = [(" ".join(many * 9),), *[(f"w1 {a} w2",)] * 4, (f"w1 {b} w2",), (None,)]
    docs = spark.createDataFrame(rows, "text string")
    got = {r["text"]: r["log_likelihood"] for r in score_documents(docs).collect()}
    assert abs(got[f"w1 {a} w2"] - got[f"w1 {b} w2"] - np.log(4)) < 1e-5
    counts = word_counts(docs)
    found = within_classes(spark.createDataFrame([(f"{b} {c} {c}",), ("w1",)], "text string"), vocabulary(docs, counts), counts).collect()
    assert sorted(round(r["within"], 6) for r in found) == [round(3 * np.log(1 / 6), 6), 0.0]


def test_every_word_is_learned_once(spark, monkeypatch):
    docs = spark.createDataFrame([("one",), ("one two",), ("a b c d e f g h i",)], "text string").coalesce(1)
    # Documents of one word alone teach something too.
    before = flat(first_weights())
    assert (flat(train(docs.where("text = 'one'"), np.zeros(0, np.uint64))) != before).any()
    taken = []

    class Plain:
        def mapInArrow(self, run, kinds):
            list(run(iter([pa.RecordBatch.from_arrays([pa.array(["one", "one two", "a b c d e f g h i"])], ["text"])])))
            return docs.sparkSession.createDataFrame([], kinds)

    class Docs:
        sparkSession = spark
        select = lambda self, _: Plain()

    monkeypatch.setattr(pseudo_likelihood, "learn_batch", lambda w, seen, padded, here, rate: taken.extend(here.tolist()))
    train(Docs(), np.zeros(0, np.uint64))
    _, _, place, _ = next(_Reader(np.zeros(0, np.uint64)).documents(pa.array(["one", "one two", "a b c d e f g h i"])))
    assert sorted(taken) == place.tolist()


def test_texts_are_read_twice(spark):
    rows = [(k, f"w{k} one two " + "three " * k) for k in range(50)] + [(50, None)]
    read = spark.sparkContext.accumulator(0)

    def tally(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    docs = spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(tally, "doc_id long, text string")
    for columns in (None, ["doc_id"]):
        before = read.value
        got = score_documents(docs, *([columns] if columns else []))
        assert len(got.collect()) == 51 and got.columns == [*(columns or docs.columns), "n_words", "log_likelihood"]
        assert read.value - before == 2 * 51


def test_words_that_tasks_hold_score_as_joined_ones(spark, monkeypatch):
    many = " ".join(f"w{k}" for k in range(FREQUENT)) + " "
    docs = spark.createDataFrame([(many * 9,), ("a b c d d x1 x2 é",), ("d a",), ("d a",), ("",), (None,)], "text string").coalesce(1)
    counts, want = word_counts(docs), None
    for held in (1 << 16, 6, 3, 0):
        monkeypatch.setattr(pseudo_likelihood, "HELD", held)
        found = sorted((r["key"] or 0, round(r["within"], 9)) for r in within_classes(docs, vocabulary(docs, counts), counts).collect())
        assert want in (None, found) and len(found) == 5 and min(v for _, v in found) < -1
        want = found
