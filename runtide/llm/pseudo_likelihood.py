"""Masked pseudo-likelihood: a bidirectional window network in numpy predicts every word from both sides."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtide.llm.shared import settle, slices, text_buffers, with_columns, words

#: Frequent words with an id of their own, and hash classes for all others; an id is a group (id // 32) and a member (id % 32).
FREQUENT, OTHERS, GROUP = 768, 256, 32
SYMBOLS, PAD = FREQUENT + OTHERS, FREQUENT + OTHERS
WINDOW, DIM, HIDDEN, BATCH, SCORED = 2, 16, 32, 4096, 16384
#: Words without an id of their own whose share of their class every task holds, the most frequent ones; the others meet it in a join.
HELD = 1 << 16
SHAPES = {
    "E": (SYMBOLS + 1, DIM), "W": (2 * WINDOW * DIM, HIDDEN), "b": (HIDDEN,), "A": (HIDDEN, SYMBOLS // GROUP), "a": (SYMBOLS // GROUP,),
    "B": (SYMBOLS // GROUP, HIDDEN, GROUP), "c": (SYMBOLS // GROUP, GROUP),
}
Weights = dict[str, np.ndarray]


def first_weights() -> Weights:
    rng = np.random.default_rng(6)
    return {k: (rng.normal(0, 0.1, s) if len(s) > 1 and k != "c" else np.zeros(s)).astype(np.float32) for k, s in SHAPES.items()}


def flat(w: Weights) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES])


def unflat(values: np.ndarray) -> Weights:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = values[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): hashes of all words of all texts, and how often each occurs."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            for a, b in slices(offsets, 1 << 24):
                h, *_ = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                word, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, counts: DataFrame | None = None) -> np.ndarray:
    """Hashes of the most frequent words, most frequent first; ties by hash. At most FREQUENT values reach the driver."""
    top = (word_counts(docs) if counts is None else counts).orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    return np.array([r["word"] for r in top], np.int64).view(np.uint64)


class _Reader:
    """Word ids of texts, with two pads around each document."""

    def __init__(self, known: np.ndarray):
        self.order = np.argsort(known)
        self.known = known[self.order]

    def ids(self, h: np.ndarray) -> np.ndarray:
        out = (FREQUENT + (h & np.uint64(OTHERS - 1))).astype(np.int64)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            same = self.known[at] == h
            out[same] = self.order[at[same]]
        return out

    def documents(self, column: pa.Array):
        """(first row, padded ids, place of each word, n + 1 word offsets) for runs of rows."""
        data, offsets = text_buffers(column)
        for a, b in slices(offsets):
            h, _, _, of_text = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield a, *_padded(self.ids(h), of_text), of_text


def _padded(ids: np.ndarray, of_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    texts = len(of_text) - 1
    place = np.arange(len(ids)) + WINDOW * (np.repeat(np.arange(texts), np.diff(of_text)) + 1)
    padded = np.full(len(ids) + WINDOW * (texts + 1), PAD)
    padded[place] = ids
    return padded, place


def _read_documents(ids: pa.Array, sizes: pa.Array):
    """What `_Reader.documents` gives, from the ids (see `_with_ids`) and bytes of the texts."""
    ends = np.concatenate(([0], np.cumsum(pc.binary_length(ids).to_numpy(), dtype=np.int64))) // 2
    every = np.frombuffer(b"".join(ids.to_pylist()), "<u2")
    for a, b in slices(np.concatenate(([0], np.cumsum(sizes.to_numpy())))):
        of_text = ends[a : b + 1] - ends[a]
        yield a, *_padded(every[ends[a] : ends[b]], of_text), of_text


_AROUND = np.array([k for k in range(-WINDOW, WINDOW + 1) if k])


def _log_softmax(s: np.ndarray) -> np.ndarray:
    s = s - s.max(1, keepdims=True)
    s -= np.log(np.exp(s).sum(1, keepdims=True))
    return s


def _chosen(s: np.ndarray, rows: np.ndarray, which: np.ndarray) -> np.ndarray:
    """One column of each row of `_log_softmax(s)`."""
    s = s - s.max(1, keepdims=True)
    return s[rows, which] - np.log(np.exp(s).sum(1))


def _by_group(own: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order that puts the words of one group together, and (group, first, end) of the groups that occur in it."""
    group = own // GROUP
    ends = np.cumsum(np.bincount(group, minlength=SYMBOLS // GROUP)).tolist()
    # Numpy sorts short integers by radix.
    order = np.argsort(group.astype(np.uint16), kind="stable")
    return order, [(g, a, b) for g, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if b > a]


def log_probabilities(w: Weights, padded: np.ndarray, place: np.ndarray) -> np.ndarray:
    """log P(word | the words on both sides) at each place, in batches."""
    out = np.zeros(len(place))
    for at in range(0, len(place), SCORED):
        here = place[at : at + SCORED]
        order, groups = _by_group(padded[here])
        here = here[order]
        own = padded[here]
        x = w["E"][padded[here[:, None] + _AROUND]].reshape(len(here), -1)
        h = np.tanh(x @ w["W"] + w["b"])
        rows = np.arange(len(here))
        total = _chosen(h @ w["A"] + w["a"], rows, own // GROUP).astype(np.float64)
        for g, a, b in groups:
            total[a:b] += _chosen(h[a:b] @ w["B"][g] + w["c"][g], rows[: b - a], own[a:b] % GROUP)
        out[at + order] = total
    return out


def learn_batch(w: Weights, seen: Weights, padded: np.ndarray, here: np.ndarray, rate: float) -> None:
    """One Adagrad step on the words at `here`."""
    order, groups = _by_group(padded[here])
    here = here[order]
    own, around = padded[here], padded[here[:, None] + _AROUND]
    x = w["E"][around].reshape(len(here), -1)
    h = np.tanh(x @ w["W"] + w["b"])
    rows = np.arange(len(here))
    d1 = np.exp(_log_softmax(h @ w["A"] + w["a"]))
    d1[rows, own // GROUP] -= 1
    d1 /= len(here)
    dh, dB, dc = d1 @ w["A"].T, np.zeros_like(w["B"]), np.zeros_like(w["c"])
    for g, a, b in groups:
        d2 = np.exp(_log_softmax(h[a:b] @ w["B"][g] + w["c"][g]))
        d2[rows[: b - a], own[a:b] % GROUP] -= 1
        d2 /= len(here)
        dB[g], dc[g] = h[a:b].T @ d2, d2.sum(0)
        dh[a:b] += d2 @ w["B"][g].T
    dp = dh * (1 - h * h)
    # Rows of one neighbour are summed next to each other.
    near = around.ravel()
    by_word = np.argsort(near.astype(np.uint16), kind="stable")
    near = near[by_word]
    first = np.flatnonzero(np.concatenate(([True], near[1:] != near[:-1])))
    dE = np.zeros_like(w["E"])
    dE[near[first]] = np.add.reduceat((dp @ w["W"].T).reshape(-1, DIM)[by_word], first, axis=0)
    found = {"E": dE, "W": x.T @ dp, "b": dp.sum(0), "A": h.T @ d1, "a": d1.sum(0), "B": dB, "c": dc}
    for k, g in found.items():
        seen[k] += g * g
        step, root = rate * g, np.sqrt(seen[k])
        root += 1e-6
        step /= root
        w[k] -= step


def train(docs: DataFrame, known: np.ndarray, rounds: int = 2, rate: float = 0.1, read: tuple[str, str] | None = None) -> Weights:
    """Learns every word of every document once: in each round, each partition starts from the same weights, takes every
    `rounds`-th word of all its documents, beginning one later than before, and learns them in batches; the results are averaged by the words learned, in a Spark aggregation by weight.

    The model has a fixed size; only the averaged weights reach the driver. Without words the first weights stay. `read` names columns
    of ids and bytes that were made by `_with_ids`; texts are then not cut again.
    """
    spark, weights = docs.sparkSession, first_weights()
    for step in range(rounds):
        shared = spark.sparkContext.broadcast((known, weights))

        def run(batches, shared=shared, step=step):
            reader, w = _Reader(shared.value[0]), {k: v.copy() for k, v in shared.value[1].items()}
            seen = {k: np.full_like(v, 1e-4) for k, v in w.items()}
            learned = 0
            for batch in batches:
                for _, padded, place, of_text in _read_documents(*batch.columns) if read else reader.documents(batch.column(0)):
                    # A word is not among its own inputs, so any may be learned; the start differs from document to document.
                    within = np.arange(len(place)) - np.repeat(of_text[:-1], np.diff(of_text))
                    here = place[(within + step + np.repeat(np.diff(of_text), np.diff(of_text))) % rounds == 0]
                    for at in range(0, len(here), BATCH):
                        learn_batch(w, seen, padded, here[at : at + BATCH], rate)
                    learned += len(here)
            if learned:
                values = flat(w).astype(np.float64)
                cols = [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values * learned), pa.array(np.full(len(values), learned, np.int64))]
                yield pa.RecordBatch.from_arrays(cols, ["i", "v", "n"])

        parts = (docs.select(*read) if read else docs.select("text")).mapInArrow(run, "i int, v double, n long").groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v"))
        found = parts.toPandas().sort_values("i")
        if len(found):
            weights = unflat(found["v"].to_numpy())
    return weights


def with_pseudo_likelihood(docs: DataFrame, known: np.ndarray, weights: Weights, read: tuple[str, str] | None = None) -> DataFrame:
    """`docs` with `n_words` and `log_likelihood`: the sum over all words of a whole text of log P(word | both sides).

    Words are runs of letters and digits in small letters; rare ones count as their hash class (see `within_classes`). A null, empty or wordless text has
    0 words and 0.0. Equal texts have equal scores; no other column is looked at. `read` is that of `train`.
    """
    at = [docs.columns.index(c) for c in read or ("text",)]
    shared = docs.sparkSession.sparkContext.broadcast((known, weights))

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        reader, count, total = _Reader(shared.value[0]), [np.zeros(0, np.int64)], [np.zeros(0)]
        columns = [batch.column(k) for k in at]
        for _, padded, place, of_text in _read_documents(*columns) if read else reader.documents(*columns):
            p = np.concatenate(([0.0], np.cumsum(log_probabilities(shared.value[1], padded, place))))
            count.append(np.diff(of_text))
            total.append(p[of_text[1:]] - p[of_text[:-1]])
        return [pa.array(np.concatenate(count)), pa.array(np.round(np.concatenate(total), 6))]

    return with_columns(docs, "n_words long, log_likelihood double", work)


def _with_ids(docs: DataFrame, known: np.ndarray, counts: DataFrame, tag: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(read, sums). `read` is `docs` with columns that end in `tag`: row (a number), ids (of all words, 2 bytes each), size (bytes of the text),
    held and rest: of the words without an id of their own, the sum of log P(word | its hash class) over those of the `HELD` most
    frequent ones, and the hashes of all others. `sums` gives (row, sum) from settled `read`: that sum over `rest`, where there are any.
    """
    spark = docs.sparkSession
    top = spark.createDataFrame([(int(h),) for h in known.view(np.int64)], "word long")
    rare = counts.join(top, "word", "left_anti").withColumn("class", F.col("word").bitwiseAND(F.lit(OTHERS - 1)))
    found = rare.groupBy("class").agg(F.sum("n").alias("total")).collect()
    totals = np.zeros(OTHERS, np.int64)
    for r in found:
        totals[r["class"]] = r["total"]
    # Counts are told apart by eighths of a power of two, so that no task sends more than its part of the words that are held.
    level = F.floor(F.log2("n") * 8)
    levels = rare.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()
    fit = [r["level"] for r in levels if sum(x["words"] for x in levels if x["level"] >= r["level"]) <= HELD]
    often = rare.where(level >= min(fit)).select("word", "n").collect() if fit else []
    often = np.array([(r["word"], r["n"]) for r in often], np.int64).reshape(-1, 2)
    word, n = often[:, 0].view(np.uint64), often[:, 1]
    order = np.argsort(word)
    word, ratio = word[order], np.log(n / (totals[(word & np.uint64(OTHERS - 1)).astype(np.int64)] + 1))[order]
    shared = spark.sparkContext.broadcast((known, word, ratio))
    at = docs.columns.index("text")

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        known, word, ratio = shared.value
        reader = _Reader(known)
        data, offsets = text_buffers(batch.column(at))
        coded, lengths, held, rest, left = [], [], [], [], []
        for a, b in slices(offsets):
            h, _, _, of_text = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            ids = reader.ids(h)
            coded.append(ids.astype("<u2"))
            lengths.append(np.diff(of_text))
            some = np.flatnonzero(ids >= FREQUENT)
            h, text = h[some], np.repeat(np.arange(b - a), np.diff(of_text))[some]
            place = np.minimum(np.searchsorted(word, h), max(len(word) - 1, 0))
            same = word[place] == h if len(word) else np.zeros(len(h), bool)
            held.append(np.bincount(text[same], ratio[place[same]], b - a))
            rest.append(h[~same].view(np.int64))
            left.append(np.bincount(text[~same], minlength=b - a))
        ends = lambda x, size=1: np.concatenate([[0], *x]).cumsum() * size
        joined = lambda x, kind: np.concatenate([np.zeros(0, kind), *x])
        raw = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends(lengths, 2).astype(np.int32)), pa.py_buffer(joined(coded, "<u2"))])
        lists = pa.ListArray.from_arrays(pa.array(ends(left).astype(np.int32)), pa.array(joined(rest, np.int64)))
        return [raw, pa.array(np.diff(offsets)), pa.array(joined(held, float)), lists]

    rowed = docs.withColumn(f"row_{tag}", F.monotonically_increasing_id())
    read = with_columns(rowed, f"ids_{tag} binary, size_{tag} long, held_{tag} double, rest_{tag} array<long>", work, rows=1024)
    classes = spark.createDataFrame([(k, int(v)) for k, v in enumerate(totals)], "class long, total long")
    ratios = rare.join(F.broadcast(classes), "class").select("word", F.log(F.col("n") / (F.col("total") + 1)).alias("ratio"))
    unseen = F.broadcast(classes.select("class", F.log(1 / (F.col("total") + 1)).alias("unseen")))

    def sums(settled: DataFrame) -> DataFrame:
        others = settled.select(f"row_{tag}", F.explode(f"rest_{tag}").alias("word")).join(ratios, "word", "left")
        others = others.withColumn("class", F.col("word").bitwiseAND(F.lit(OTHERS - 1))).join(unseen, "class")
        return others.groupBy(f"row_{tag}").agg(F.sum(F.coalesce("ratio", "unseen")).alias(f"sum_{tag}"))

    return read, sums


def within_classes(docs: DataFrame, known: np.ndarray, counts: DataFrame) -> DataFrame:
    """(key, within): for each distinct text, by its xxhash64, the sum over its words without an id of their own of log P(word | its hash class).

    P is n / (N + 1) for a word counted n times in a class of N words, and 1 / (N + 1) for one that was never counted. The `HELD` most
    frequent ones are summed as texts are read; any number of other words is joined in Spark.
    """
    tag = uuid.uuid4().hex
    read, sums = _with_ids(docs.select(F.xxhash64("text").alias("key"), "text"), known, counts, tag)
    read = settle(read.drop("text"), "word-ids")
    found = read.join(sums(read), f"row_{tag}", "left")
    return found.groupBy("key").agg(F.first(F.col(f"held_{tag}") + F.coalesce(f"sum_{tag}", F.lit(0.0))).alias("within"))


def score_documents(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Counts words, learns and scores, all over all documents: `docs`, or its `columns`, with n_words and log_likelihood.

    A word without an id of its own counts with the probability of its class and its own within the class. A null, empty or wordless
    text has 0 words and 0.0; equal texts, and so repeated rows, have equal scores; an empty table gives no rows. Other columns stay as they
    are, whatever their names but these two. Texts are cut into words twice: to count them, and into settled ids. Partitions learn side by side and are averaged, so the last digits of a score depend on how the
    table is cut.
    """
    tag = uuid.uuid4().hex
    counts = settle(word_counts(docs), "word-counts")
    known = vocabulary(docs, counts)
    kept = docs.columns if columns is None else columns
    found, sums = _with_ids(docs, known, counts, tag)
    found = settle(found.select(*kept, *(f"{x}_{tag}" for x in ("row", "ids", "size", "held", "rest"))), "word-ids")
    ids = (f"ids_{tag}", f"size_{tag}")
    scored = with_pseudo_likelihood(found.drop(f"rest_{tag}"), known, train(found, known, read=ids), ids)
    within = F.col(f"held_{tag}") + F.coalesce(f"sum_{tag}", F.lit(0.0))
    scored = scored.join(sums(found), f"row_{tag}", "left").withColumn("log_likelihood", F.round(F.col("log_likelihood") + within, 6))
    return scored.select(*kept, "n_words", "log_likelihood")
