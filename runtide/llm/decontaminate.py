"""Benchmark decontamination: n-gram seeds find passages of test items, Smith-Waterman alignment scores them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtide.llm.shared import give_back, grams, settle, slices, text_buffers, words

#: A gram is rare in up to so many places, or in as many as the documents divided by it.
RARE = 100
#: n-grams of test items that a task holds at once (8 MB); more of them go through the documents in blocks.
GRAMS_PER_BLOCK = 1 << 20


def item_grams(benchmark: DataFrame, n: int) -> DataFrame:
    """(item, size, words, position, gram): the n-grams of each test item, with all its word hashes as 32-bit integers."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            h, _, _, of_text = words(data, offsets)
            g, whole = grams(h, of_text, n)
            text = np.repeat(np.arange(len(batch)), np.diff(of_text))[: len(g)][whole]
            place = (np.arange(len(g)) - of_text[:-1][np.repeat(np.arange(len(batch)), np.diff(of_text))[: len(g)]])[whole]
            held = pa.array([h[a:b].astype(np.uint32).tobytes() for a, b in zip(of_text[:-1], of_text[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(text)), pa.array(np.diff(of_text)[text]), held.take(pa.array(text)), pa.array(place), pa.array(g[whole].view(np.int64))],
                ["item", "size", "words", "position", "gram"],
            )

    kind = benchmark.schema["item_id"].dataType.simpleString()
    items = benchmark.where("item_id is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    return items.mapInArrow(run, f"item {kind}, size long, words binary, position long, gram long")


def _blocks(seeds: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct grams with their margins, in blocks that fit a task, split by hash value. `seeds`: gram, margin, no repeats."""
    blocks = 1 + seeds.count() // GRAMS_PER_BLOCK
    for k in range(blocks):
        part = seeds.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == k).toPandas()
        gram = part["gram"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(gram)
        yield gram[order], part["margin"].to_numpy(np.int64)[order]


class _Lookup:
    """Which of many hashes are in a sorted block: a bit table drops nearly all, a search decides on the rest."""

    def __init__(self, block: np.ndarray):
        self.block = block
        self.shift = np.uint64(64 - max(16, min(25, int(len(block)).bit_length() + 5)))
        self.table = np.zeros(1 << (64 - int(self.shift)), bool)
        self.table[block >> self.shift] = True

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the hashes that are in the block, and where they are there."""
        maybe = np.flatnonzero(self.table[h >> self.shift])
        if not len(maybe) or not len(self.block):
            return maybe[:0], maybe[:0]
        at = np.minimum(np.searchsorted(self.block, h[maybe]), len(self.block) - 1)
        same = self.block[at] == h[maybe]
        return maybe[same], at[same]


#: Margins that a passage spans at most: a longer run of hits makes several passages, each with its own margins.
MARGINS = 16


def _passages(hits: np.ndarray, margin: np.ndarray, size: int) -> list[tuple[int, int, np.ndarray]]:
    """Joins hits whose margins meet: (first word, last word, indexes of the hits) for a text of `size` words."""
    start, reach = hits - margin, np.maximum.accumulate(hits + margin)
    span = np.concatenate(([0], np.cumsum(start[1:] > reach[:-1])))
    first = np.searchsorted(span, span)
    within = (hits - hits[first]) // (MARGINS * margin[first])
    cuts = np.flatnonzero(np.diff(span) | np.diff(within)) + 1
    return [(max(0, int(start[p].min())), min(size, int((hits + margin)[p].max())), p) for p in np.split(np.arange(len(hits)), cuts)]


def gram_counts(docs: DataFrame, grams_: DataFrame, n: int) -> DataFrame:
    """(gram, n): how often each of some distinct grams occurs in all texts of `docs`; those that don't are left out."""
    found = None
    for block, _ in _blocks(grams_.withColumn("margin", F.lit(0))):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            lookup, total = _Lookup(shared.value), np.zeros(len(shared.value), np.int64)
            for batch in batches:
                data, offsets = text_buffers(batch.column(0))
                for a, b in slices(offsets):
                    h, _, _, of_text = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    g, whole = grams(h, of_text, n)
                    hits, place = lookup.hits(g)
                    np.add.at(total, place[whole[hits]], 1)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(lookup.block[used].view(np.int64)), pa.array(total[used])], ["gram", "n"])
            give_back()

        part = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        found = part if found is None else found.union(part)
    return found


def seed_passages(docs: DataFrame, keys: list[str], seeds: DataFrame, n: int) -> DataFrame:
    """keys, start, words, gram: each passage around seeds (gram, margin), once for each distinct seed in it."""
    found = None
    kinds = ", ".join(f"k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    names = [*(f"k{i}" for i in range(len(keys))), "start", "words", "gram"]
    for block in _blocks(seeds):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            lookup, margins = _Lookup(shared.value[0]), shared.value[1]
            for batch in batches:
                data, offsets = text_buffers(batch.column(len(keys)))
                for a, b in slices(offsets):
                    h, _, _, of_text = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    g, whole = grams(h, of_text, n)
                    hits, place = lookup.hits(g)
                    hits, place = hits[whole[hits]], place[whole[hits]]
                    row = np.searchsorted(of_text, hits, "right") - 1
                    rows, starts, texts, seeds_ = [], [], [], []
                    for r in np.unique(row):
                        first, size = of_text[r], int(of_text[r + 1] - of_text[r])
                        mine = hits[row == r]
                        for start, stop, inside in _passages(mine - first, margins[place[row == r]], size):
                            held = h[first + start : first + stop].astype(np.uint32).tobytes()
                            for gram in np.unique(g[mine[inside]]):
                                rows.append(a + r), starts.append(start), texts.append(held), seeds_.append(gram)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(i).take(pa.array(rows, pa.int64())) for i in range(len(keys))), pa.array(starts, pa.int64()), pa.array(texts, pa.binary()), pa.array(np.array(seeds_, np.uint64).view(np.int64))],
                        names,
                    )
            give_back()

        part = docs.select(*keys, "text").toDF(*names[: len(keys)], "t").mapInArrow(run, f"{kinds}, start long, words binary, gram long")
        found = part if found is None else found.union(part)
    return found


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman score of two word sequences (match 2, mismatch and gap -1), and the passage word after its end."""
    ramp = np.arange(len(passage) + 1)
    row, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for word in item:
        fresh = np.zeros_like(row)
        np.maximum(row[:-1] + np.where(passage == word, 2, -1), row[1:] - 1, out=fresh[1:])
        np.maximum(fresh, 0, out=fresh)
        # A gap along the row: the best of all starts to the left, less one for each step.
        row = np.maximum.accumulate(fresh + ramp) - ramp
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def contaminated(
    docs: DataFrame, benchmark: DataFrame, keys: tuple[str, ...] = ("doc_id",), n: int = 4, least: float = 0.5
) -> DataFrame:
    """keys, item_id, score, end_word: documents that hold a test item, verbatim, edited or paraphrased in parts.

    Words are runs of letters and digits, small letters and capitals alike. The score is the Smith-Waterman score of the
    best aligned passage over that of the whole item (1: verbatim); pairs of `least` or more are returned, one
    row for each distinct key and item. The seeds of an item are those of its n-grams that are rare in the corpus: in no more than a
    hundredth as many places as there are documents, or 100. Where fewer than half are rare, all its n-grams are seeds. An alignment is found
    if it holds a seed, `n` words in a row; one without (a word changed in every `n`) is not looked for. Null and empty texts, and items of fewer than `n` words or without an id, match
    nothing; of several texts of an item id the least is taken. A document without an id is judged like any other.
    Extra columns are not looked at. Rows with equal keys are reported once, with the best score among them.
    """
    keys = list(keys)
    items = settle(item_grams(benchmark, n), "items")
    docs = docs.select(*keys, "text")
    counts = settle(gram_counts(docs, items.select("gram").distinct(), n), "counts")
    often = max(RARE, docs.count() // RARE)
    # Grams that the corpus does not have can join nothing.
    marked = items.join(counts, "gram", "left").withColumn("rare", F.coalesce(F.col("n") <= often, F.lit(True)))
    enough = marked.groupBy("item").agg((2 * F.count_if("rare") >= F.count("*")).alias("enough"))
    seeds = marked.join(enough, "item").where("n is not null and (rare or not enough)")
    # An alignment of `least` or more has at most 2 * (1 - least) * size words of the passage in gaps.
    margin = F.ceil(F.max("size") * (3 - 2 * min(max(least, 0), 1))).cast("long")
    seeds = settle(seeds.select("item", "gram", "size").distinct(), "seeds")
    names = [f"k{i}" for i in range(len(keys))]
    hits = seed_passages(docs, keys, settle(seeds.groupBy("gram").agg(margin.alias("margin")), "margins"), n)
    one = items.groupBy("item").agg(F.first("words").alias("item_words"))
    pairs = hits.join(seeds.select("item", "gram"), "gram").groupBy(*names, "start", "item", F.xxhash64("words").alias("same")).agg(F.first("words").alias("words"))
    pairs = pairs.join(one, "item").select(*names, "item", "start", "words", "item_words")
    kind = benchmark.schema["item_id"].dataType.simpleString()
    kinds = ", ".join(f"{name} {docs.schema[k].dataType.simpleString()}" for name, k in zip(names, keys, strict=True))

    def score(batches):
        for batch in batches:
            start, text, item = (batch.column(len(keys) + k) for k in (1, 2, 3))
            found = []
            for t, b in zip(text, item, strict=True):
                i, passage = np.frombuffer(b.as_py(), np.uint32), np.frombuffer(t.as_py(), np.uint32)
                # No alignment matches more words than the passage holds of the item.
                most = np.isin(i, passage).sum() / max(len(i), 1)
                found.append((*(align(i, passage) if most >= least else (-2 * len(i), 0)), len(i)))
            best, end, size = np.array(found, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys) + 1], pa.array(best / (2 * np.maximum(size, 1))), pa.array(end + start.to_numpy())],
                [*names, "item_id", "score", "end_word"],
            )

    found = pairs.mapInArrow(score, f"{kinds}, item_id {kind}, score double, end_word long").where(F.col("score") >= least)
    best = found.groupBy(*names, "item_id").agg(F.max(F.struct("score", (-F.col("end_word")).alias("end"))).alias("best"))
    return best.select(*names, "item_id", "best.score", (-F.col("best.end")).alias("end_word")).toDF(*keys, "item_id", "score", "end_word")
