"""Resampling towards a target text: array-scored n-gram weights, ranks by a distributed radix sort.

The weight of a document is the sum, over its runs of one to three words, of how much likelier the run's hash bucket is in the target
than in the corpus. Gumbel noise from the id makes the highest scores a draw without replacement.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runtide.llm.shared import LOWER_BYTE, SLICE_BYTES, WORD_BYTE, settle, text_buffers, with_columns

#: Words of up to so many bytes take the vectorised way.
_SHORT = 63
_SPACE = zlib.crc32(b" ")


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 step table, its effect on each byte of a register for 0 to `_SHORT` + 1 zero bytes, and for 2^k zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    short = np.zeros((_SHORT + 2, 4, 256), np.uint32)
    short[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(_SHORT + 1):
        short[n + 1] = step[short[n] & 255] ^ (short[n] >> 8)
    doubled = np.zeros((40, 4, 256), np.uint32)
    doubled[0] = short[1]
    for k in range(39):
        doubled[k + 1] = _through(doubled[k], doubled[k])
    return step, short, doubled


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0, crc & 255] ^ table[1, crc >> 8 & 255] ^ table[2, crc >> 16 & 255] ^ table[3, crc >> 24]


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC-32 of texts (`crc`) as they count in front of `n` more bytes: xor with the CRC of these gives that of both."""
    _, short, doubled = _tables()
    low = np.minimum(n, _SHORT + 1)
    out = short[low, 0, crc & 255] ^ short[low, 1, crc >> 8 & 255] ^ short[low, 2, crc >> 16 & 255] ^ short[low, 3, crc >> 24]
    long = np.flatnonzero(n > _SHORT + 1)
    if len(long):
        rest, part = n[long] - low[long], out[long]
        for k in range(int(rest.max()).bit_length()):
            part = np.where(rest >> k & 1, _through(doubled[k], part), part)
        out[long] = part
    return out


def _crc_of_words(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of each word: byte by byte over all words that are at least so long, longest words first."""
    step = _tables()[0]
    order = np.argsort(np.minimum(size, _SHORT + 1).astype(np.uint8), kind="stable")[::-1]
    at, crc = start[order], np.full(len(order), 0xFFFFFFFF, np.uint32)
    ends = np.bincount(np.minimum(size, _SHORT + 1), minlength=_SHORT + 2)[::-1].cumsum()[::-1]
    long = int(ends[_SHORT + 1])
    for k in range(_SHORT):
        m = int(ends[k + 1])
        if m <= long:
            break
        part = crc[long:m]
        crc[long:m] = step[(part ^ data[at[long:m] + k]) & 255] ^ (part >> 8)
    crc ^= np.uint32(0xFFFFFFFF)
    for k in range(long):
        word = order[k]
        crc[k] = zlib.crc32(data[start[word] : start[word] + size[word]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(start, size, text) of all words in order, in pieces of about `SLICE_BYTES`; no word runs over the end of a text."""
    at, end = 0, len(data)
    while at < end:
        cut = min(end, at + SLICE_BYTES)
        border = int(offsets[np.searchsorted(offsets, cut)])  # the next text begins here
        while cut < border:
            gap = np.flatnonzero(~WORD_BYTE[data[cut : min(border, cut + 4096)]])
            if len(gap):
                cut += int(gap[0])
                break
            cut = min(border, cut + 4096)
        inside = np.zeros(cut - at + 2, bool)
        inside[1:-1] = WORD_BYTE[data[at:cut]]
        border = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, cut, "right")] - at
        fresh = np.zeros(cut - at + 1, bool)
        fresh[border] = True
        start = np.flatnonzero(inside[1:] & (~inside[:-1] | fresh))
        stop = np.flatnonzero(inside[:-1] & (~inside[1:] | fresh))
        yield start + at, stop - start, np.searchsorted(offsets, start + at, "right") - 1
        at = cut


def features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bucket, text, number of words) of all runs of one to three words in pieces; the words come first in each piece.

    Two words are carried from piece to piece, so that a text of any length has all its runs.
    """
    data = LOWER_BYTE[data]
    crc, lead, size, text = (np.zeros(0, k) for k in (np.uint32, np.uint32, np.int64, np.int64))
    for start, n, own in _pieces(data, offsets):
        c = len(crc)
        fresh = _crc_of_words(data, start, n)
        crc, size, text = np.concatenate((crc, fresh)), np.concatenate((size, n)), np.concatenate((text, own))
        lead = np.concatenate((lead, _shifted(np.full(len(n), _SPACE, np.uint32), n) ^ fresh))  # with a space before the word
        two = _shifted(crc[:-1], size[1:] + 1) ^ lead[1:] if len(crc) > 1 else crc[:0]
        three = _shifted(two[:-1], size[2:] + 1) ^ lead[2:] if len(crc) > 2 else crc[:0]
        # Runs that end in this piece: the run of two that ends at word j has index j - 1.
        a, b = max(c - 1, 0), max(c - 2, 0)
        same2, same3 = text[a:-1] == text[a + 1 :], text[b:-2] == text[b + 2 :]
        found = np.concatenate((fresh, two[a:][same2], three[b:][same3]))
        yield found % np.uint32(buckets), np.concatenate((own, text[a + 1 :][same2], text[b + 2 :][same3])), len(own)
        crc, lead, size, text = crc[-2:], lead[-2:], size[-2:], text[-2:]


def bucket_counts(docs: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all texts of `docs`. At most `buckets` rows leave each task, and as many reach the driver."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found, _, _ in features(*text_buffers(batch.column(0)), buckets):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of target share over corpus share) of each bucket, one added to every count."""
    most = float(len(corpus))
    share = ((target + 1.0) * (float(corpus.sum()) + most)) / ((corpus + 1.0) * (float(target.sum()) + most))
    return np.floor(1000 * np.log(share)).astype(np.int64)


def with_weight(docs: DataFrame, gains: np.ndarray, names: tuple[str, str, str] = ("n_words", "n_features", "weight")) -> DataFrame:
    """`docs` with the numbers of words and features of `text` (null: none) and the sum of the features' gains, as `names`."""
    at = docs.columns.index("text")

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        n_words, n_features, weight = np.zeros((3, len(batch)), np.int64)
        for found, text, n in features(*text_buffers(batch.column(at)), len(gains)):
            n_words += np.bincount(text[:n], minlength=len(batch))
            n_features += np.bincount(text, minlength=len(batch))
            # Sums of whole numbers far below 2^53 are exact.
            weight += np.bincount(text, gains[found], minlength=len(batch)).astype(np.int64)
        return [pa.array(x) for x in (n_words, n_features, weight)]

    return with_columns(docs, ", ".join(f"`{name}` long" for name in names), work)


def _gumbel(doc_id, seed: int):
    """floor(-1000 ln(-ln(u))) with u from the SHA-256 of seed and id (null: no digits)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


#: Rows of a block, whose digits a task counts at once, and bits of a digit, as powers of two.
BLOCK_BITS, DIGIT_BITS = 16, 12


def _blocks(batches, column: int) -> Iterator[pa.Table]:
    """The rows of one block after another, from rows sorted by block."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        block = batch.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if held and held[-1].column(column)[0] != batch.column(column)[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _pass(table: DataFrame, key: str, shift: int, bits: int) -> DataFrame:
    """One stable counting sort: `table` with `pos` by the order of a digit of `key`, equal digits by `pos` as it was.

    Counts per block and digit are few: 2^12 a block of 2^16 rows. A row goes to: rows of lower digits, plus rows of
    its digit in earlier blocks, plus rows of its digit before it in its block.
    """
    digit = F.shiftright(key, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    marked = table.withColumn("block", F.shiftright("pos", BLOCK_BITS))
    counts = settle(marked.groupBy("block", digit.alias("digit")).agg(F.count("*").alias("n")), "counts")
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n")).toArrow()  # at most 2^bits rows
    lower = np.zeros(1 << bits, np.int64)
    lower[totals["digit"].to_numpy()] = totals["n"].to_numpy()
    lower = np.concatenate(([0], np.cumsum(lower)[:-1]))
    before = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("block", "digit", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    rest = [c for c in table.columns if c != "pos"]
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    # A block's offsets come before its rows, in one shuffle.
    none = [F.lit(None).cast(kinds[c]).alias(c) for c in rest]
    both = offsets.select("block", "digit", F.col("n").alias("pos"), F.lit(False).alias("is_row"), *none).union(
        marked.select("block", digit, "pos", F.lit(True), *rest)
    )
    width = len(rest)

    def place(batches):
        for part in _blocks(batches, 0):
            part = part.combine_chunks()
            is_row = part["is_row"].to_numpy(zero_copy_only=False)
            start = np.zeros(1 << bits, np.int64)
            given = np.flatnonzero(~is_row)
            start[part["digit"].to_numpy()[given]] = part["pos"].to_numpy()[given] + lower[part["digit"].to_numpy()[given]]
            part = part.filter(pa.array(is_row))
            pos, digits = part["pos"].to_numpy(), part["digit"].to_numpy()
            order = np.argsort(pos)
            order = order[np.argsort(digits[order].astype(np.uint16), kind="stable")]  # numpy sorts short integers by radix
            ordered = digits[order]
            first = np.concatenate(([0], np.cumsum(np.bincount(ordered, minlength=1 << bits))[:-1]))
            to = np.empty(len(pos), np.int64)
            to[order] = start[ordered] + np.arange(len(order)) - first[ordered]
            yield from pa.Table.from_arrays([pa.array(to), *part.columns[4 : 4 + width]], ["pos", *rest]).to_batches()

    dealt = both.repartition("block").sortWithinPartitions("block", "is_row")
    return settle(dealt.mapInArrow(place, ", ".join(f"{c} {kinds[c]}" for c in ["pos", *rest])), "sorted")


def radix_ranks(rows: DataFrame, row: str, keys: list[tuple[str, bool]]) -> DataFrame:
    """(`row`, rank): the place of each row, from 1, in the order of integer `keys` [(column, descending)], the first one decides.

    Nulls come last. Rows that agree in all keys get consecutive ranks in any order. A least-significant-digit radix
    sort: one counting sort a digit of 12 bits, as many as the ranges of the keys ask for, each settled. No task holds
    more than a block of 65,536 rows, hot keys or not.
    """
    bounds = rows.agg(*(f(c).alias(f"{n}{k}") for k, (c, _) in enumerate(keys) for n, f in (("a", F.min), ("z", F.max))), *(F.count_if(F.col(c).isNull()).alias(f"n{k}") for k, (c, _) in enumerate(keys))).first()
    ready, digits = [F.col(row).alias("row")], []
    for k, (column, descending) in enumerate(keys):
        low, high, nulls = bounds[f"a{k}"], bounds[f"z{k}"], bounds[f"n{k}"]
        if low is None:
            continue
        if not -(2**61) < low <= high < 2**61:
            raise ValueError(f"{column} lies outside of 62 bits")
        value = F.lit(high) - F.col(column) if descending else F.col(column) - F.lit(low)
        ready.append(F.coalesce(value, F.lit(high - low + 1)).cast("long").alias(f"k{k}"))
        bits = max(1, (high - low + (nulls > 0)).bit_length())
        steps = -(-bits // DIGIT_BITS)
        digits.append([(f"k{k}", s * DIGIT_BITS, min(DIGIT_BITS, bits - s * DIGIT_BITS)) for s in range(steps)])
    table = settle(rows.select(*ready), "keys").withColumn("pos", F.monotonically_increasing_id())
    table = settle(table, "positions")
    if not digits:  # no keys: any order will do
        table, digits = table.withColumn("k0", F.lit(0).cast("long")), [[("k0", 0, 1)]]
    for key, shift, bits in (d for key in reversed(digits) for d in key):
        table = _pass(table, key, shift, bits)
    return table.select(F.col("row").alias(row), (F.col("pos") + 1).alias("rank"))


def importance_ranks(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = 10_000) -> DataFrame:
    """doc_id, n_features, weight, score of every row, and its `rank` among the drawn ones (null: not drawn).

    Of the N rows with at least `least_words` words, the floor(percent N / 100) with the highest scores are drawn, ties to
    the smaller doc_id. Words are runs of ASCII letters, digits and non-ASCII characters of whole texts, A-Z lower-cased. A null
    or empty text has no words and weight 0. Rows without a doc_id count like others; their noise is that of an empty id
    and they lose ties. Repeated rows are rows of their own, with ranks in any order between them. Empty tables
    give counts of 0. doc_id is an integer of up to 61 bits; columns other than doc_id and text are not looked at.
    """
    docs = docs.select("doc_id", "text")
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = with_weight(docs, gains).drop("text")
    scored = scored.withColumn("score", F.col("weight") + _gumbel(F.col("doc_id"), seed))
    scored = settle(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    pool = scored.where(F.col("n_words") >= least_words)
    drawn = percent * pool.count() // 100
    ranks = radix_ranks(pool, "row", [("score", True), ("doc_id", False)]).where(F.col("rank") <= drawn)
    return scored.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
