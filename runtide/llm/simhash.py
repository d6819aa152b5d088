"""SimHash near-duplicates by anchor-point covering."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtide.llm.shared import components, settle, text_buffers, with_columns

BITS = 64


def _fingerprint(text: bytes, words: int, slab: int = 1 << 16) -> int:
    """The fingerprint of one text; the hashes of a very long one are counted slab by slab."""
    found = text.lower().split()  # bytes: lowers A-Z only, splits at the six ASCII blanks only
    if not found:
        return 0
    joined, ends = b" ".join(found), np.cumsum([len(w) + 1 for w in found])
    take = min(words, len(found))
    starts, stops = np.concatenate(([0], ends[: len(found) - take])).tolist(), (ends[take - 1 :] - 1).tolist()
    digest, seed = xxhash.xxh64_intdigest, 42
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(starts), slab):
        h = [digest(joined[a:b], seed) for a, b in zip(starts[k : k + slab], stops[k : k + slab], strict=True)]
        bits = np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, words: int, name: str = "fp") -> DataFrame:
    """`docs` with the 64-bit SimHash of `text` as a signed long: majority of the XXH64 of its word shingles."""
    at = docs.columns.index("text")

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = text_buffers(batch.column(at))
        whole = [_fingerprint(data[a:b].tobytes(), words) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return [pa.array(np.array(whole, np.uint64).view(np.int64))]

    return with_columns(docs, f"{name} long", work)


def _blocks(size: int) -> list[int]:
    """Masks that split the 64 bits into blocks of about `size` bits, far bits together."""
    n = BITS // size
    return [sum(1 << bit for bit in range(BITS) if (bit % n) == b) for b in range(n)]


def home_anchors(fps: np.ndarray, size: int) -> np.ndarray:
    """The anchor next to each fingerprint, as one bit a block.

    The anchors are the product of the repetition codes of the blocks: each block is all ones or all zeros. The
    nearest one follows from each block's majority, at most half of each block away, which is the covering radius.
    """
    out = np.zeros(len(fps), np.int64)
    for b, mask in enumerate(_blocks(size)):
        out |= (np.bitwise_count(fps & np.uint64(mask)).astype(np.int64) > mask.bit_count() // 2).astype(np.int64) << b
    return out


def near_anchors(fps: np.ndarray, size: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All (index, anchor) within covering radius plus `most` of each fingerprint, radius and excess taken block by block.

    An anchor is reached if turning the majorities in which it differs takes at most `most` bits in all. Whatever
    lies within `most` bits of the fingerprint has its home among these.
    """
    row, anchor, spent = np.arange(len(fps)), home_anchors(fps, size), np.zeros(len(fps), np.int64)
    for b, mask in enumerate(_blocks(size)):
        half = mask.bit_count() // 2
        ones = np.bitwise_count(fps & np.uint64(mask)).astype(np.int64)
        cost = np.where(ones > half, ones - half, half + 1 - ones)[row] + spent
        more = np.flatnonzero(cost <= most)
        row = np.concatenate((row, row[more]))
        anchor = np.concatenate((anchor, anchor[more] ^ (1 << b)))
        spent = np.concatenate((spent, cost[more]))
    return row, anchor


def fingerprint_links(prints: DataFrame, most: int, block: int = 3) -> DataFrame:
    """Pairs (x, y) of distinct fingerprints (`fp`, no repeats) at most `most` bits apart, each once.

    Each fingerprint lives at its home anchor and is replicated to every anchor within reach; an anchor compares
    those that live there with the replicas. Both sides meet in an equi-join, which Spark can split where it is skewed.
    """

    def replicas(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 2048):
                part = fps[at : at + 2048]
                row, anchor = near_anchors(part, block, most)
                yield pa.RecordBatch.from_arrays([pa.array(part[row].view(np.int64)), pa.array(anchor)], ["y", "anchor"])

    def homes(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64)), pa.array(home_anchors(fps, block))], ["x", "anchor"])

    prints = prints.select("fp")
    lives = prints.mapInArrow(homes, "x long, anchor long")
    comes = prints.mapInArrow(replicas, "y long, anchor long")
    near = (F.col("x") < F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= most)
    return comes.join(lives, "anchor").where(near).select("x", "y")


def _first_of_each(prints: DataFrame, most: int, block: int) -> DataFrame:
    """(fp, first) from distinct (fp, least): the smallest `least` of all fingerprints that links connect with each one."""
    links = fingerprint_links(prints, most, block)
    joined = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    named = prints.join(joined.select(F.col("node").alias("fp"), "component"), "fp", "left")
    named = named.withColumn("component", F.coalesce("component", "fp"))
    # One row for each distinct fingerprint of a component, so the minimum is taken before anything is shuffled.
    lowest = named.groupBy("component").agg(F.min("least").alias("first"))
    return settle(named.join(lowest, "component").select("fp", "first"), "names")


def simhash_groups(docs: DataFrame, words: int = 3, most: int = 2, block: int = 3) -> DataFrame:
    """Every row's doc_id and `fp`, and the smallest doc_id (`component_id`) that links of at most `most` bits reach.

    Equal texts, and different texts with equal fingerprints, link as any others. A null text is an empty one, and all
    empty texts have fingerprint zero. Rows without a doc_id are linked too, but name no component: if no row of
    their component has a doc_id, it is null. Repeated rows stay. Other columns are not looked at.
    """
    marked = settle(with_fingerprint(docs.select("doc_id", "text"), words).select("doc_id", "fp"), "fingerprints")
    prints = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    names = _first_of_each(prints, most, block)
    return marked.join(names, "fp").select("doc_id", "fp", F.col("first").alias("component_id"))


def one_of_each_group(docs: DataFrame, words: int = 3, most: int = 2, block: int = 3) -> DataFrame:
    """`docs` with one row of each component of near-duplicates: the one with the smallest doc_id.

    Rows without an id give way to others; of equal ids, and so of repeated rows, one stays. Columns are those of `docs`.
    """
    # Names of their own, whatever columns there are.
    tag = uuid.uuid4().hex
    fp, row = f"fp_{tag}", f"row_{tag}"
    marked = settle(with_fingerprint(docs, words, fp).withColumn(row, F.monotonically_increasing_id()), "marked")  # also fixes the row numbers
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row"))
    prints = settle(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("least")), "prints")
    names = _first_of_each(prints, most, block)
    found = marked.select(F.col(fp).alias("fp"), F.col(row).alias("row")).join(names, "fp")
    gone = settle(found.where("row <> first.row").select(F.col("row").alias(f"gone_{tag}")), "gone")
    return marked.join(gone, F.col(row) == F.col(f"gone_{tag}"), "left_anti").select(*docs.columns)
