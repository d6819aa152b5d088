"""Helpers of the corpus operators: settled tables, Arrow batches in small slices, vectorised words, components."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text whose working arrays are held at once in a task; longer documents are cut at separators.
SLICE_BYTES = 1 << 20

#: Word characters: ASCII letters and digits, and every byte of a non-ASCII character.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER_BYTE = np.arange(256, dtype=np.uint8)
LOWER_BYTE[65:91] += 32
SPACE_BYTE = np.zeros(256, bool)
SPACE_BYTE[[9, 10, 11, 12, 13, 32]] = True
_MIX = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; a session without the setting (as in tests) gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpus-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/corpus/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Writes `df` to a table in the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column, and n + 1 offsets; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole rows with at most `most` bytes each; a longer row is a run of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, min(stop, rows)
        row = min(stop, rows)


@functools.lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for base in (_BASE, _INVERSE):
        out = np.full(n, base, np.uint64)
        out[0] = 1
        both.append(np.multiply.accumulate(out))
    return both[0], both[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _words_of_piece(piece: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = is_word[piece]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    start, stop = edges[::2], edges[1::2]
    power, inverse = _powers(max(SLICE_BYTES, 1 << (len(piece) - 1).bit_length()) + 1 if len(piece) else SLICE_BYTES + 1)
    total = np.zeros(len(piece) + 1, np.uint64)
    np.cumsum(_MIX[piece] * power[: len(piece)], out=total[1:])
    return mixed((total[stop] - total[start]) * inverse[start]), start, stop


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = WORD_BYTE, lower: bool = True):
    """64-bit hashes of all words of some texts, the byte where each starts and stops, and the n + 1 word offsets of the texts.

    A word is a longest run of bytes of `is_word`. Texts do not run into each other. ASCII and Latin-1 capitals
    hash like small letters if `lower`. Texts of any length work in pieces of `SLICE_BYTES`, cut between words; only
    a single word that is longer makes a longer piece.
    """
    if lower and len(data):
        data = LOWER_BYTE[data]
        capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        data[capital] += 0x20
    found, first, last, counts = [], [], [], np.zeros(len(offsets), np.int64)
    for a, b in slices(offsets):
        at, end = int(offsets[a]), int(offsets[b])
        if b - a > 1:
            # A separator goes between texts, so that words do not run together.
            inner = offsets[a + 1 : b] - at
            piece = np.insert(data[at:end], inner, 32)
            h, start, stop = _words_of_piece(piece, is_word)
            shift = np.searchsorted(inner + np.arange(len(inner)), start)
            counts[a + 1 : b + 1] = np.bincount(shift, minlength=b - a)
            found.append(h), first.append(start - shift + at), last.append(stop - shift + at)
            continue
        while at < end:
            cut = min(end, at + SLICE_BYTES)
            while cut < end and is_word[data[cut - 1]] and is_word[data[cut]]:
                back = np.flatnonzero(~is_word[data[at:cut]])
                if len(back):
                    cut = at + int(back[-1]) + 1
                    break
                cut = min(end, cut + SLICE_BYTES)
            h, start, stop = _words_of_piece(data[at:cut], is_word)
            counts[a + 1] += len(h)
            found.append(h), first.append(start + at), last.append(stop + at)
            at = cut
    empty = np.zeros(0, np.int64)
    return (
        np.concatenate(found) if found else np.zeros(0, np.uint64),
        np.concatenate(first) if first else empty,
        np.concatenate(last) if last else empty,
        np.cumsum(counts),
    )


def grams(h: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words as they start at each word, and whether all n lie in the same text."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(_BASE) + h[k : len(h) - n + 1 + k]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return mixed(out), text[: len(out)] == text[n - 1 :]


def give_back() -> None:
    """Returns freed memory to the system at the end of a partition: idle Python workers stay beside later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def with_columns(docs: DataFrame, columns: str, work: Callable[[pa.RecordBatch], list[pa.Array]], rows: int = 4096, done: Callable[[], None] | None = None) -> DataFrame:
    """`docs` with columns (a DDL list, names not in use) that `work` makes from Arrow batches of at most `rows` rows.

    `done` is called at the end of each partition.
    """
    more = docs.sparkSession.createDataFrame([], columns).schema.fields
    old = docs.schema.fields
    kinds = [field.dataType for field in (*old, *more)]
    names = [f"c{i}" for i in range(len(kinds))]

    def run(batches):
        for batch in (b.slice(k, rows) for b in batches for k in range(0, len(b), rows)):
            yield pa.RecordBatch.from_arrays([*batch.columns, *work(batch)], names=names)
        if done:
            done()
        give_back()

    typed = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return docs.toDF(*names[: len(old)]).mapInArrow(run, typed).toDF(*(f.name for f in (*old, *more)))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that edges (a, b) connect each node with; only nodes that have an edge.

    Alternates two star contractions until nothing changes: each needs one minimum per node and one join, a
    logarithmic number of rounds, and no node's neighbours are ever gathered in one place. Rounds are settled.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = settle(edges.distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct()
            )
        before = state
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = large.where("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = settle(small.where("a <> b").distinct(), "edges")
