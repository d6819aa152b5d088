"""MinHash fingerprints: universal hash permutations over word shingles in numpy, bands joined in Spark, Jaccard verified."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtide.llm.shared import SPACE_BYTE, grams, settle, slices, text_buffers, with_columns, words

SLOTS, BANDS, SHINGLE = 64, 16, 5
_DRAW = np.random.default_rng(10)
_A = _DRAW.integers(1, 2**32, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _DRAW.integers(0, 2**63, SLOTS, dtype=np.uint64)
#: Shingles of which all permutations are held at once: 64 x 4,096 x 8 bytes.
_STEP = 4096


def _shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of some texts and n + 1 offsets; a text of fewer words has one shingle, of none no shingle."""
    h, _, _, of_text = words(data, offsets, ~SPACE_BYTE, lower=False)
    g, whole = grams(h, of_text, SHINGLE)
    sizes = np.diff(of_text)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(g)][whole]
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    few = []
    for k in short:
        out = np.uint64(sizes[k])
        for x in h[of_text[k] : of_text[k + 1]]:
            out = np.uint64((int(out) * 0x9E3779B97F4A7C15 + int(x)) % 2**64)
        few.append(out)
    every = np.concatenate((g[whole], np.array(few, np.uint64)))
    owner = np.concatenate((text, short))
    if len(short):
        order = np.argsort(owner, kind="stable")
        every, owner = every[order], owner[order]
    return every, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(sizes)))))


def signatures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of 32-bit minima for each text, one column for each permutation h -> (a h + b) mod 2^64 (a odd), upper half.

    A text without shingles has all ones.
    """
    out = np.full((len(offsets) - 1, SLOTS), 0xFFFFFFFF, np.uint32)
    for a, b in slices(offsets):
        every, bounds = _shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        owner = np.repeat(np.arange(a, b), np.diff(bounds))
        for at in range(0, len(every), _STEP):
            part, own = every[at : at + _STEP], owner[at : at + _STEP]
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            rows = own[first]
            for k in range(SLOTS):
                least = np.minimum.reduceat(((part * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), first)
                out[rows, k] = np.minimum(out[rows, k], least)
    return out


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Share of equal slots, which estimates the Jaccard similarity of the shingle sets."""
    return (one == other).mean(axis=-1)


def _packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows.astype("<u4")], pa.binary())


def with_signature(docs: DataFrame, name: str = "signature") -> DataFrame:
    """`docs` with the signature of each whole `text` (null: empty) as 256 bytes; equal texts have equal ones."""
    at = docs.columns.index("text")
    return with_columns(docs, f"{name} binary", lambda batch: [_packed(signatures(*text_buffers(batch.column(at))))])


def similar_pairs(docs: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): class of each row, and similar pairs of classes, verified.

    A class is one distinct text, named by its least doc_id; `members` has doc_id and class_id of every row. Pairs
    (a, b, jaccard), a < b, are classes whose 5-word shingle sets have a Jaccard similarity of `least` or more. Candidates share at
    least one of 16 bands of 4 slots: at similarity 0.8 a pair is missed once in 5,000. Bands meet in an equi-join of
    classes, so copies are not paired. Null and empty texts are one class without pairs; rows without doc_id belong
    to the class of their text, which has a null id, and no pairs, if no row of it has one.
    """
    keyed = settle(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", F.sha2("text", 256)), "texts")
    least_id = keyed.groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    members = keyed.select("doc_id", "digest").join(least_id, "digest").select("doc_id", "class_id")
    one = keyed.groupBy("digest").agg(F.min_by("text", "doc_id").alias("text"), F.min("doc_id").alias("class_id"))
    one = settle(with_signature(one.where("class_id is not null").select("class_id", "text")), "classes")
    size = 4 * SLOTS // BANDS
    some = one.where(F.expr("text rlike '[^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]'"))
    bands = some.select("class_id", F.posexplode(F.array(*(F.substring("signature", 1 + size * k, size) for k in range(BANDS)))).alias("band", "part"))
    bands = bands.select("class_id", F.xxhash64("band", "part").alias("key"))
    other = bands.select(F.col("class_id").alias("b"), "key")
    # An estimate far below the threshold rules a candidate out before texts are fetched: 0.4 of 64 slots is 6 deviations off.
    found = bands.select(F.col("class_id").alias("a"), "key").join(other, "key").where("a < b").select("a", "b").distinct()
    text = lambda x: some.select(F.col("class_id").alias(x), F.col("text").alias(f"text_{x}"))
    full = found.join(text("a"), "a").join(text("b"), "b").select("a", "b", "text_a", "text_b")

    def verify(batches):
        for batch in batches:
            found = []
            for one_, two in zip(batch.column(2), batch.column(3), strict=True):
                sets = [set(_shingles(*text_buffers(pa.array([x.as_py()])))[0].tolist()) for x in (one_, two)]
                found.append(len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], ["a", "b", "jaccard"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return members, full.mapInArrow(verify, f"a {kind}, b {kind}, jaccard double").where(F.col("jaccard") >= least)


def _ranges(docs: DataFrame, ranges: int) -> np.ndarray:
    """Least doc_id of every range but the first: `ranges` shares of the ids, from an approximate quantile sketch."""
    shares = [k / ranges for k in range(1, ranges)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 50_000).alias("q")).first()["q"] if shares else None
    return np.unique(np.array(found or [], np.int64))


def edited_neighbours(docs: DataFrame, ranges: int) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row.

    Rows go in descending order of doc_id; rows of one id by descending SHA-256 of the text, rows without an id last; after the last comes
    the first. The edited text has the last floor(n_chars / 2) code points of a text (null: empty) replaced by the first as many of the
    next row's text, or by all of it. A fingerprint is a signature in hexadecimal digits; likeness is the share of equal slots.
    A single row is its own next one. doc_id is an integer; other columns are not looked at.

    Ids are cut into `ranges` shares, one shuffle brings each share together (texts compressed), and each share's first row
    also goes to the share before it. Many rows of one id, or without any, are one share.
    """
    bounds = _ranges(docs, ranges)
    # The share of an id, from above: 0 for the largest ids, the last for ids below all bounds and for none.
    shares = len(bounds) + 1
    share = lambda ids: len(bounds) - np.searchsorted(bounds, ids, "right")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def extents(batches):
        best: dict[int, tuple] = {}
        for batch in batches:
            for k, t in _keys(batch):
                s = int(share(np.array([k[1]]))[0]) if k[0] else shares - 1
                if s not in best or (k, t) > best[s]:
                    best[s] = (k, t)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(best), pa.int32()), pa.array([k[1] if k[0] else None for k, _ in best.values()], pa.int64()), pa.array([t for _, t in best.values()], pa.binary())],
            ["share", "doc_id", "digest"],
        )

    # One row for each share: which row it begins with.
    heads = texts.mapInArrow(extents, "share int, doc_id long, digest binary").groupBy("share").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "digest")).alias("head"))
    heads = {r["share"]: (r["head"]["doc_id"], bytes(r["head"]["digest"])) for r in heads.collect()}
    filled = sorted(heads)
    before = {s: filled[k - 1] for k, s in enumerate(filled)}  # of the first share: the last one
    place = {heads[s]: before[s] for s in filled}

    def deal(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            out = []
            for (k, digest), text in zip(_keys(batch), batch.column(1), strict=True):
                doc = k[1] if k[0] else None
                s = int(share(np.array([doc]))[0]) if k[0] else shares - 1
                held = squeeze.compress(text.as_buffer())
                out.append((s, False, doc, digest, held))
                if (doc, digest) in place:
                    out.append((place[doc, digest], True, doc, digest, held))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["share", "ghost", "doc_id", "digest", "held"])

    def edit(batches):
        open_ = zstandard.ZstdDecompressor()
        last = None  # (share, doc_id, text, signature) that waits for its next row
        for batch in (b.slice(k, 512) for b in batches for k in range(0, len(b), 512)):
            table = batch.to_pydict()
            texts_ = [open_.decompress(h).decode() if h else "" for h in table["held"]]
            signs = signatures(*text_buffers(pa.array(texts_, pa.string())))
            pairs = []
            for s, ghost, doc, text, sign in zip(table["share"], table["ghost"], table["doc_id"], texts_, signs, strict=True):
                if last is not None and last[0] == s:
                    keep = len(last[2]) - len(last[2]) // 2
                    pairs.append((last[1], len(last[2]), last[2][:keep] + text[: len(last[2]) // 2], last[3], sign))
                last = None if ghost else (s, doc, text, sign)
            if not pairs:
                continue
            edited = signatures(*text_buffers(pa.array([p[2] for p in pairs], pa.string())))
            one, following = np.array([p[3] for p in pairs]), np.array([p[4] for p in pairs])
            out = [
                pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64()),
                pa.array([hashlib.sha256(p[2].encode()).hexdigest() for p in pairs]),
                pa.array([x.astype(">u4").tobytes().hex() for x in one]), pa.array([x.astype(">u4").tobytes().hex() for x in edited]),
                pa.array(likeness(one, edited)), pa.array(likeness(one, following)),
            ]
            yield pa.RecordBatch.from_arrays(out, names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    dealt = texts.mapInArrow(deal, "share int, ghost boolean, doc_id long, digest binary, held binary")
    # Of equal rows at a share's head only one is the next row, which a ghost stands for once.
    dealt = dealt.repartition(-(-shares // 4), "share").sortWithinPartitions("share", "ghost", F.col("doc_id").desc_nulls_last(), F.col("digest").desc())
    return dealt.mapInArrow(edit, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _keys(batch: pa.RecordBatch):
    """((has an id, id), digest) of each row: what rows are ordered by, from the largest down."""
    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        yield (doc is not None, doc), hashlib.sha256(text.as_buffer()).digest()
