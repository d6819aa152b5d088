"""N-gram Jaccard join by signature trees.

Each distinct set of word shingles has a bitmap signature. Sets meet in blocks, one for each shingle that is among the rarest of two sets
or more, so that every pair that can be similar meets in one. A block is a tree: nodes hold the OR of the bitmaps below them and
the range of set sizes, and a dual traversal drops pairs of nodes whose largest possible overlap is too small for any pair below
them, or whose sets are connected already. What is left is compared exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtide.llm.shared import LOWER_BYTE, SPACE_BYTE, components, fresh_path, give_back, grams, mixed, settle, slices, text_buffers, words
from runtide.llm.strtree import _groups

#: Buckets in which shingles are counted, to put frequent ones last (a power of two), and how far over the mean a bucket is frequent.
BUCKET_BITS, FREQUENT = 18, 2
#: Most sets of a block that one task compares with each other, and children of a node.
CHUNK, FAN = 2048, 8
#: Blocks of so many sets at most meet other blocks of their lead in one task, which gets each bitmap once.
TOGETHER = 64
#: Most sets of a block that are named together, and pairs or blocks that a task remembers to have named.
HELD, SEEN = 1 << 16, 1 << 18
#: Pairs tried first for each two components of a block, those with the most common bits.
TRIED = 3
#: 64-bit words of signatures that are compared at once.
_STEP = 1 << 20
#: Rows that are broadcast at most, of 8 bytes each.
BROADCAST_ROWS = 500_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of the runs of n words of each text; a text of fewer words has one, of none no hash.

    Words are runs of bytes other than ASCII blanks, A-Z lower-cased.
    """
    data = LOWER_BYTE[data]
    for a, b in slices(offsets):
        h, _, _, of_text = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ~SPACE_BYTE, lower=False)
        found, whole = grams(h, of_text, n)
        for x, y in zip(of_text[:-1].tolist(), of_text[1:].tolist(), strict=True):
            if y - x >= n:
                yield np.unique(found[x : y - n + 1])
            elif y > x:
                out = y - x
                for value in h[x:y].tolist():
                    out = (out * 0x9E3779B97F4A7C15 + value) % 2**64
                yield np.array([out], np.uint64)
            else:
                yield h[:0]


#: Counts of so many buckets travel in one row.
_SLICE = 4096


def _bucket_counts(docs: DataFrame, n: int) -> np.ndarray:
    """In how many texts the shingles of each hash bucket occur, over all texts; 2^18 numbers leave each task and reach the driver."""

    def rows(total):
        parts = total.reshape(-1, min(_SLICE, len(total)))
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([x.tobytes() for x in parts], pa.binary())], ["slice", "counts"])

    def count(batches):
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for found in shingle_sets(*text_buffers(batch.column(0)), n):
                np.add.at(total, (found >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), 1)
        yield rows(total)
        give_back()

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(held, np.int64)
        kinds = [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(kinds, ["slice", "counts"])

    layout = "slice int, counts binary"
    found = docs.select("text").mapInArrow(count, layout).repartition("slice").mapInArrow(add, layout).collect()
    if not found:
        return np.zeros(1 << BUCKET_BITS, np.int64)
    return np.concatenate([np.frombuffer(r["counts"], np.int64) for r in sorted(found)])


def _words_of_bitmap(n: int) -> int:
    """64-bit words of the bitmap of n hashes: a power of two, at least four bits a hash."""
    return 1 << max(0, (4 * n - 1) // 64).bit_length()


def _bitmap(found: np.ndarray) -> np.ndarray:
    out = np.zeros(_words_of_bitmap(len(found)), np.uint64)
    np.bitwise_or.at(out, (found >> np.uint64(6)).astype(np.int64) & (len(out) - 1), np.uint64(1) << (found & np.uint64(63)))
    return out


def _described(docs: DataFrame, n: int, least: int) -> tuple[DataFrame, int]:
    """Settled: row, doc_id, text, n, digest, bitmap, rare of every row of `docs`; and the number where frequent hashes begin.

    `rare` are the hashes, renumbered from rare to frequent buckets, that a set must share one of with every set of which
    the Jaccard similarity with it is least/100 or more: all but the ceil(least n / 100) - 1 last ones.
    """
    counts = _bucket_counts(docs, n)
    order_of = np.empty(len(counts), np.uint32)
    order_of[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(order_of)
    shift = np.uint64(64 - BUCKET_BITS)
    # Hashes of buckets that hold far more than their share are taken for shared ones without counting each.
    frequent = int(np.searchsorted(np.sort(counts), FREQUENT * counts.sum() / len(counts), "right"))

    def describe(batches):
        place = shared.value.astype(np.uint64)
        for batch in (b.slice(k, 2048) for b in batches for k in range(0, len(b), 2048)):
            sizes, digests, maps, rare = [], [], [], []
            for found in shingle_sets(*text_buffers(batch.column(2)), n):
                sizes.append(len(found))
                digests.append(hashlib.sha256(found.tobytes()).digest() if len(found) else None)
                maps.append(_bitmap(found).tobytes() if len(found) else None)
                order = (place[(found >> shift).astype(np.int64)] << shift) | (found & ((np.uint64(1) << shift) - np.uint64(1)))
                keep = len(found) - (least * len(found) + 99) // 100 + 1 if len(found) else 0
                rare.append((np.partition(order, keep - 1)[:keep] if keep else order) ^ np.uint64(2**63))  # as signed numbers in the same order
            ends = np.concatenate(([0], np.cumsum([len(x) for x in rare])))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rare).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(maps, pa.binary()), lists],
                ["row", "doc_id", "text", "n", "digest", "bitmap", "rare"],
            )
        give_back()

    whole = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    layout = f"row long, doc_id {kind}, text string, n long, digest binary, bitmap binary, rare array<long>"
    path = fresh_path(docs.sparkSession, "sets")
    whole.mapInArrow(describe, layout).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(layout).parquet(path), min((frequent << (64 - BUCKET_BITS)) - 2**63, 2**63 - 1)


def _with_hot(left: DataFrame, right: DataFrame, key: str, rows: int) -> DataFrame:
    """`left` joined with `right`, which has each key once and its `df` in `left`: keys that hold over 1/1024 of all rows, hence at most
    1,024, are broadcast, so that none gathers in a task; the others meet in a shuffle."""
    hot = F.col("df") > max(rows // 1024, 1)
    top = right.where(hot)
    rest = left.join(F.broadcast(top.select(key)), key, "left_anti").join(right.where(~hot), key)
    return left.join(F.broadcast(top), key).select(*rest.columns).union(rest)


class _Level:
    """Nodes of one level of a tree: OR of bitmaps, smallest and largest set, most hashes beyond one a bit, common component or -1."""

    def __init__(self, maps: np.ndarray, low: np.ndarray, high: np.ndarray, extra: np.ndarray, part: np.ndarray):
        self.maps, self.low, self.high, self.extra, self.part = maps, low, high, extra, part

    def above(self) -> _Level:
        first = np.arange(0, len(self.low), FAN)
        lowest, highest = np.minimum.reduceat(self.part, first), np.maximum.reduceat(self.part, first)
        return _Level(
            np.bitwise_or.reduceat(self.maps, first, axis=0), np.minimum.reduceat(self.low, first), np.maximum.reduceat(self.high, first),
            np.maximum.reduceat(self.extra, first), np.where(lowest == highest, lowest, -1),
        )


def _tree(maps: np.ndarray, n: np.ndarray, part: np.ndarray) -> list[_Level]:
    levels = [_Level(maps, n, n, n - np.bitwise_count(maps).sum(axis=1, dtype=np.int64), part)]
    while len(levels[-1].low) > FAN:
        levels.append(levels[-1].above())
    return levels


def _overlaps(one: _Level, a: np.ndarray, two: _Level, b: np.ndarray, least: int) -> np.ndarray:
    """The most common hashes that a pair of sets below each pair of nodes can have, -1 if it can't be a link between two components.

    Common hashes of two sets are at most the common bits plus the fewer hashes beyond one a bit. With o of them, sets of n and m
    hashes have a Jaccard similarity of least/100 or more if (100 + least) o >= least (n + m).
    """
    out = np.full(len(a), -1, np.int64)
    apart = (one.part[a] < 0) | (one.part[a] != two.part[b])
    at = np.flatnonzero(apart & (100 * one.high[a] >= least * two.low[b]) & (100 * two.high[b] >= least * one.low[a]))
    overlap = np.bitwise_count(one.maps[a[at]] & two.maps[b[at]]).sum(axis=1, dtype=np.int64) + np.minimum(one.extra[a[at]], two.extra[b[at]])
    overlap = np.minimum(overlap, np.minimum(one.high[a[at]], two.high[b[at]]))
    enough = (100 + least) * overlap >= least * (one.low[a[at]] + two.low[b[at]])
    out[at[enough]] = overlap[enough]
    return out


def dual_traversal(one: list[_Level], two: list[_Level], least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(index in `one`, index in `two`, most common hashes) of pairs of sets that the signatures don't rule out, each pair once; `two` may be
    `one` itself."""
    same, step = one is two, max(1, _STEP // one[0].maps.shape[1])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(one[-1].low)), np.arange(len(two[-1].low)), indexing="ij"))
    todo = [(len(one) - 1, len(two) - 1, a[a <= b] if same else a, b[a <= b] if same else b)]
    while todo:
        i, j, a, b = todo.pop()
        if len(a) > step:
            todo += [(i, j, a[k : k + step], b[k : k + step]) for k in range(0, len(a), step)]
            continue
        overlap = _overlaps(one[i], a, two[j], b, least)
        keep = overlap >= 0
        if same and i == 0:
            keep &= a < b
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        if i == j == 0:
            yield a, b, overlap[keep]
            continue
        # The higher node opens, both if they are level.
        grow_a, grow_b = i >= j, j >= i
        fan = np.arange(FAN)
        if grow_a:
            a, b = (a[:, None] * FAN + fan).ravel(), np.repeat(b, FAN)
            fit = a < len(one[i - 1].low)
            a, b, i = a[fit], b[fit], i - 1
        if grow_b:
            a, b = np.repeat(a, FAN), (b[:, None] * FAN + fan).ravel()
            fit = b < len(two[j - 1].low)
            a, b, j = a[fit], b[fit], j - 1
        if same:
            a, b = a[a <= b], b[a <= b]
        todo.append((i, j, a, b))


def block_pairs(maps: list[bytes], n: np.ndarray, part: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of indexes of the sets of a block that their signatures don't rule out, with the most hashes they can have in common;
    sets of one component `part` are not paired.

    Bitmaps of one size make a tree; against a tree of smaller ones it is made of bitmaps folded to their size.
    """
    size = np.array([len(m) // 8 for m in maps])
    trees: dict[int, tuple[np.ndarray, list[_Level]]] = {}
    for w in np.unique(size).tolist():
        at = np.flatnonzero(size == w)
        at = at[np.lexsort((part[at], n[at]))]
        held = np.frombuffer(b"".join(maps[k] for k in at.tolist()), np.uint64).reshape(len(at), w)
        trees[w] = at, _tree(held, n[at], part[at])
        for x, y, overlap in dual_traversal(trees[w][1], trees[w][1], least):
            yield at[x], at[y], overlap
        v = w
        while v > 1:
            v //= 2
            held = held[:, :v] | held[:, v:]
            if v in trees and 100 * int(n[trees[v][0]].max()) >= least * int(n[at].min()):
                for x, y, overlap in dual_traversal(_tree(held, n[at], part[at]), trees[v][1], least):
                    yield at[x], trees[v][0][y], overlap


def _spanning(pairs: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], part: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs that connect what earlier ones left apart, of those found together the likeliest first."""
    label = np.unique(part, return_inverse=True)[1]
    for a, b, overlap in pairs:
        order = np.argsort(-overlap, kind="stable")
        a, b = a[order], b[order]
        while len(a):
            apart = np.flatnonzero(label[a] != label[b])
            a, b = a[apart], b[apart]
            for x, y in zip(a[:64].tolist(), b[:64].tolist(), strict=True):
                if label[x] != label[y]:
                    label[label == label[y]] = label[x]
                    yield x, y
            a, b = a[64:], b[64:]


def _likeliest(pairs: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], part: np.ndarray, tried: int) -> tuple[list[tuple[int, int]], bool]:
    """The `tried` likeliest pairs of each two components, and whether there are more."""
    best: dict[tuple[int, int], list] = {}
    more = False
    for x, y, overlap in pairs:
        low, high = np.minimum(part[x], part[y]), np.maximum(part[x], part[y])
        order = np.lexsort((-overlap, high, low))
        place = np.arange(len(order))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
        kept = order[place - np.maximum.accumulate(np.where(fresh, place, 0)) < tried]
        more |= len(kept) < len(order)
        for k in kept.tolist():
            held = best.setdefault((int(low[k]), int(high[k])), [])
            held.append((-int(overlap[k]), int(x[k]), int(y[k])))
            if len(held) > tried:
                more = True
                held.remove(max(held))
    return [(x, y) for held in best.values() for _, x, y in held], more


def _groups_of(batches, keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """(keys, rows) of one group after another, from rows sorted by their first `keys` columns."""
    at, held = None, []
    for key, batch in _groups(batches, keys):
        if key != at and held:
            yield at, pa.Table.from_batches(held)
            held = []
        at = key
        held.append(batch)
    if held:
        yield at, pa.Table.from_batches(held)


def _blocks(shared: DataFrame, least: int) -> DataFrame:
    """Settled: (block, class, n, home, df), the sets of each block of `shared` (token, class, n).

    The sets of a token are split by size: they meet in the band of the larger one, where the smaller comes from the band below; only
    pairs with one that is at home there count. Blocks of the same sets, such as those of a passage that some texts share, are one:
    a block is named by 128 bits: its lead, which blocks with many common sets are likely to share, and a hash of its sets.
    """
    # A little wider than the ratio of similar sets, so that rounding puts no two of them further than a band apart.
    band = F.floor(F.log("n") / F.log(F.lit(100.0001 / least))).cast("int")
    place = F.explode(F.array(F.struct(band.alias("band"), F.lit(1).alias("home")), F.struct((band + 1).alias("band"), F.lit(0).alias("home"))))
    banded = shared.select("token", "class", "n", place.alias("p")).select("token", "p.band", "class", "n", "p.home")
    banded = banded.repartition("token", "band").sortWithinPartitions("token", "band", "class")

    def gather(batches):
        """Few sets are named together; a band of more than `HELD` goes on as it comes, under the name of its token."""
        seen: set[bytes] = set()
        names = ["block", "class", "n", "home"]

        def block(name, rows):
            return pa.RecordBatch.from_arrays([pa.array([name] * len(rows[0]), pa.binary()), *map(pa.array, rows)], names)

        at, held, size, name = None, [], 0, None

        def close():
            if name is None and size > 1:
                rows = [np.concatenate(c) for c in zip(*held, strict=True)]
                if rows[2].any():
                    lead = int(mixed(rows[0].view(np.uint64)).min()) >> 32
                    key = lead.to_bytes(4) + hashlib.blake2b(rows[0].tobytes() + rows[2].astype(np.uint8).tobytes(), digest_size=12).digest()
                    if key not in seen:
                        if len(seen) > SEEN:
                            seen.clear()
                        seen.add(key)
                        yield block(key, rows)

        for key, batch in _groups(batches, 2):
            if key != at:
                yield from close()
                at, held, size, name = key, [], 0, None
            rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4)]
            held.append(rows)
            size += len(rows[0])
            if size > HELD or name is not None:
                name = name or hashlib.blake2b(repr(key).encode(), digest_size=16).digest()
                for one in held:
                    yield block(name, one)
                held = []
        yield from close()
        give_back()

    found = banded.mapInArrow(gather, "block binary, class long, n long, home int").dropDuplicates(["block", "class", "home"])
    found = settle(found, "gathered")
    sizes = settle(found.groupBy("block").agg(F.count("*").alias("df")), "sizes")
    return settle(_with_hot(found, sizes, "block", found.count()), "blocks")


def _sent(open_: DataFrame, described: DataFrame, every: bool) -> DataFrame:
    """(task, class, part, n, places, bitmap), one row for each set of a task, dealt and sorted by task; `places` tell the blocks in which
    the set meets others there: block, i, j, chunks, c, home.

    Small blocks of one lead are a task. Blocks of more than `CHUNK` sets are cut into chunks `c` by a hash: chunks i and j meet in
    tasks of their own, all of them or each only the next one.
    """
    sized = open_.withColumn("chunks", F.ceil(F.col("df") / CHUNK).cast("int")).withColumn("c", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    all_ = F.sequence(F.lit(0), F.col("chunks") - 1)
    ring = F.array_distinct(F.transform(F.array(F.col("c"), F.pmod(F.col("c") - 1, F.col("chunks"))), lambda i: F.struct(i.alias("i"), i.alias("j"))))
    places = F.transform(all_, lambda j: F.struct(F.least("c", j).alias("i"), F.greatest("c", j).alias("j"))) if every else ring
    task = F.when(F.col("df") <= TOGETHER, F.xxhash64(F.substring("block", 1, 4))).otherwise(F.xxhash64("block", "p.i", "p.j"))
    sent = sized.withColumn("p", F.explode(places)).select("class", "part", "n", task.alias("task"), F.struct("block", "p.i", "p.j", "chunks", "c", "home").alias("place"))
    # One shuffle by set serves both the grouping and the join.
    sent = sent.repartition("class").groupBy("class", "task").agg(F.first("part").alias("part"), F.first("n").alias("n"), F.collect_list("place").alias("places"))
    sent = sent.join(described.select(F.col("row").alias("class"), "bitmap"), "class")
    return sent.select("task", "class", "part", "n", "places", "bitmap").repartition("task").sortWithinPartitions("task")


def _meetings(task: pa.Table) -> Iterator[tuple[bytes, int, int, dict[str, np.ndarray]]]:
    """(block, i, j, rows) of each block of a task, or two chunks of one: at, the rows of the sets in `task`, and their chunks, c, home."""
    lists = task["places"].combine_chunks()
    place, at = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    field = lambda x: place.field(x).to_numpy()
    block = place.field("block").dictionary_encode()
    code, i, j = block.indices.to_numpy(), field("i"), field("j")
    rows = {"at": at, **{x: field(x) for x in ("chunks", "c", "home")}}
    order = np.lexsort((at, j, i, code))
    code, i, j = code[order], i[order], j[order]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(code) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0))))
    for a, b in zip(first, [*first[1:], len(order)], strict=True):
        yield block.dictionary[code[a].item()].as_py(), int(i[a]), int(j[a]), {x: v[order[a:b]] for x, v in rows.items()}


def _candidates(blocks: DataFrame, parts: DataFrame | None, described: DataFrame, least: int, tried: int | None) -> tuple[DataFrame, DataFrame]:
    """(pairs, blocks): distinct pairs (a, b), a < b, that share a block and that their signatures don't rule out, and the blocks that
    may hold more of them.

    Sets of one component of `parts` (class, part) are not paired. Without `parts` the pairs of a block are only as many as connect all its
    candidates; with `tried` so many for each two components; else all. Of large blocks all chunks meet, without `parts` each only the
    next one (see `_sent`).
    """
    if parts is None:
        open_ = blocks.withColumn("part", F.col("class"))
    else:
        marked = settle(blocks.join(parts, "class", "left").withColumn("part", F.coalesce("part", "class")), "marked")
        open_of = marked.groupBy("block").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("df"))
        open_of = settle(open_of.where("low <> high").select("block", "df"), "mixed")
        open_ = _with_hot(marked.drop("df"), open_of, "block", marked.count())

    def compare(batches):
        seen = np.zeros((0, 2), np.int64)
        for _, task in _groups_of(batches, 1):
            classes, parts_of, sizes, maps = task["class"].to_numpy(), task["part"].to_numpy(), task["n"].to_numpy(), task["bitmap"].to_pylist()
            for block, i, j, rows in _meetings(task):
                at, chunk, home = rows["at"], rows["c"], rows["home"]
                ids, part = classes[at], parts_of[at]

                def fitting(i=i, j=j, at=at, chunk=chunk, home=home, part=part, maps=maps, sizes=sizes):
                    for x, y, overlap in block_pairs([maps[k] for k in at.tolist()], sizes[at], part, least):
                        keep = (home[x] | home[y]) > 0
                        if i != j:
                            keep &= chunk[x] != chunk[y]
                        yield x[keep], y[keep], overlap[keep]

                more = False
                if parts_none:
                    found = list(_spanning(fitting(), part))
                    more = bool(found) or rows["chunks"][0] > 1
                elif tried is not None:
                    found, more = _likeliest(fitting(), part, tried)
                else:
                    found = [(a, b) for x, y, _ in fitting() for a, b in zip(x.tolist(), y.tolist(), strict=True)]
                pairs = np.sort(ids[np.array(found, np.int64).reshape(-1, 2)], axis=1)
                # A pair is named once by a task, as long as it remembers.
                fresh = pairs[~np.isin(pairs.view("i8,i8").ravel(), seen.view("i8,i8").ravel())] if len(pairs) and len(seen) else pairs
                seen = np.concatenate((seen[-SEEN:], fresh))
                out = pa.array([block] if more else [], pa.binary())
                a, b = pa.array(fresh[:, 0].copy()), pa.array(fresh[:, 1].copy())
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([a, pa.nulls(len(out), pa.int64())]), pa.concat_arrays([b, pa.nulls(len(out), pa.int64())]), pa.concat_arrays([pa.nulls(len(a), pa.binary()), out])], ["a", "b", "block"])
        give_back()

    parts_none = parts is None
    found = settle(_sent(open_, described, not parts_none).mapInArrow(compare, "a long, b long, block binary").distinct(), "candidates")
    return found.where("block is null").select("a", "b"), blocks.join(found.where("block is not null").select("block"), "block", "left_semi")


def _representatives(described: DataFrame, classes: DataFrame) -> DataFrame:
    """(row, rare) of the first row of each class of `classes` (digest, class, df): the `rare` lists stay where they are while the rows
    to leave out are few enough to be broadcast, and meet the classes in a shuffle if not."""
    copied = classes.where("df > 1")
    copies = _with_hot(described.select("row", "digest"), copied, "digest", described.count()).where("row <> class")
    copies = settle(copies.select("row"), "copies")
    listed = described.where("digest is not null").select("row", "rare")
    if copies.count() <= BROADCAST_ROWS:
        return listed.join(F.broadcast(copies), "row", "left_anti")
    return listed.join(classes.select(F.col("class").alias("row")), "row", "left_semi")


def _verified(pairs: DataFrame, described: DataFrame, n: int, least: int) -> DataFrame:
    """Settled: the pairs (a, b) of rows whose texts' shingle sets have a Jaccard similarity of least/100 or more, and their `common`."""
    needed = settle(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "needed")
    # Few enough are broadcast; more meet the texts in a shuffle.
    texts = described.select("row", "text").join(F.broadcast(needed) if needed.count() <= BROADCAST_ROWS else needed, "row", "left_semi")
    side = lambda x: texts.select(F.col("row").alias(x), F.col("text").alias(f"text_{x}"))
    full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")

    def common(batches):
        for batch in (b.slice(k, 256) for b in batches for k in range(0, len(b), 256)):
            one, two = (shingle_sets(*text_buffers(batch.column(k)), n) for k in (2, 3))
            found = [(len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y)) for x, y in zip(one, two, strict=True)]
            both = np.array(found, np.int64).reshape(-1, 2)
            keep = pa.array(100 * both[:, 0] >= least * (both[:, 1] - both[:, 0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both[:, 0])], ["a", "b", "common"]).filter(keep)
        give_back()

    return settle(full.mapInArrow(common, "a long, b long, common long"), "links")


def _parts(links: DataFrame) -> DataFrame:
    return components(links.select("a", "b")).select(F.col("node").alias("class"), F.col("component").alias("part"))


def similar_sets(docs: DataFrame, n: int = 5, least: int = 80) -> tuple[DataFrame, DataFrame]:
    """(sets, links): every row of `docs` with its set, and links that connect the distinct sets as all similar pairs do.

    `sets` has row (a number), doc_id, text, n (hashes), digest and class (the least row with the same set; null without words). Links
    (a, b, common) are classes, a < b, that share `common` of their hashes: a pair has a similarity of least/100 or more, and pairs that
    are left out lie within what the others connect. Sets meet in blocks of shared rare shingles, which are gone through by
    signature, in three passes: pairs that would connect all candidates of a block are compared first; then, of blocks that had
    candidates, the likeliest pairs of each two components; then, of blocks that had more, every pair that is still apart.
    """
    described, frequent_from = _described(docs.select("doc_id", "text"), n, least)
    grouped = described.where("digest is not null").groupBy("digest").agg(F.min("row").alias("class"), F.count("*").alias("df"))
    classes = settle(grouped, "classes")
    tokens = _representatives(described, classes).select(F.explode("rare").alias("token"), F.col("row").alias("class"))
    salt = F.when(F.col("token") >= frequent_from, F.pmod(F.xxhash64("class"), F.lit(256))).otherwise(0)
    dealt = tokens.repartition("token", salt).sortWithinPartitions("token")

    def shared(batches):
        """Rows whose token occurs again or is a frequent one, from rows sorted by token."""
        token, rows, again = np.zeros(0, np.int64), np.zeros(0, np.int64), False
        for batch in batches:
            token, rows = np.concatenate((token, batch.column(0).to_numpy())), np.concatenate((rows, batch.column(1).to_numpy()))
            equal = token[1:] == token[:-1]
            if len(token) > 1:
                keep = np.concatenate(([again], equal)) | np.concatenate((equal, [False])) | (token >= frequent_from)
                yield pa.RecordBatch.from_arrays([pa.array(token[:-1][keep[:-1]]), pa.array(rows[:-1][keep[:-1]])], ["token", "class"])
                again = bool(equal[-1])
                token, rows = token[-1:], rows[-1:]
        if again or (len(token) and token[0] >= frequent_from):
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(rows)], ["token", "class"])

    again = dealt.mapInArrow(shared, "token long, class long")
    again = settle(again.join(described.select(F.col("row").alias("class"), "n"), "class").select("token", "class", "n"), "shared")
    pairs, blocks = _candidates(_blocks(again, least), None, described, least, None)
    links = _verified(pairs, described, n, least)
    for tried in (TRIED, None):
        pairs, blocks = _candidates(blocks, settle(_parts(links), "parts"), described, least, tried)
        links = links.union(_verified(pairs, described, n, least))
    columns = ("row", "doc_id", "text", "n", "digest", "class")
    sets = _with_hot(described, classes, "digest", described.count()).select(*columns)
    none = described.where("digest is null").withColumn("class", F.lit(None).cast("long")).select(*columns)
    return sets.union(none), links


def similar_groups(docs: DataFrame, n: int = 5, least: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest doc_id that links reach, itself included.

    Two rows link if the sets of their runs of `n` words share least/100 of their union or more. Words are runs of characters other than
    ASCII blanks in whole texts, A-Z lower-cased; fewer than `n` words are one run. Rows with a null or empty text, or without
    words, link with nothing and are their own component. Repeated rows and copies link. Rows without a doc_id link too, but name no
    component: where no row of theirs has an id, it is null. An empty table gives no rows. Other columns are not looked at.
    """
    sets, links = similar_sets(docs, n, least)
    parts = settle(_parts(links), "parts")
    members = settle(sets.select("doc_id", "n", "class"), "members")
    least_id = members.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first"), F.count("*").alias("df"))
    named = settle(least_id.join(parts, "class", "left").withColumn("part", F.coalesce("part", "class")), "named")
    first = named.groupBy("part").agg(F.min("first").alias("component_id"))
    named = settle(named.join(first, "part").select("class", "df", "component_id"), "components")
    found = _with_hot(members, named, "class", members.count())
    alone = members.where("class is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(alone)
