"""Hard-negative mining by exact inner-product search in STR-packed R-trees.

Vectors are dealt to tiles by sort-tile-recursive cuts (the upper levels of one tree, whose boxes every task knows), and each tile is
packed into an R-tree by the task that searches it. The box of a node bounds the inner products of all vectors below it,
coordinate by coordinate; a best-first queue opens the most promising box next and drops boxes that lie outside of an anchor's
score windows or strictly below the k-th score found.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runtide.llm.shared import give_back, settle

#: Rows aimed at for a tile, the most tiles, the most rows of a tile that one task holds, and anchors a task takes for it.
TILE_ROWS, TILES, PIECE_ROWS, ANCHORS = 4096, 1024, 1 << 16, 1 << 16
#: Rows of a leaf, leaves of an inner node, and sampled rows that the cuts between tiles are fitted to.
LEAF_ROWS, FAN, SAMPLE = 128, 16, 8192
_NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Kind:
    """How vectors are held: components of `held`, `width` of them, products computed in `made` without loss."""

    held: str
    made: str
    width: int

    def matrix(self, column: pa.Array) -> np.ndarray:
        if not self.width:
            return np.zeros((len(column), 0), self.made)
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
        held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if len(column) else np.zeros(0, np.uint8)
        return np.frombuffer(held.tobytes(), self.held).reshape(len(column), self.width).astype(self.made)


def _cuts(points: np.ndarray, pages: int, axes: list[int]):
    """Sort-tile-recursive: slabs along the first axis, each cut along the next ones; (axis, cut values, parts), None uncut."""
    if pages <= 1 or not axes or len(points) < 2:
        return None
    slabs = int(np.ceil(pages ** (1 / len(axes))))
    at = np.sort(points[:, axes[0]])
    values = np.unique(at[[len(at) * k // slabs for k in range(1, slabs)]])
    part = np.searchsorted(values, points[:, axes[0]], "right")
    return axes[0], values, [_cuts(points[part == k], -(-pages // slabs), axes[1:]) for k in range(len(values) + 1)]


def _tiles_of(points: np.ndarray, cuts) -> np.ndarray:
    """The tile of each point, numbered in the order of the cuts."""
    out, number = np.zeros(len(points), np.int32), 0
    todo = [(cuts, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if node is None:
            out[rows] = number
            number += 1
            continue
        axis, values, parts = node
        part = np.searchsorted(values, points[rows, axis], "right")
        todo += [(parts[k], rows[part == k]) for k in reversed(range(len(parts)))]
    return out


def _packed(points: np.ndarray, rows: np.ndarray, pages: int, axes: list[int]) -> list[np.ndarray]:
    """Leaves of at most `LEAF_ROWS` rows by sort-tile-recursive on ranks, so that equal vectors are split as well."""
    if len(rows) <= LEAF_ROWS:
        return [rows]
    if not axes:
        return np.array_split(rows, -(-len(rows) // LEAF_ROWS))
    slabs = max(1, int(np.ceil(pages ** (1 / len(axes)))))
    rows = rows[np.argsort(points[rows, axes[0]], kind="stable")]
    return [leaf for slab in np.array_split(rows, slabs) for leaf in _packed(points, slab, -(-pages // slabs), axes[1:])]


class Tree:
    """An R-tree over the rows of a tile: leaves of rows, inner nodes of leaves, all under one root."""

    def __init__(self, points: np.ndarray, labels: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        axes = np.argsort(-points.astype(np.float64).var(axis=0), kind="stable").tolist()
        leaves = _packed(points, np.arange(len(points)), -(-len(points) // LEAF_ROWS), axes)
        order = np.concatenate(leaves)
        self.points, self.labels, self.ids, self.rows = points[order], labels[order], ids[order], rows[order]
        self.start = np.concatenate(([0], np.cumsum([len(x) for x in leaves])))
        self.low, self.high = (f.reduceat(self.points, self.start[:-1], axis=0) for f in (np.minimum, np.maximum))
        inner = np.arange(0, len(leaves), FAN)
        self.inner_low, self.inner_high = np.minimum.reduceat(self.low, inner, axis=0), np.maximum.reduceat(self.high, inner, axis=0)

    def search(self, anchor: np.ndarray, row: int, label: int, same: bool, low: np.ndarray, high: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(window, index, score) of the first k rows in each window [low, high] of scores; ties go to smaller ids.

        Rows of the anchor's label if `same`, else of others; `row`, the anchor's own, is left out.
        """
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        bound = low.copy()  # of each window: its lower end, later the k-th score
        best: list[list[tuple]] = [[] for _ in low]

        def useful(lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            most, least = highs @ up + lows @ down, lows @ up + highs @ down
            return most, np.flatnonzero(((most[:, None] >= bound) & (least[:, None] <= high)).any(axis=1))

        queue: list[tuple] = []
        most, some = useful(self.inner_low, self.inner_high)
        queue += [(-most[n], 0, n) for n in some.tolist()]
        heapq.heapify(queue)
        while queue:
            top, is_leaf, n = heapq.heappop(queue)
            if -top < bound.min():
                break
            if not is_leaf:
                a, b = n * FAN, min((n + 1) * FAN, len(self.low))
                most, some = useful(self.low[a:b], self.high[a:b])
                for m in some.tolist():
                    heapq.heappush(queue, (-most[m], 1, a + m))
                continue
            a, b = self.start[n], self.start[n + 1]
            score = self.points[a:b] @ anchor
            fit = (score >= bound.min()) & (score <= high.max())
            if not fit.any():
                continue
            fit &= (self.labels[a:b] == label) == same
            fit &= self.rows[a:b] != row
            at = np.flatnonzero(fit)
            for w in range(len(bound)) if len(at) else ():
                mine = at[(score[at] >= bound[w]) & (score[at] <= high[w])]
                if len(mine):
                    mine = mine[np.lexsort((self.ids[a + mine], -score[mine]))[:k]]
                    found = [(-score[m], self.ids[a + m], a + m) for m in mine.tolist()]
                    best[w] = heapq.nsmallest(k, best[w] + found)
                    if len(best[w]) == k:
                        bound[w] = max(bound[w], -best[w][-1][0])
        return [(w, index, int(-s)) for w, found in enumerate(best) for s, _, index in found]


def _groups(batches, keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of batches whose first `keys` columns are equal, with these."""
    for batch in batches:
        columns = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(keys)])
        cuts = [0, *(np.flatnonzero((np.diff(columns) != 0).any(axis=0)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield tuple(columns[:, a].tolist()), batch.slice(a, b - a)


@dataclass
class Index:
    """`rows` (tile, row, vec_id, label, vector), the tiles' boxes and numbers of rows; at most `TILES` tiles."""

    rows: DataFrame
    kind: Kind
    low: np.ndarray
    high: np.ndarray
    count: np.ndarray


def _packed_vectors(vectors: DataFrame, scale: int) -> tuple[DataFrame, Kind]:
    ok = F.col("label").isNotNull() & F.col("embedding").isNotNull()
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = whole.where(ok & finite)
    most = whole.agg(F.max(F.size("embedding")).alias("width"), F.max(F.array_max(F.transform("embedding", F.abs))).alias("most")).first()
    width, largest = most["width"] or 0, int(np.ceil(scale * (most["most"] or 0.0))) + 1
    if largest**2 * max(width, 1) >= 2**63:
        raise ValueError("inner products of these vectors need more than 64 bits")
    kind = Kind(next(k for k in ("int16", "int32", "int64") if largest <= np.iinfo(k).max), "float64" if largest**2 * max(width, 1) < 2**53 else "int64", width)

    def pack(batches):
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            full = np.zeros((len(batch), width), kind.held)
            full[np.arange(width) < sizes[:, None]] = flat.astype(kind.held)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in full], pa.binary())], ["vec_id", "label", "vector"])

    packed = whole.mapInArrow(pack, "vec_id long, label long, vector binary")
    return settle(packed.withColumn("row", F.monotonically_increasing_id()), "vectors"), kind


def build_index(vectors: DataFrame, scale: int = 256) -> Index:
    """Every row of `vectors` (vec_id, label, embedding) that takes part, in its tile.

    The cuts between tiles are fitted to at most 2 x 8,192 rows, chosen by a hash; all rows are dealt by them and the boxes cover
    all rows, so that the sample bears on speed only. Components x become floor(scale x).
    """
    rows, kind = _packed_vectors(vectors, scale)
    total = rows.count()
    share = -(-total // SAMPLE) or 1
    sample = rows.where(F.pmod(F.xxhash64("row"), F.lit(share)) == 0).limit(2 * SAMPLE).select("vector").toArrow()["vector"]
    points = np.concatenate([kind.matrix(chunk) for chunk in sample.chunks] or [np.zeros((0, kind.width), kind.made)])
    axes = np.argsort(-points.astype(np.float64).var(axis=0), kind="stable").tolist() if len(points) else []
    cuts = _cuts(points, min(TILES, -(-total // TILE_ROWS)), axes)

    def deal(batches):
        for batch in batches:
            tile = _tiles_of(kind.matrix(batch.column(0)), cuts)
            yield pa.RecordBatch.from_arrays([pa.array(tile), *(batch.column(k) for k in range(4))], ["tile", "vector", "row", "vec_id", "label"])

    tiled = settle(rows.select("vector", "row", "vec_id", "label").mapInArrow(deal, "tile int, vector binary, row long, vec_id long, label long"), "tiles")

    def boxes(batches, merged: bool = False):
        held: dict[int, list] = {}
        for batch in batches:
            tile = batch.column(0).to_numpy()
            low = kind.matrix(batch.column(1))
            high, n = (kind.matrix(batch.column(2)), batch.column(3).to_numpy()) if merged else (low, np.ones(len(tile), np.int64))
            for t in np.unique(tile).tolist():
                mine = tile == t
                new = [low[mine].min(axis=0), high[mine].max(axis=0), int(n[mine].sum())]
                old = held.get(t, new[:2] + [0])
                held[t] = [np.minimum(old[0], new[0]), np.maximum(old[1], new[1]), old[2] + new[2]]
        side = lambda k: pa.array([v[k].astype(kind.held).tobytes() for v in held.values()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), side(0), side(1), pa.array([v[2] for v in held.values()], pa.int64())], ["tile", "low", "high", "n"])

    layout = "tile int, low binary, high binary, n long"
    found = tiled.select("tile", "vector").mapInArrow(boxes, layout).repartition("tile").mapInArrow(lambda b: boxes(b, True), layout).toArrow()
    found = found.combine_chunks().to_batches()
    number = 1 + max((max(b.column(0).to_pylist()) for b in found), default=-1)
    low, high, count = np.zeros((number, kind.width), kind.made), np.zeros((number, kind.width), kind.made), np.zeros(number, np.int64)
    for b in found:
        at = b.column(0).to_numpy()
        low[at], high[at], count[at] = kind.matrix(b.column(1)), kind.matrix(b.column(2)), b.column(3).to_numpy()
    return Index(tiled, kind, low, high, count)


def _visit(index: Index, anchors: DataFrame, same: bool, k: int, home: bool) -> DataFrame:
    """(row, w, score, vec_id): the first k rows of each tile in each window `low`, `high` of each anchor, from its own tile or all others.

    Tiles whose box lies outside of an anchor's windows are not visited. A tile of more than `PIECE_ROWS` rows is searched
    in pieces, and rows meet anchors in blocks of about `ANCHORS`, so no task holds more, however anchors and rows heap up.
    """
    kind, low, high = index.kind, index.low, index.high
    pieces = np.maximum(1, -(-index.count // PIECE_ROWS))
    blocks = max(1, -(-anchors.count() // ANCHORS))

    def route(batches):
        for batch in (b.slice(j, 512) for b in batches for j in range(0, len(b), 512)):
            own, point = batch.column(0).to_numpy(), kind.matrix(batch.column(1))
            most = np.maximum(point, 0) @ high.T + np.minimum(point, 0) @ low.T
            least = np.maximum(point, 0) @ low.T + np.minimum(point, 0) @ high.T
            rows, tiles = [], []
            for j, (lows, highs) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                fit = np.zeros(len(low), bool)
                for a, z in zip(lows, highs, strict=True):
                    fit |= (most[j] >= a) & (least[j] <= z)
                fit &= ((np.arange(len(low)) == own[j]) == home) & (index_count > 0)
                for t in np.flatnonzero(fit).tolist():
                    rows += [j] * int(pieces[t])
                    tiles += [(t, p) for p in range(int(pieces[t]))]
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in tiles], pa.int32()), pa.array([p for _, p in tiles], pa.int32()), *taken.columns[1:]], ["tile", "piece", "vector", "row", "label", "low", "high"])

    index_count = index.count
    sent = anchors.select("tile", "vector", "row", "label", "low", "high")
    sent = sent.mapInArrow(route, "tile int, piece int, vector binary, row long, label long, low array<long>, high array<long>")
    sent = sent.select("tile", "piece", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), F.lit(1).alias("is_anchor"), "vector", "row", "label", F.lit(None).cast("long").alias("vec_id"), "low", "high")
    of_tile = F.array(*(F.lit(int(p)) for p in pieces)) if len(pieces) else F.array(F.lit(1))
    held = index.rows.withColumn("piece", F.pmod(F.xxhash64("row"), F.element_at(of_tile, F.col("tile") + 1).cast("long")).cast("int"))
    held = held.select("tile", "piece", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("is_anchor"), "vector", "row", "label", "vec_id", F.lit(None).cast("array<long>").alias("low"), F.lit(None).cast("array<long>").alias("high"))

    def run(batches):
        at, parts, tree = None, [], None
        for key, batch in _groups(batches, 4):
            if key[:3] != at:
                at, parts, tree = key[:3], [], None
            if not key[3]:
                parts.append(batch)
                continue
            if not parts:
                continue
            if tree is None:
                points = np.concatenate([kind.matrix(p.column(4)) for p in parts])
                column = lambda k: np.concatenate([p.column(k).to_numpy(zero_copy_only=False) for p in parts])
                ids = np.concatenate([p.column(7).fill_null(_NO_ID).to_numpy() for p in parts])
                tree = Tree(points, column(6), ids, column(5))
            out: list[tuple] = []
            for point, row, label, lows, highs in zip(kind.matrix(batch.column(4)), batch.column(5).to_pylist(), batch.column(6).to_pylist(), batch.column(8).to_pylist(), batch.column(9).to_pylist(), strict=True):
                for w, n, score in tree.search(point, row, label, same, np.array(lows, kind.made), np.array(highs, kind.made), k):
                    found = int(tree.ids[n])
                    out.append((row, w, score, None if found == _NO_ID else found))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["row", "w", "score", "vec_id"])
        give_back()

    dealt = held.union(sent).repartition("tile", "piece", "block").sortWithinPartitions("tile", "piece", "block", "is_anchor")
    return dealt.mapInArrow(run, "row long, w int, score long, vec_id long")


def search(index: Index, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """(row, w, rank, score, vec_id): the first k rows in each score window of each anchor, higher scores first, then smaller ids.

    `anchors` are rows of the index with `low` and `high`, arrays of windows. Their own tiles are searched first; the k-th score
    found there is where the search of the others may stop, so that few rows and tiles are left to it.
    """
    order = Window.partitionBy("row", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    first = settle(_visit(index, anchors, same, k, home=True), "own-tiles")
    ranked = first.withColumn("rank", F.row_number().over(order))
    kth = ranked.where(F.col("rank") == k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("kth"))
    raised = F.transform("low", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("kth", w), x)))
    closer = settle(anchors.join(kth, "row", "left").withColumn("low", raised).drop("kth"), "anchors")
    rest = settle(_visit(index, closer, same, k, home=False), "other-tiles")
    return first.union(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _shares(score: Column, percent: int) -> Column:
    """floor(percent score / 100) in whole numbers, without the product of both."""
    left = F.pmod(score, F.lit(100).cast("long"))
    whole = lambda x: F.call_function("div", x, F.lit(100))
    return whole(score - left) * F.lit(percent) + whole(left * F.lit(percent))


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: hard negatives of each anchor and positive.

    `vectors` has vec_id, label (integers) and embedding; anchors are the rows for which `anchor` holds. Scores are inner products of
    components floor(scale x), exact; a ValueError tells if they could need more than 64 bits. Higher scores come first, ties go to
    smaller ids, null ids last. An anchor's positives are its first `positives` other rows of its label, and their negatives the
    first `negatives` rows of other labels with least/100 <= negative / positive <= most/100 (multiplied out).
    Fewer come where there are fewer; a pair without any has no row.

    Rows with a null label, a null vector or a null or non-finite component take no part. Shorter vectors count as if ended by
    zeros, empty ones score 0. Repeated rows, and rows that share an id, are rows of their own, as anchors and as others. Empty tables
    give no rows. Other columns are not looked at.
    """
    index = build_index(vectors, scale)
    every = index.rows.where(anchor)
    open_ = lambda x: F.array(F.lit(x).cast("long"))
    near = search(index, every.withColumns({"low": open_(1 - 2**63), "high": open_(2**63 - 1)}), True, positives)
    near = settle(near.select("row", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # Positives of one score share a window.
    scores = near.groupBy("row").agg(F.array_sort(F.collect_set("positive_score")).alias("scores"))  # at most `positives`
    scores = scores.withColumn("scores", F.filter("scores", lambda s: -_shares(-s, least) <= _shares(s, most)))  # none if negative
    scores = scores.where(F.size("scores") > 0).withColumns({"low": F.transform("scores", lambda s: -_shares(-s, least)), "high": F.transform("scores", lambda s: _shares(s, most))})
    wanted = settle(every.join(scores, "row"), "windows")
    found = search(index, wanted.drop("scores"), False, negatives)
    found = found.join(wanted.select("row", F.col("vec_id").alias("anchor_id"), "scores"), "row")
    found = found.withColumn("positive_score", F.element_at("scores", F.col("w") + 1)).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    return near.join(found, ["row", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
