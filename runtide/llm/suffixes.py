"""Removal of repeated substrings by suffix sorting on a difference cover.

Starts of one anchor (their least 50-byte part) are a unit. Units whose whole strings are equal settle among themselves: the first one
stays. What is left are units that share an anchor and differ in what surrounds it; these strings are dealt by anchor, and each task sorts
the suffixes of its own: positions that are not a multiple of 3 are the sample, their triples are sorted and named, then triples
of names, until names are unique or cover `LENGTH` bytes. The remaining suffixes are sorted by a byte and the name after it and merged
with the sample, and neighbours are compared over `LENGTH` bytes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtide.llm.shared import _MIX, _powers, fresh_path, give_back, mixed, settle, slices, text_buffers
from runtide.llm.signature_trees import _groups_of

LENGTH, ANCHOR = 100, 50
#: Bytes of a text that are looked at together; pieces overlap by LENGTH - 1. Bytes of texts whose units are made together.
_PIECE, _BATCH = 1 << 19, 1 << 23
#: Documents that are looked through for anchors in many surroundings, and how many surroundings make one.
SAMPLE, MANY = 4096, 16

_DOC = np.dtype([("none", "u1"), ("id", "<i8"), ("row", "<i8")])
_UNIT = np.dtype([("h", "<u8"), ("u", "<u8"), ("doc", "<u4"), ("a", "<u4"), ("n", "u1")])
_RUN = np.dtype([("a", "<u4"), ("n", "<u4")])
_OPEN = np.dtype([("h", "<u8"), ("a", "<u4"), ("n", "u1")])


def anchor_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first start, last start) of the runs of starts whose LENGTH bytes have the same anchor.

    The anchor of a string is its ANCHOR-byte part of least hash, the leftmost of equals: equal strings have equal anchors. So a string
    can only repeat if its anchor's hash does.
    """
    n = len(data) - ANCHOR + 1
    power, inverse = _powers((1 << 20) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_MIX[data] * power[: len(data)], out=total[1:])
    h = mixed((total[ANCHOR:] - total[:n]) * inverse[:n])
    low = np.uint64((1 << 20) - 1)
    key = (h & ~low) | np.arange(n, dtype=np.uint64)
    least, width, reach = key, 1, LENGTH - ANCHOR + 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
    at = (least & low).astype(np.int64)
    edge = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return h[at[edge]], edge, np.concatenate((edge[1:], [len(at)])) - 1


def _units(data: np.ndarray, offsets: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The units of some texts: anchor hash, hash of the whole string, text, first start, number of starts.

    Starts whose anchor is in `often` (sorted) are units of their own, by two hashes of their bytes: they need no anchor to
    meet their equals, and no task gets all of an anchor that many texts surround differently.
    """
    found = []
    for k, (x, y) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        text = data[x:y]
        raw = text.tobytes()
        for at in range(0, max(0, len(text) - LENGTH + 1), _PIECE):
            h, a, b = anchor_runs(text[at : at + _PIECE + LENGTH - 1])
            hot = np.isin(h, often) if len(often) else np.zeros(len(h), bool)
            one = np.zeros(int((~hot).sum()), _UNIT)
            one["h"], one["doc"], one["a"], one["n"] = h[~hot], k, a[~hot] + at, (b - a + 1)[~hot]
            ends = one["a"].astype(np.int64) + one["n"] + (LENGTH - 1)
            one["u"] = [xxhash.xxh3_64_intdigest(raw[i:j]) for i, j in zip(one["a"].tolist(), ends.tolist(), strict=True)]
            found.append(one)
            if hot.any():
                starts = at + np.concatenate([np.arange(i, j + 1) for i, j in zip(a[hot].tolist(), b[hot].tolist(), strict=True)])
                one = np.zeros(len(starts), _UNIT)
                both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[i : i + LENGTH]) for i in starts.tolist()), ">u8").reshape(-1, 2)
                one["h"], one["u"], one["doc"], one["a"], one["n"] = both[:, 0], both[:, 1], k, starts, 1
                found.append(one)
    return np.concatenate(found) if found else np.zeros(0, _UNIT)


def _places(docs: np.ndarray) -> np.ndarray:
    """The rank of each document: by id, none last, then by row; rows of one document have the same."""
    order = np.lexsort((docs["row"], docs["id"], docs["none"]))
    row = docs["row"][order]
    out = np.empty(len(docs), np.int64)
    out[order] = np.cumsum(np.concatenate(([0], row[1:] != row[:-1]))) if len(order) else order
    return out


def _first_units(units: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): an order of the units by anchor, string and place, and whether each is the first of its string in it."""
    order = np.lexsort((units["a"], place[units["doc"]], units["u"], units["h"]))
    h, u = units["h"][order], units["u"][order]
    return order, np.concatenate(([True], (h[1:] != h[:-1]) | (u[1:] != u[:-1]))) if len(order) else np.zeros(0, bool)


def _runs_by_row(rows: np.ndarray, a: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(row, runs of starts) with adjoining runs joined."""
    order = np.lexsort((a, rows))
    rows, a, n = rows[order], a[order].astype(np.int64), n[order].astype(np.int64)
    if not len(rows):
        return
    first = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (a[1:] != a[:-1] + n[:-1]))))
    out = np.zeros(len(first), _RUN)
    out["a"], out["n"] = a[first], np.add.reduceat(n, first)
    cuts = np.flatnonzero(np.concatenate(([True], rows[first][1:] != rows[first][:-1])))
    for i, j in zip(cuts, np.append(cuts[1:], len(first)), strict=True):
        yield int(rows[first[i]]), out[i:j].tobytes()


def _batch(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _hot_anchors(rows: DataFrame, total: int) -> np.ndarray:
    """Hashes of anchors that have `MANY` or more surroundings in a sample of about `SAMPLE` documents; these bound their number.

    The sample bears on how units are dealt, not on what is found.
    """
    share = -(-total // SAMPLE) or 1

    def anchors(batches):
        for batch in batches:
            units = _units(*text_buffers(batch.column(0)), np.zeros(0, np.uint64))
            units = np.unique(units[["h", "u"]])
            yield pa.RecordBatch.from_arrays([pa.array(units["h"].copy().view(np.int64)), pa.array(units["u"].copy().view(np.int64))], ["h", "u"])

    some = rows.where(F.pmod(F.xxhash64("row"), F.lit(share)) == 0).limit(2 * SAMPLE).select("text")
    found = some.mapInArrow(anchors, "h long, u long").distinct().groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= MANY)
    return np.sort(np.array([r["h"] for r in found.select("h").collect()], np.int64).view(np.uint64))


def _settled_units(rows: DataFrame, parts: int, often: np.ndarray) -> DataFrame:
    """Settled: row, kind, held. Kind 0: runs of starts whose units are equal to earlier ones; 1: first units that share their anchor with others.

    Tasks first settle the units of the texts they see together, so of a frequent unit one goes on from each. Units travel packed, 25
    bytes each, dealt by anchor.
    """
    shared = rows.sparkSession.sparkContext.broadcast(often)
    local_names, local_kinds = ["part", "kind", "row", "docs", "held"], [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]

    def local(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(2))
            for x, y in slices(offsets, _BATCH):
                docs = np.zeros(y - x, _DOC)
                docs["row"], ids = batch.column(0).to_numpy()[x:y], batch.column(1).slice(x, y - x)
                docs["none"], docs["id"] = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
                units = _units(data[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x], shared.value)
                order, first = _first_units(units, _places(docs))
                again, units = units[order[~first]], units[order[first]]
                out = [(row % parts, 0, row, None, held) for row, held in _runs_by_row(docs["row"][again["doc"]], again["a"], again["n"])]
                part = (units["h"] % np.uint64(parts)).astype(np.int64)
                by = np.argsort(part, kind="stable")
                ends = np.concatenate(([0], np.cumsum(np.bincount(part, minlength=parts))))
                for p in range(parts):
                    mine = units[by[ends[p] : ends[p + 1]]]
                    if len(mine):
                        used, mine["doc"] = np.unique(mine["doc"], return_inverse=True)
                        out.append((p, 1, None, docs[used].tobytes(), mine.tobytes()))
                yield _batch(local_names, local_kinds, out)
        give_back()

    def settle_part(batches):
        names, kinds = ["row", "kind", "held"], [pa.int64(), pa.int32(), pa.binary()]
        for _, table in _groups_of(batches, 1):
            out = [(r["row"], 0, r["held"]) for r in table.select(["row", "kind", "held"]).to_pylist() if not r["kind"]]
            docs, units, ahead = [], [], 0
            for kind, d, u in zip(table["kind"].to_pylist(), table["docs"].to_pylist(), table["held"].to_pylist(), strict=True):
                if kind:
                    docs.append(np.frombuffer(d, _DOC))
                    one = np.frombuffer(u, _UNIT).copy()
                    one["doc"] += ahead
                    ahead += len(docs[-1])
                    units.append(one)
            if units:
                docs, units = np.concatenate(docs), np.concatenate(units)
                order, first = _first_units(units, _places(docs))
                again, units = units[order[~first]], units[order[first]]
                out += [(row, 0, held) for row, held in _runs_by_row(docs["row"][again["doc"]], again["a"], again["n"])]
                same = units["h"][1:] == units["h"][:-1]
                units = units[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
                rows_ = docs["row"][units["doc"]]
                by = np.argsort(rows_, kind="stable")
                open_ = np.zeros(len(units), _OPEN)
                for c in ("h", "a", "n"):
                    open_[c] = units[c][by]
                cuts = np.flatnonzero(np.concatenate(([True], np.diff(rows_[by]) != 0))) if len(by) else by
                out += [(int(rows_[by[i]]), 1, open_[i:j].tobytes()) for i, j in zip(cuts, np.append(cuts[1:], len(by)), strict=False)]
            yield _batch(names, kinds, out)
        give_back()

    dealt = rows.select("row", "id", "text").mapInArrow(local, "part int, kind int, row long, docs binary, held binary")
    dealt = dealt.repartition(parts, "part").sortWithinPartitions("part")
    return settle(dealt.mapInArrow(settle_part, "row long, kind int, held binary"), "units")


def _names(keys: list[np.ndarray]) -> tuple[int, np.ndarray]:
    """Number of distinct tuples of keys (below 2^31 each), and the rank of each from 1."""
    out = keys[0]
    for key in keys[1:]:
        out = np.unique((out.astype(np.int64) << 32) | key, return_inverse=True)[1]
    return int(out.max()) + 1 if len(out) else 0, out.astype(np.int64) + 1


def suffix_order(t: np.ndarray, least: int = LENGTH) -> np.ndarray:
    """All positions of `t` (values 0 to 256) in the order of their suffixes, at least by their first `least` values."""
    n = len(t)
    t = np.concatenate((t.astype(np.int64), np.zeros(3, np.int64)))
    sample = np.flatnonzero(np.arange(n) % 3)
    # Sort and name the sampled triples, then triples of names: of 3, 9, 27 values; these steps keep a position's remainder.
    _, name = _names([np.unique((t[sample] << 18) | (t[sample + 1] << 9) | t[sample + 2], return_inverse=True)[1]])
    reach = 3
    while True:
        full = np.zeros(n + 2 * reach + 3, np.int64)
        full[sample] = name
        if reach >= least + 2 or len(name) == (int(name.max()) if len(name) else 0):
            break
        _, name = _names([name, full[sample + reach], full[sample + 2 * reach]])
        reach *= 3
    in_sample = sample[np.argsort(full[sample], kind="stable")]
    # The remaining suffixes, by a value and the name after it.
    one = (t[:n] << 40) | full[1 : n + 1]
    two = (t[:n] << 49) | (t[1 : n + 1] << 40) | full[2 : n + 2]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(one[rest], kind="stable")]
    # Merge: one value or two before sampled positions on both sides, whichever it takes.
    low, high = np.zeros(len(rest), np.int64), np.full(len(rest), len(in_sample))
    while (low < high).any():
        at = (low + high) // 2
        j = in_sample[np.minimum(at, len(in_sample) - 1)] if len(in_sample) else at
        before = np.where(j % 3 == 1, one[j] < one[rest], two[j] < two[rest]) & (low < high)
        low, high = np.where(before, at + 1, low), np.where(before | (low >= high), high, at)
    # Names that are not unique tell their own values only, and the search reads one or two more: among equals of `least` values it
    # may end anywhere, but places must not go back.
    low = np.maximum.accumulate(low)
    out = np.empty(n, np.int64)
    place = low + np.arange(len(rest))
    mine = np.ones(n, bool)
    mine[place] = False
    out[place], out[mine] = rest, in_sample
    return out


_CUT = np.dtype([("h", "<u8"), ("none", "u1"), ("id", "<i8"), ("row", "<i8"), ("a", "<u4"), ("n", "u1")])


def _repeated_in(units: np.ndarray, text: np.ndarray) -> np.ndarray:
    """(unit, start) of the starts of units whose LENGTH bytes also start earlier in one of them; `text`: their strings, one after another."""
    sizes = units["n"].astype(np.int64) + LENGTH - 1
    begin = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(units)), sizes)
    place = np.arange(len(text)) + owner  # a zero goes between strings
    t = np.zeros(len(text) + len(units), np.int64)
    t[place] = text.astype(np.int64) + 1
    unit = np.repeat(np.arange(len(units)), sizes + 1)
    within = np.arange(len(t)) - begin[unit]
    order = suffix_order(t)
    order = order[within[order] < units["n"][unit[order]]]
    # Neighbours are compared over LENGTH bytes.
    window = np.lib.stride_tricks.sliding_window_view(t.astype(np.uint16), LENGTH)
    equal = np.zeros(len(order), bool)
    for k in range(1, len(order), 1 << 15):
        one, other = order[k - 1 : k - 1 + (1 << 15)], order[k : k + (1 << 15)]
        equal[k : k + len(other)] = (window[one[: len(other)]] == window[other]).all(axis=1)
    group = np.flatnonzero(~equal)
    rank = _places(units)
    key = (rank[unit[order]] << 32) | (units["a"][unit[order]].astype(np.int64) + within[order])
    least = np.minimum.reduceat(key, group) if len(order) else key
    again = order[key > np.repeat(least, np.diff(np.append(group, len(order))))]
    return np.stack((unit[again], within[again]), axis=1)


def _merged_units(found: DataFrame, rows: DataFrame, parts: int) -> DataFrame:
    """Settled: row, kind 0, runs of starts that also start earlier in another unit of their anchor."""
    open_ = found.where("kind = 1").groupBy("row").agg(F.collect_list("held").alias("open"))  # of one document
    names, kinds = ["part", "units", "text"], [pa.int32(), pa.binary(), pa.binary()]

    def cut(batches):
        for batch in (b.slice(k, 2048) for b in batches for k in range(0, len(b), 2048)):
            units, strings = [], []
            for row, id_, text, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                mine = np.frombuffer(b"".join(held), _OPEN)
                one = np.zeros(len(mine), _CUT)
                one["row"], one["none"], one["id"] = row, id_ is None, id_ or 0
                for c in ("h", "a", "n"):
                    one[c] = mine[c]
                units.append(one)
                strings += [raw[a : a + n + LENGTH - 1] for a, n in zip(mine["a"].tolist(), mine["n"].tolist(), strict=True)]
            units = np.concatenate(units) if units else np.zeros(0, _CUT)
            part = (mixed(units["h"].astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
            out = []
            for p in np.unique(part).tolist():
                at = np.flatnonzero(part == p)
                out.append((p, units[at].tobytes(), b"".join([strings[k] for k in at.tolist()])))
            yield _batch(names, kinds, out)
        give_back()

    def sort(batches):
        for _, table in _groups_of(batches, 1):
            units = np.frombuffer(b"".join(table["units"].to_pylist()), _CUT)
            text = np.frombuffer(b"".join(table["text"].to_pylist()), np.uint8)
            again = _repeated_in(units, text)
            start = units["a"][again[:, 0]].astype(np.int64) + again[:, 1]
            runs = _runs_by_row(units["row"][again[:, 0]], start, np.ones(len(again), np.int64))
            yield _batch(["row", "kind", "held"], [pa.int64(), pa.int32(), pa.binary()], [(row, 0, held) for row, held in runs])
        give_back()

    strings = rows.join(open_, "row").select("row", "id", "text", "open").mapInArrow(cut, "part int, units binary, text binary")
    dealt = strings.repartition(parts, "part").sortWithinPartitions("part")
    return settle(dealt.mapInArrow(sort, "row long, kind int, held binary"), "merged")


def _spans(runs: np.ndarray) -> list[tuple[int, int]]:
    """Bytes covered by the strings of runs of starts, as maximal spans."""
    if not len(runs):
        return []
    runs = np.sort(runs, order="a")
    start, end = runs["a"].astype(np.int64), runs["a"].astype(np.int64) + runs["n"] + (LENGTH - 1)
    end = np.maximum.accumulate(end)
    first = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    return list(zip(start[first].tolist(), end[np.append(first[1:], len(start)) - 1].tolist(), strict=True))


def _laid_out(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, id, row and text of all rows, in a table laid out by row: texts are shuffled once, and joined where they lie."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).repartition(parts, "row")
    name = f"suffix_rows_{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").option("path", fresh_path(spark, "rows")).bucketBy(parts, "row").saveAsTable(name)
    return spark.table(name)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary): whole texts as UTF-8 without repeated substrings.

    Every byte goes that is covered by a LENGTH-byte string which also starts earlier: in a document with a smaller doc_id, or before in the
    same one. Rows without an id come last; rows of one id go in an arbitrary but fixed order. A null text is empty. Repeated rows are
    rows of their own: all but the first lose all bytes, if they have LENGTH or more. An empty table gives no rows. doc_id is an
    integer; extra columns are not looked at.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _laid_out(docs, parts)
    found = _settled_units(rows, parts, _hot_anchors(rows, rows.count()))
    merged = _merged_units(found, rows, parts)
    # Of one document: no more than it has bytes.
    runs = found.where("kind = 0").union(merged).groupBy("row").agg(F.collect_list("held").alias("runs"))
    joined = rows.join(runs, "row", "left").select("doc_id", "text", "runs")

    def remove(batches):
        for batch in (b.slice(k, 1024) for b in batches for k in range(0, len(b), 1024)):
            out = []
            for doc, text, held in zip(*(batch.column(k) for k in range(3)), strict=True):
                raw, kept, at, removed = text.as_py().encode(), [], 0, 0
                spans = _spans(np.frombuffer(b"".join(held.as_py() or []), _RUN))
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                    removed += b - a
                kept = b"".join([*kept, raw[at:]])
                out.append((doc.as_py(), len(raw), removed, len(spans), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [batch.column(0).type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield _batch(["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"], kinds, out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
