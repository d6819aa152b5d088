"""Token ids in binary shards compressed by Re-Pair grammars, with random access."""

from __future__ import annotations

import functools
import gc
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtide.llm.shared import SLICE_BYTES, fresh_path, give_back, slices, text_buffers

MAGIC = b"RPR1"
#: Ids of a shard; a longer document is a shard of its own.
SHARD_IDS = 1 << 20
#: Pairs replaced in one round, and how often a pair must occur to be replaced.
PAIRS_A_ROUND, LEAST_COUNT = 4096, 24
#: Rounds end when one shortens the sequence by less than this share.
LEAST_GAIN = 0.01
#: Distinct pieces that a worker keeps with their ids, most bytes of each (most have about 15), and bytes of text that are cut into pieces at once.
PIECES_KEPT, LONGEST_KEPT, TEXT_AT_ONCE = 1_000_000, 64, 3 << 23
#: A worker looks its pieces up if they are at most so many times those of the text at hand; entering them takes time, too.
KNOWN_A_PIECE = 16

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: White space of two and three bytes.
_WHITE = np.array(sorted(int.from_bytes(chr(c).encode()) for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def _ends(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the characters that end before some bytes (of places above 0) are white space, and whether they are letters for certain.

    Control characters count as white space.
    """
    last = data[at - 1]
    white, letter = last <= 32, _LETTER[last]
    high = np.flatnonzero(last >= 0x80)
    place = at[high]
    two = data[place - 2].astype(np.int64) << 8 | last[high]
    # A character of two bytes may be the first of all; what stands before it makes none of three bytes.
    three = data[place - 3].astype(np.int64) << 16 | two
    white[high] = np.isin(two, _WHITE) | np.isin(three, _WHITE)
    # Latin letters with marks: U+00C0 to U+017F but for the signs of multiplication and division.
    letter[high] = (two >= 0xC380) & (two < 0xC600) & (two != 0xC397) & (two != 0xC3B7)
    return white, letter


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of some texts begin: at the start of a text, of white space, and at an ASCII character that is no letter after a letter.

    No match of the pattern spans such a place: white space stands first in a match or makes all of it, and letters stand last. No match looks back.
    """
    first = np.zeros(len(data), bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    for k in range(0, len(data), SLICE_BYTES):
        some = data[k : k + SLICE_BYTES]
        # Bytes 9 to 13 and 32, then all other visible ASCII characters but letters.
        blank = ((some - np.uint8(9)) < 5) | (some == 32)
        sign = (some > 32) & (some < 0x80) & (((some | np.uint8(32)) - np.uint8(97)) >= 26)
        at = np.flatnonzero((blank | sign) & ~first[k : k + SLICE_BYTES])
        white, letter = _ends(data, at + k)
        first[at + k] = np.where(blank[at], ~white, letter)
    return np.flatnonzero(first)


def _places(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of some runs, one after another, and the n + 1 offsets of the runs."""
    ends = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    # Half the memory where places are short integers.
    kind = np.int32 if max(int(ends[-1]), int(starts.max(initial=0))) < 1 << 30 else np.int64
    place = np.repeat((starts - ends[:-1]).astype(kind), sizes)
    place += np.arange(len(place), dtype=kind)
    return place, ends


class PieceTokenizer:
    """Whole texts by the tokenizers library, which sees each distinct piece of text once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path)
        #: Texts that the library takes out of a text before it is cut, such as an end marker.
        self.added = [token.content for token in self.inner.get_added_tokens_decoder().values()]
        vocabulary = self.inner.get_vocab(with_added_tokens=True)
        self.kind = np.uint16 if max(vocabulary.values(), default=0) < 1 << 16 else np.uint32
        #: Bytes of each token: in this kind of vocabulary a character stands for a byte.
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        # Known pieces, the ids of all of them, how many each has, and the call that last met it.
        self.known, self.ids = pa.array([], pa.large_string()), np.zeros(0, self.kind)
        self.sizes, self.met, self.calls = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.inner.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for pieces that begin with white space and end with none: the library gets many at a time, since no token spans their borders."""
        data, offsets = text_buffers(pieces)
        texts = [data[offsets[k] : offsets[min(k + 512, len(pieces))]].tobytes().decode() for k in range(0, len(pieces), 512)]
        if any(a in t for a in self.added for t in texts):
            return self._single(pieces)
        ids = np.concatenate([np.zeros(0, self.kind), *self._encode(texts)])
        place = np.zeros(len(data) + 1, np.int64)
        place[np.cumsum(self.bytes[ids])] = np.arange(1, len(ids) + 1)
        return ids, np.diff(place[offsets])

    def _single(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self._encode(pieces.to_pylist())
        return np.concatenate([np.zeros(0, self.kind), *found]), np.fromiter(map(len, found), np.int64, len(found))

    def _learn(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces and their number for each."""
        data, offsets = text_buffers(pieces)
        head = data[offsets[:-1]]
        closed = ~_ends(data, offsets[1:])[0]
        blank = closed & (((head - np.uint8(9)) < 5) | (head == 32))
        # Visible ASCII in front: a line feed before such a piece is a token of its own.
        bare = closed & (head > 32) & (head < 0x7F)
        parts = []
        for mask, work in ((blank, self._joined), (bare, self._after_lines), (~blank & ~bare, self._single)):
            at = np.flatnonzero(mask)
            parts.append((at, *(work(pieces.take(pa.array(at))) if len(at) else (np.zeros(0, self.kind), np.zeros(0, np.int64)))))
        sizes = np.concatenate([p[2] for p in parts])
        back = np.argsort(np.concatenate([p[0] for p in parts]))
        place, _ = _places((np.cumsum(sizes) - sizes)[back], sizes[back])
        return np.concatenate([p[1] for p in parts])[place], sizes[back]

    def _after_lines(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = self._joined(pc.binary_join_element_wise(pa.scalar("\n", pa.large_string()), pieces, pa.scalar("", pa.large_string())))
        keep = np.ones(len(ids), bool)
        keep[np.cumsum(sizes) - sizes] = False
        return ids[keep], sizes - 1

    def _looked_up(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which entry each piece is, the number of ids of each entry, and the ids of all entries."""
        use = len(self.known) <= KNOWN_A_PIECE * len(pieces)
        known = self.known if use else self.known[:0]
        # Known pieces go in first, so that they keep their places.
        coded = pa.chunked_array([known, pieces]).dictionary_encode().chunks[-1]
        index, entries = coded.indices.to_numpy(), coded.dictionary
        ids, sizes = self._learn(entries[len(known) :])
        if not use:
            return index, sizes, ids
        ids, sizes = np.concatenate((self.ids, ids)), np.concatenate((self.sizes, sizes))
        met = np.concatenate((self.met, np.zeros(len(entries) - len(known), np.int64)))
        self.calls += 1
        met[index] = self.calls
        self.known, self.ids, self.sizes, self.met = entries, ids, sizes, met
        keep = np.flatnonzero(pc.binary_length(entries).to_numpy() <= LONGEST_KEPT)
        if len(keep) > PIECES_KEPT:
            keep = np.sort(keep[np.argpartition(met[keep], len(keep) - PIECES_KEPT)[len(keep) - PIECES_KEPT :]])
        if len(keep) < len(entries):
            place, _ = _places((np.cumsum(sizes) - sizes)[keep], sizes[keep])
            self.known, self.ids, self.sizes, self.met = entries.take(pa.array(keep)), ids[place], sizes[keep], met[keep]
        return index, sizes, ids

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Ids of each text (null: none). Texts are cut into pieces that Arrow makes distinct; a text that holds an added token goes whole to the library."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        whole = np.zeros(len(texts), bool)
        for a in self.added:
            whole |= pc.match_substring(texts, a).fill_null(False).to_numpy(zero_copy_only=False)
        data, offsets = text_buffers(pc.if_else(pa.array(whole), "", texts) if whole.any() else texts)
        starts = piece_starts(data, offsets)
        if len(starts):
            pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data))
            index, sizes, ids = self._looked_up(pieces)
        else:
            index, sizes, ids = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, self.kind)
        place, ends = _places((np.cumsum(sizes) - sizes)[index], sizes[index])
        found, bounds = ids[place], ends[np.searchsorted(starts, offsets)]
        out = [found[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for k in np.flatnonzero(whole).tolist():
            (out[k],) = self._encode([texts[k].as_py()])
        return out


@functools.lru_cache(2)
def tokenizer_of(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)


def _frequent(seq: np.ndarray, wide: bool, most: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all neighbouring pairs, the frequent ones sorted, and their counts."""
    shift = np.uint64(32) if wide else np.uint32(16)
    kind = np.uint64 if wide else np.uint32
    key = (seq[:-1].astype(kind) << shift) | seq[1:].astype(kind)
    ordered = np.sort(key)
    edge = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    count = np.diff(np.concatenate((edge, [len(ordered)])))
    often = np.flatnonzero(count >= least)
    if len(often) > most:
        often = np.sort(often[np.argpartition(-count[often], most - 1)[:most]])
    return key, ordered[edge[often]], count[often]


def _slots(key: np.ndarray) -> np.ndarray:
    """18 bits of a hash of each pair."""
    if key.dtype == np.uint32:
        return (key * np.uint32(0x9E3779B1)) >> np.uint32(14)
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.uint32)


def compress(ids: np.ndarray, pairs: int = PAIRS_A_ROUND, least: int = LEAST_COUNT) -> tuple[int, np.ndarray, np.ndarray]:
    """(first nonterminal, rules, sequence): Re-Pair in rounds, each replacing the most frequent pairs.

    Where chosen pairs overlap, the more frequent one is taken and, of equals, the first; runs of one id go in twos. Ends when no
    pair is frequent, when a round gains little, or when the next symbol would no longer fit 16 bits if all ids do.
    """
    base = int(ids.max()) + 1 if len(ids) else 0
    wide = base >= 1 << 16
    seq, rules = ids.astype(np.uint32), []
    while len(seq) > 1:
        room = pairs if wide else min(pairs, (1 << 16) - base - len(rules))
        if room <= 0:
            break
        key, chosen, count = _frequent(seq, wide, room, least)
        if not len(chosen):
            break
        # A small table by hash says which pair a position may hold; the few that it tells wrongly are searched.
        slot = _slots(key)
        held = np.full(1 << 18, -1, np.int32)
        held[_slots(chosen)] = np.arange(len(chosen), dtype=np.int32)
        which = held[slot]
        at = np.flatnonzero(which >= 0)
        which, mine = which[at].astype(np.int64), key[at]
        wrong = np.flatnonzero(chosen[which] != mine)
        which[wrong] = np.minimum(np.searchsorted(chosen, mine[wrong]), len(chosen) - 1)
        hit = chosen[which] == mine
        at, which = at[hit], which[hit]
        # Every second position of a run of one id, which only pairs of that id make.
        twins = np.flatnonzero(seq[at] == seq[at + 1])
        if len(twins):
            start = np.concatenate(([True], (np.diff(at[twins]) != 1) | (np.diff(which[twins]) != 0)))
            index = np.arange(len(twins))
            even = np.ones(len(at), bool)
            even[twins] = (index - np.maximum.accumulate(np.where(start, index, 0))) % 2 == 0
            at, which = at[even], which[even]
        weight = count[which]
        near = np.diff(at) == 1
        lose = np.zeros(len(at), bool)
        lose[1:] |= near & (weight[:-1] >= weight[1:])
        lose[:-1] |= near & (weight[1:] > weight[:-1])
        at, which = at[~lose], which[~lose]
        met = np.bincount(which, minlength=len(chosen)) > 0
        pair, which = chosen[met], (np.cumsum(met) - 1)[which]
        shift, low = (32, 0xFFFFFFFF) if wide else (16, 0xFFFF)
        symbol = base + len(rules)
        rules.extend(zip((pair >> pair.dtype.type(shift)).tolist(), (pair & pair.dtype.type(low)).tolist(), strict=True))
        seq[at] = (symbol + which).astype(np.uint32)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        if len(at) < LEAST_GAIN * len(keep):
            break
    return base, np.array(rules, np.uint32).reshape(-1, 2), seq


def _lengths(base: int, rules: np.ndarray) -> np.ndarray:
    """Ids that each nonterminal stands for."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1))
    return np.array(out, np.uint64)


def pack(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """A shard: header, document ends, rules, expansion lengths, sequence; integers are little-endian."""
    base, rules, seq = compress(ids)
    narrow = base + len(rules) <= 1 << 16
    head = struct.pack("<4sIQQQB", MAGIC, base, len(ends), len(rules), len(seq), 2 if narrow else 4)
    kind = "<u2" if narrow else "<u4"
    return b"".join((head, ends.astype("<u8").tobytes(), rules.astype(kind).tobytes(), _lengths(base, rules).astype("<u8").tobytes(), seq.astype(kind).tobytes()))


class Shard:
    """A packed shard: any range of ids is decoded without the rest."""

    def __init__(self, held: bytes | pa.Buffer):
        magic, self.base, docs, rules, size, width = struct.unpack_from("<4sIQQQB", held)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        kind, at = f"<u{width}", struct.calcsize("<4sIQQQB")
        self.ends = np.frombuffer(held, "<u8", docs, at).astype(np.int64)
        self.rules = np.frombuffer(held, kind, 2 * rules, at := at + 8 * docs).reshape(-1, 2).astype(np.uint32)
        self.lengths = np.frombuffer(held, "<u8", rules, at := at + 2 * width * rules).astype(np.int64)
        self.seq = np.frombuffer(held, kind, size, at + 8 * rules).astype(np.uint32)

    @functools.cached_property
    def bounds(self) -> np.ndarray:
        """Ids before each symbol of the sequence."""
        sizes = np.ones(len(self.seq), np.int64)
        more = self.seq >= self.base
        sizes[more] = self.lengths[self.seq[more] - self.base]
        return np.concatenate(([0], np.cumsum(sizes)))

    def expand(self, seq: np.ndarray) -> np.ndarray:
        while len(more := np.flatnonzero(seq >= self.base)):
            pair = self.rules[seq[more] - self.base]
            count = np.ones(len(seq), np.int64)
            count[more] = 2
            out = np.repeat(seq, count)
            place = more + np.arange(len(more))
            out[place], out[place + 1] = pair[:, 0], pair[:, 1]
            seq = out
        return seq

    def all_ids(self) -> np.ndarray:
        """All ids: every nonterminal is expanded once and then copied."""
        begin = np.cumsum(self.lengths) - self.lengths
        flat = self.expand(np.arange(self.base, self.base + len(self.rules), dtype=np.uint32))
        more = np.flatnonzero(self.seq >= self.base)
        which = self.seq[more] - self.base
        sizes = np.ones(len(self.seq), np.int64)
        sizes[more] = self.lengths[which]
        out = np.repeat(self.seq, sizes)
        ends = np.cumsum(sizes)
        into, _ = _places(ends[more] - sizes[more], sizes[more])
        taken, _ = _places(begin[which], sizes[more])
        out[into] = flat[taken]
        return out

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop: expands only the symbols that cover them."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first = int(np.searchsorted(self.bounds, start, "right")) - 1
        last = int(np.searchsorted(self.bounds, stop, "left"))
        return self.expand(self.seq[first:last])[start - self.bounds[first] : stop - self.bounds[first]]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, partitions: int | None = None) -> None:
    """Encodes every whole `text` (null: empty), appends `end_id`, and writes shards in ascending doc_id order to Parquet files.

    Rows: part and shard (their order is that of the ids), doc_ids, before (ids of the part before the shard), n_ids, and the packed shard. Rows without doc_id come first, rows of one
    id go by text; repeated rows are written each. Other columns are not looked at.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def work(batches):
        gc.disable()  # many small objects, no cycles
        encoder, shard = tokenizer_of(tokenizer), 0
        end = np.array([end_id], encoder.kind if end_id <= np.iinfo(encoder.kind).max else np.uint32)
        ids: list[np.ndarray] = []
        names: list = []
        size, part, before = 0, None, 0

        def flush():
            nonlocal ids, names, size, shard, before
            ends = np.cumsum([len(i) + 1 for i in ids])
            held = pack(np.concatenate([x for one in ids for x in (one, end)]), ends)
            row = [[part], [shard], [names], [before], [int(ends[-1])], [held]]
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary())
            ids, names, size, shard, before = [], [], 0, shard + 1, before + int(ends[-1])
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], ["part", "shard", "doc_ids", "before", "n_ids", "held"])

        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            known, part_of = batch.column(0).to_pylist(), batch.column(2)
            for a, b in slices(text_buffers(texts)[1], TEXT_AT_ONCE):
                part = part_of[0].as_py()
                for name, one in zip(known[a:b], encoder.encode(texts[a:b]), strict=True):
                    if ids and size + len(one) + 1 > SHARD_IDS:
                        yield flush()
                    ids.append(one)
                    names.append(name)
                    size += len(one) + 1
        if ids:
            yield flush()
        gc.enable()
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    laid = rows.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    laid = laid.withColumn("part", F.spark_partition_id())
    laid.mapInArrow(work, "part int, shard int, doc_ids array<long>, before long, n_ids long, held binary").write.parquet(path)


def read_shards(shards: DataFrame, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids (binary, little-endian unsigned 32-bit; left out if not `with_ids`) of every document of written shards.

    `start` counts the ids of all documents before it. A shard tells how many ids of its part come before it; one total for each part, of which
    there are as many as partitions wrote, goes through the driver and back to the shards, which stay where they are.
    """
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    ahead, begins = 0, []
    for r in totals:
        begins.append((r["part"], ahead))
        ahead += r["n"]
    begin = shards.sparkSession.createDataFrame(begins, "part int, ahead long")

    def work(batches):
        for batch in batches:
            for k in range(len(batch)):
                shard = Shard(batch.column(1)[k].as_buffer())
                every = shard.all_ids().astype("<u4", copy=False)
                starts = np.concatenate(([0], shard.ends[:-1]))
                held = [every[a:b] for a, b in zip(starts.tolist(), shard.ends.tolist(), strict=True)]
                columns = [batch.column(0)[k].values, pa.array(starts + batch.column(2)[k].as_py()), pa.array(shard.ends - starts), pa.array([zlib.crc32(h) for h in held], pa.int64())]
                if with_ids:
                    columns.append(pa.array([h.tobytes() for h in held], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    found = shards.join(F.broadcast(begin), "part").select("doc_ids", "held", (F.col("ahead") + F.col("before")).alias("at"))
    return found.mapInArrow(work, kinds)


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Writes all documents as shards (to a fresh folder of the shared one if `path` is not given) and reads them back."""
    spark = docs.sparkSession
    path = path or fresh_path(spark, "token-shards")
    write_shards(docs, path, tokenizer)
    return read_shards(spark.read.parquet(path), with_ids)
