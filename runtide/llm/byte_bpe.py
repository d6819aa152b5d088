"""Byte-level BPE in DuckDB, one in-process database for each Spark worker.

A recursive query starts from one row for each byte of a word, joins neighbouring rows with the merge table and contracts the leftmost pair
of least rank of every word until no word has a pair left; an ordered aggregation turns ids back into bytes. Spark deals
out the documents, and a worker asks the database once for each distinct word that it meets.
"""

from __future__ import annotations

import array
import base64
import functools
import gc
import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from runtide.llm.shared import slices, text_buffers, with_columns

#: Words and bytes that go through one recursive query, and the distinct pieces of text that a worker keeps.
WORDS_AT_ONCE, BYTES_AT_ONCE, PIECES_KEPT = 1 << 15, 1 << 20, 500_000
#: Bytes of text whose pieces are held at once, and the same for a worker that is told to keep fewer pieces.
TEXT_AT_ONCE, LESS_AT_ONCE = 1 << 22, 1 << 19
#: Longer words may hold many occurrences of a pair: those take all of them in one step where that is the same.
SHORT = 64
#: Words beyond `LONG` bytes are encoded in windows of `WINDOW` bytes, each half in the one before, that are joined where they agree.
LONG, WINDOW = 256, 192
#: Steps of one recursion for long words; the state is then handed to the next one, so that rows of old steps go.
STEPS_AT_ONCE = 48

_STATE = "(SELECT step, w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt FROM t)"
_PAIRED = f"""(SELECT l.step, l.w, l.pos, l.tok, m.safe, (m.rank::BIGINT << 34) + l.pos AS k
    FROM {_STATE} l LEFT JOIN merges m ON m.pair = (l.tok::BIGINT << 20) + l.nxt)"""
_FINAL = """SELECT w, pos, tok FROM (SELECT *, max(step) OVER (PARTITION BY w) AS last FROM t) WHERE step = last"""
#: The leftmost pair of least rank of each word is contracted; the row after it goes. Rows stay in the order of words and positions
#: (one thread, order-preserving operators), so neighbours need no sort; `encode_words` checks each result by its bytes.
SHORT_SQL = f"""
WITH RECURSIVE t(step, w, pos, tok) AS (
  SELECT 0, w, pos, tok FROM start_rows
  UNION ALL (
    WITH paired AS MATERIALIZED (
      SELECT l.step, l.w, l.pos, l.tok, (m.rank::BIGINT << 34) + l.pos AS k, lag(k) OVER () AS before
      FROM (SELECT step, w, pos, tok, CASE WHEN lead(w) OVER () = w THEN lead(tok) OVER () END AS nxt FROM t) l
      LEFT JOIN merges m ON m.pair = (l.tok::BIGINT << 20) + l.nxt
    ), least AS (SELECT w, min(k) AS best FROM paired GROUP BY w HAVING min(k) IS NOT NULL)
    SELECT step + 1, paired.w, pos, CASE WHEN k = best THEN (best >> 34)::INTEGER ELSE tok END
    FROM paired JOIN least ON paired.w = least.w
    WHERE before IS DISTINCT FROM best
  )
) {_FINAL}"""
#: If no merge of the new token has a lower rank, the next leftmost pair of least rank is the next one of the same rank: all of
#: them that don't overlap (every second of a run, from its start) are contracted at once.
LONG_SQL = f"""
WITH RECURSIVE t(step, w, pos, tok) AS (
  SELECT 0, w, pos, tok FROM start_rows
  UNION ALL
  SELECT step + 1, w, pos, CASE WHEN hit THEN (best >> 34)::INTEGER ELSE tok END
  FROM (
    SELECT *, lag(hit) OVER (PARTITION BY w ORDER BY pos) AS after
    FROM (
      SELECT *, k = best OR (coalesce(same AND safe, false) AND (row_number() OVER (PARTITION BY w, island ORDER BY pos)) % 2 = 1) AS hit
      FROM (
        SELECT *, n - count(*) FILTER (same) OVER (PARTITION BY w ORDER BY pos) + CASE WHEN same THEN 0 ELSE -1000000000 END AS island
        FROM (
          SELECT *, coalesce((k >> 34) = (best >> 34), false) AS same, row_number() OVER (PARTITION BY w ORDER BY pos) AS n
          FROM (SELECT *, min(k) OVER (PARTITION BY w) AS best FROM {_PAIRED})
          WHERE best IS NOT NULL AND step < {STEPS_AT_ONCE}
        )
      )
    )
  )
  WHERE NOT coalesce(after, false)
) {_FINAL}"""
DECODE_SQL = """
SELECT w, CAST(string_agg(tok || ',', '' ORDER BY pos) AS BLOB) AS ids, unhex(string_agg(hex, '' ORDER BY pos)) AS bytes
FROM ids JOIN vocabulary ON id = tok GROUP BY w ORDER BY w"""


class BytePairs:
    """Encodes and decodes words by the ranks of a .tiktoken file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        # Flat arrays: a list of tuples would take ten times their memory.
        a, b, rank = (array.array("q") for _ in range(3))
        least: dict[int, int] = {}
        for t, r in self.ranks.items():
            for i in range(1, len(t)):
                left, right = self.ranks.get(t[:i]), self.ranks.get(t[i:])
                if left is not None and right is not None:
                    a.append(left), b.append(right), rank.append(r)
                    for part in (left, right):
                        least[part] = min(r, least.get(part, r))
        a, b, rank = (np.frombuffer(c, np.int64) for c in (a, b, rank))
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        safe = pa.array([least.get(r, r + 1) > r for r in rank.tolist()])
        merges = pa.table({"pair": (a << 20) + b, "rank": rank.astype(np.int32), "safe": safe})  # noqa: F841
        vocabulary = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "hex": [t.hex() for t in self.ranks]})  # noqa: F841
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges").execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary")
        self.words_at_once = WORDS_AT_ONCE
        self.forget()

    def forget(self) -> None:
        self.known, self.pieces = {}, ({}, {})
        self.older = self.known, self.pieces

    def age(self, most: int) -> None:
        """Starts a new generation once one holds `most` pieces; what is asked for again comes along, the rest goes with the next."""
        if len(self.known) + len(self.pieces[0]) + len(self.pieces[1]) > most:
            self.older = self.known, self.pieces
            # word -> (ids as text, decoded bytes, True); by whether a space comes before: piece -> the same and whether it is one word
            self.known, self.pieces = {}, ({}, {})

    def _rows(self, words: list[bytes]) -> pa.Table:
        """One row for each byte, or one for the whole word if the vocabulary has it."""
        whole = [self.ranks.get(w, -1) for w in words]
        sizes = np.array([1 if r >= 0 else len(w) for w, r in zip(words, whole, strict=True)])
        data = np.frombuffer(b"".join(w if r < 0 else w[:1] for w, r in zip(words, whole, strict=True)), np.uint8)
        tok = self.bytes[data]
        first = np.cumsum(sizes) - sizes
        for i, r in enumerate(whole):
            if r >= 0:
                tok[first[i]] = r
        w = np.repeat(np.arange(len(words)), sizes)
        return pa.table({"w": w.astype(np.int32), "pos": np.arange(len(data)) - first[w], "tok": tok})

    def _encoded(self, words: list[bytes], long: bool) -> list[tuple[bytes, bytes]]:
        start_rows = self._rows(words)
        while True:
            ids = self.con.sql(LONG_SQL if long else SHORT_SQL).to_arrow_table()
            if not long or len(ids) == len(start_rows):
                break
            start_rows = ids
        found = self.con.sql(DECODE_SQL).to_arrow_table()
        return list(zip(found["ids"].to_pylist(), found["bytes"].to_pylist(), strict=True))

    def encode_words(self, words: list[bytes]) -> list[tuple[bytes, bytes]]:
        """(ids as decimal numbers with a comma after each, the bytes that they decode to) of each word; no word is empty."""
        out: list = [None] * len(words)
        beyond = [i for i, w in enumerate(words) if len(w) > LONG]
        for i, x in zip(beyond, self._joined([words[i] for i in beyond]) if beyond else (), strict=True):
            out[i] = x
        for long in (False, True):
            own = [i for i, w in enumerate(words) if out[i] is None and (len(w) > SHORT) == long]
            while own:
                size, n = 0, 0
                while n < len(own) and n < self.words_at_once and (not n or size + len(words[own[n]]) <= BYTES_AT_ONCE):
                    size, n = size + len(words[own[n]]), n + 1
                part = [words[i] for i in own[:n]]
                found = self._encoded(part, long)
                if [x[1] for x in found] != part:
                    found = self._encoded(part, True)
                for i, x in zip(own[:n], found, strict=True):
                    out[i] = x
                own = own[n:]
        return out

    def _joined(self, words: list[bytes]) -> list[tuple[bytes, bytes]]:
        """`encode_words` for long words, in time that grows with their length.

        A sequence of tokens is what its bytes are encoded to if that holds for each two neighbours: merges that happen elsewhere don't
        reach over a border that neither neighbour's merges want to cross. So the encodings of overlapping windows are joined at a border that
        both have, if the tokens on its sides are encoded to themselves. A word without such borders is encoded as a whole.
        """
        step = WINDOW // 2
        windows = [[w[k : k + WINDOW] for k in range(0, max(1, len(w) - step), step)] for w in words]
        distinct = list({x for part in windows for x in part})
        ids = {x: np.fromstring(held.decode(), np.int64, sep=",") for x, (held, _) in zip(distinct, self.encode_words(distinct), strict=True)}
        ends = {x: np.cumsum(self.sizes[i]) for x, i in ids.items()}
        tries, borders = {}, []
        for part in windows:
            mine = []
            for one, other in zip(part, part[1:], strict=False):
                # Borders as bytes of the second window, those in the middle of what both see first.
                both = np.intersect1d(ends[one] - step, ends[other])
                both = both[both > 0]
                options = []
                for p in both[np.argsort(np.abs(both - step // 2), kind="stable")][:8].tolist():
                    a, b = int(np.searchsorted(ends[one], p + step)), int(np.searchsorted(ends[other], p)) + 1
                    if b < len(ids[other]):
                        pair = (int(ids[one][a]), int(ids[other][b]))
                        tries[pair] = None
                        options.append((pair, a, b))
                mine.append(options)
            borders.append(mine)
        texts = [self.tokens[a] + self.tokens[b] for a, b in tries]
        distinct = list(set(texts))
        known = dict(zip(distinct, self.encode_words(distinct), strict=True))
        sound = {(a, b): known[self.tokens[a] + self.tokens[b]][0] == b"%d,%d," % (a, b) for a, b in tries}
        out = []
        for word, part, mine in zip(words, windows, borders, strict=True):
            begin, pieces = 0, []
            for x, options in zip(part, mine, strict=False):
                chosen = next(((a, b) for pair, a, b in options if sound[pair]), None)
                if chosen is None:
                    break
                pieces.append(ids[x][begin : chosen[0] + 1])
                begin = chosen[1]
            else:
                every = np.concatenate([*pieces, ids[part[-1]][begin:]]).tolist()
                back = b"".join(map(self.tokens.__getitem__, every))
                if back == word:
                    out.append((b"".join(b"%d," % i for i in every), back))
                    continue
            out.extend(self._encoded([word], True))
        return out

    @functools.cached_property
    def tokens(self) -> dict[int, bytes]:
        return {r: t for t, r in self.ranks.items()}

    @functools.cached_property
    def sizes(self) -> np.ndarray:
        out = np.zeros(max(self.tokens) + 1, np.int64)
        for r, t in self.tokens.items():
            out[r] = len(t)
        return out

    def _word(self, m: str) -> tuple | None:
        """What is kept of a word, by itself or as a piece that is nothing else."""
        spaced = m[:1] == " "
        p = m[1:] if spaced else m
        for known, pieces in ((self.known, self.pieces), self.older):
            x = pieces[spaced].get(p)
            if x is not None and x[2]:
                return x
            if m in known:
                return known[m]
        return None

    def learn(self, pieces: list[tuple[bool, str]]) -> None:
        """Encodes pieces that are not known: each match of the pattern by itself."""
        older = self.older[1]
        fresh = []
        for spaced, p in pieces:
            if p in older[spaced]:
                self.pieces[spaced][p] = older[spaced][p]
            else:
                fresh.append((spaced, p, self.pattern.findall(" " + p if spaced else p)))
        words = {m: self._word(m) for m in {m for *_, found in fresh for m in found}}
        new = [m for m, x in words.items() if x is None]
        words.update((m, (*x, True)) for m, x in zip(new, self.encode_words([m.encode() for m in new]), strict=True))
        for spaced, p, found in fresh:
            parts = [words[m] for m in found]
            one = parts[0] if len(parts) == 1 else (b"".join([x[0] for x in parts]), b"".join([x[1] for x in parts]), False)
            self.pieces[spaced][p] = one
        # Words that are pieces by themselves are not kept twice.
        later = self.pieces[1]
        self.known.update((m, words[m]) for *_, found in fresh if len(found) > 1 for m in found if m[1:] not in later or m[0] != " ")


@functools.lru_cache(1)
def pairs_of(path: str, pattern: str) -> BytePairs:
    return BytePairs(path, pattern)


_INNER = re.compile(r"(?<=\S) (?=\S)")
#: All white space but the space itself.
_BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


def release() -> None:
    """Gives back the database and all pieces."""
    pairs_of.cache_clear()
    gc.enable()
    gc.collect()


def odd_spaces(text: str) -> bool:
    """Whether a space stands at an end of a text or beside other white space."""
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return True
    return any(f" {c}" in text or f"{c} " in text for c in _BLANKS if c in text)


def pieces_of(text: str) -> list[str]:
    """Cuts a text at single spaces between other characters (the spaces go).

    No match of the pattern spans such a place, since a match with a space in front of visible characters begins with that space.
    """
    return _INNER.split(text) if odd_spaces(text) else text.split(" ")


def with_ids(docs: DataFrame, path: str, pattern: str, digests: bool = False, kept: int = PIECES_KEPT) -> DataFrame:
    """`docs` with `ids` (array<int>), `decoded` (binary) and `n_tokens` of each whole `text`; a null text is empty.

    With `digests`: n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 instead, which keeps rows small.
    The file at `path` must be on every executor. Repeated rows are encoded alike, no other column is looked at; an empty
    text has no ids. Memory is bounded by one document, its pieces, and `kept` pieces (about 0.5 KB each, two generations)
    that a worker holds on to: fewer need less memory and more time. A worker that is told to keep fewer than PIECES_KEPT also looks at
    less text at once, since each look adds all its new pieces, and gives all back after each partition.
    """
    at = docs.columns.index("text")

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        gc.disable()  # millions of small tuples and no cycles: collections would only walk them
        pairs = pairs_of(path, pattern)
        # A recursion holds the rows of all its steps: fewer words at once where memory is short.
        pairs.words_at_once = WORDS_AT_ONCE if kept >= PIECES_KEPT else WORDS_AT_ONCE // 8
        data, offsets = text_buffers(batch.column(at))
        count, ids, decoded = [], [], []
        for a, b in slices(offsets, TEXT_AT_ONCE if kept >= PIECES_KEPT else LESS_AT_ONCE):
            cut = [pieces_of(data[offsets[k] : offsets[k + 1]].tobytes().decode()) for k in range(a, b)]
            pairs.age(kept)
            first, later = pairs.pieces
            fresh = {(True, p) for pieces in cut for p in pieces[1:] if p not in later}
            fresh |= {(False, pieces[0]) for pieces in cut if pieces[0] not in first}
            pairs.learn(list(fresh))
            for pieces in cut:
                parts = [first[pieces[0]], *map(later.__getitem__, pieces[1:])]
                text = b"".join([x[0] for x in parts])[:-1]
                back = b"".join([x[1] for x in parts])
                count.append(text.count(b",") + bool(text))
                ids.append(hashlib.sha256(text).hexdigest() if digests else np.fromstring(text.decode(), np.int32, sep=",") if text else np.zeros(0, np.int32))
                decoded.append(hashlib.sha256(back).hexdigest() if digests else back)
        if digests:
            return [pa.array(count, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
        return [pa.array(count, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())]

    more = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "n_tokens long, ids array<int>, decoded binary"
    return with_columns(docs, more, work, rows=1024, done=gc.enable if kept >= PIECES_KEPT else release)
