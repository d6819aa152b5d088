import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from runtide.llm import repair
from runtide.llm.repair import Shard, compress, pack, read_shards, token_files, tokenizer_of, write_shards
from runtide.llm.shared import read_table
from tests.conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(11)
    zipf = np.minimum(rng.zipf(1.3, 60_000), 50_000).astype(np.uint32)
    for ids in (zipf, np.zeros(10_001, np.uint32), np.tile(zipf[:97], 300), zipf[:1], zipf + np.uint32(70_000), np.repeat(zipf[:5000], 3)):
        ends = np.unique(np.append(rng.integers(1, len(ids) + 1, 20), len(ids)))
        shard = Shard(pack(ids, ends))
        assert (shard.expand(shard.seq) == ids).all() and (shard.ends == ends).all()
        for a, b in [(0, len(ids)), (0, 0), *(sorted(rng.integers(0, len(ids) + 1, 2).tolist()) for _ in range(50))]:
            assert (shard.ids(a, b) == ids[a:b]).all()
        assert (shard.document(len(ends) - 1) == ids[(ends[-2] if len(ends) > 1 else 0) :]).all()
    assert len(compress(np.tile(zipf[:97], 300))[2]) < 2000
    assert len(compress(np.zeros(1 << 15, np.uint32))[2]) < 64


def test_pairs_of_one_slot_are_told_apart(monkeypatch):
    rng = np.random.default_rng(12)
    for ids in (rng.zipf(1.3, 5_000).astype(np.uint32) % 900, rng.zipf(1.3, 5_000).astype(np.uint32) % 90 + np.uint32(70_000)):
        base, rules, seq = compress(ids)
        with monkeypatch.context() as m:
            m.setattr(repair, "_slots", lambda key: np.zeros(len(key), np.uint32))
            again = compress(ids)
        assert again[0] == base and (again[1] == rules).all() and (again[2] == seq).all() and len(rules)


INNER = Tokenizer.from_file(PATH)  # as it is


def library(texts):
    return [e.ids for e in INNER.encode_batch(texts, add_special_tokens=False)]


def test_pieces_as_the_library():
    texts = ["", " ", "a b", "a  b\n\n c ", " lead", "it's  é ñ日本 x", "x" * 5000, "don't <|endoftext|> stop", "x <|endoftext|> y", "a<|endoftext|><|endoftext|>b  c", "<|endoftext|", "12 345  6 !! ??", "a b   c"]
    texts += [" ".join(f"w{i}é" for i in range(3000))]
    got = tokenizer_of(PATH).encode(texts)
    assert [g.tolist() for g in got] == library(texts)


def test_pieces_cut_at_any_white_space_and_sign():
    rng = np.random.default_rng(13)
    parts = [*" \n\t\r\x1c'.,!<>|19sé×ſßа日́ª²", "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u2028", "\u3000", "\u200b", "\u201d", "  ", "'s", "'ll", "the", "Ing"]
    texts = ["".join(rng.choice(rng.choice(parts, 6), rng.integers(0, 20))) for _ in range(3000)]
    assert [g.tolist() for g in tokenizer_of(PATH).encode(texts)] == library(texts)


def test_library_sees_a_word_once_whatever_stands_around_it(monkeypatch):
    words = ["".join(chr(97 + (k * 7 + j * j) % 26) for j in range(8)) + chr(97 + k) for k in range(20)]
    texts = [f"x {a}{sign}{b}, y" for a in words for b in words for sign in (".\n", ";\n", "!\n")]
    tokenizer, seen = repair.PieceTokenizer(PATH), []
    inner = tokenizer._encode
    monkeypatch.setattr(tokenizer, "_encode", lambda texts: seen.extend(texts) or inner(texts))
    assert [g.tolist() for g in tokenizer.encode(texts)] == library(texts)
    assert sum(map(len, seen)) < 1000 < sum(map(len, texts))
    seen.clear()
    assert [g.tolist() for g in tokenizer.encode(texts[::-1])] == library(texts[::-1]) and not seen


def test_forgotten_pieces_are_encoded_again(monkeypatch):
    texts = [" ".join(f"w{(i * k) % 97}{'z' * (i % 5 * 30)}" for i in range(k)) for k in range(1, 60)]
    for kept, ratio in ((10, 16), (1, 16), (1000, 0)):
        monkeypatch.setattr(repair, "PIECES_KEPT", kept)
        monkeypatch.setattr(repair, "KNOWN_A_PIECE", ratio)
        tokenizer = repair.PieceTokenizer(PATH)
        for some in (texts[:20], texts[10:], texts[:5], [], ["", " "], texts):
            assert [g.tolist() for g in tokenizer.encode(some)] == library(some)
            assert len(tokenizer.known) <= kept and max(map(len, tokenizer.known.to_pylist()), default=0) <= repair.LONGEST_KEPT


def test_all_ids_of_a_shard():
    rng = np.random.default_rng(14)
    zipf = np.minimum(rng.zipf(1.3, 60_000), 50_000).astype(np.uint32)
    for ids in (zipf, np.zeros(10_001, np.uint32), zipf[:1], zipf + np.uint32(70_000), np.repeat(zipf[:5000], 3), np.repeat(zipf[:9000] % 5, rng.integers(1, 9, 9000))):
        assert (Shard(pack(ids, np.array([len(ids)]))).all_ids() == ids).all()


def test_digests_alone(spark, folder):
    docs = spark.createDataFrame([(3, "one two"), (1, None), (2, "x <|endoftext|> y"), (2, "one\ttwo ")], "doc_id long, text string")
    write_shards(docs, f"{folder}/y", PATH, partitions=2)
    every, less = (read_shards(spark.read.parquet(f"{folder}/y"), with_ids=b) for b in (True, False))
    assert less.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, less.collect())) == sorted(tuple(r)[:4] for r in every.collect()) and less.count() == 4


def test_files_hold_all_documents_in_order(spark, folder):
    docs = read_table(spark, SF, "documents").select("doc_id", "text").limit(300)
    odd = spark.createDataFrame([(-1, None), (-1, ""), (10**9, "tie"), (10**9, "tie"), (10**9 + 1, "end <|endoftext|> of text"), (None, "no id")], "doc_id long, text string")
    every = docs.union(odd).repartition(5).selectExpr("*", "1 as part", "2 as start")
    write_shards(every, f"{folder}/x", PATH, partitions=4)
    rows = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in read_shards(spark.read.parquet(f"{folder}/x")).collect())
    want = sorted(((r["doc_id"], r["text"] or "") for r in every.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    assert [r[1] for r in rows] == [w[0] for w in want]
    texts = {}
    for k, t in want:
        texts.setdefault(k, []).append(np.array([*library([t])[0], 0], "<u4").tobytes())
    for start, k, n, crc, ids in rows:
        assert start == at and len(ids) == 4 * n and zlib.crc32(ids) == crc
        texts[k].remove(ids)
        at += n
    assert token_files(docs.limit(0), PATH).count() == 0
