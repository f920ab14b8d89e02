from __future__ import annotations

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from sluice.llm import tokens
from sluice.llm.common import scratch
from sluice.llm.packing import Packer, pack
from sluice.llm.token_files import (
    TokenFileReader,
    TokenFileWriter,
    arrow_uri,
    open_file,
    read_token_files,
    write_token_files,
)

from .cases import awkward, awkward_rows, nothing

BPE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(BPE)


def by_library(text: str, width: int = 2) -> bytes:
    return np.array(LIBRARY.encode(text, add_special_tokens=False).ids, f"<u{width}").tobytes()


ALPHABET = [" ", "  ", "\n", "\t", "a", "Ab", "é", "12", "!!", "日本", "\x1c", "'s", "<|endoftext|>", "\r\n", "😀", " "]


def texts(seed: int, n: int, longest: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("block", [20, 1_000_000])
def test_parts_give_the_ids_of_the_whole_text(monkeypatch, block):
    monkeypatch.setattr(tokens, "BLOCK", block)
    coder = tokens.Encoder(BPE)
    assert coder.by_parts
    some = texts(block, 2000, 40)
    assert coder.many(some) == [by_library(t, coder.width) for t in some]
    assert any("<|endoftext|>" in t for t in some)


def thue_morse(letters: str) -> str:
    """1,024 letters, which collide with those of the exchanged pair under polynomials modulo 2^64."""
    return "".join(letters[i.bit_count() % 2] for i in range(1024))


@pytest.mark.parametrize("block", [1500, 1_000_000])
def test_parts_of_one_hash_keep_their_ids(monkeypatch, block):
    monkeypatch.setattr(tokens, "BLOCK", block)
    one, two = thue_morse("ab"), thue_morse("ba")
    data = np.frombuffer(f"{one} {two}".encode(), np.uint8)
    keys = tokens.stretches(tokens.running(data, tokens.BYTES), np.array([0, 1025]), np.array([1024, 2049]))
    assert keys[0] == keys[1]
    coder = tokens.Encoder(BPE)
    some = [f"x {one} y {two} z", two, one, f"{two} {one}", f" {one}", f"a {two}"]
    assert coder.many(some) == [by_library(t, coder.width) for t in some]
    assert [coder.ids(t) for t in some] == [by_library(t, coder.width) for t in some]


def test_every_part_may_have_one_hash(monkeypatch):
    """The bytes decide, whatever the hash."""
    monkeypatch.setattr(tokens, "stretches", lambda sums, starts, ends: np.full(len(starts), 7, np.uint64))
    coder = tokens.Encoder(BPE)
    some = texts(3, 300, 20)
    assert coder.many(some) == [by_library(t, coder.width) for t in some]


def test_the_string_of_a_special_token_is_that_token():
    coder = tokens.Encoder(BPE)
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y <|endof text|>", "word " * 200_000 + "<|endoftext|>"):
        assert coder.ids(text) == by_library(text, coder.width)
    assert np.frombuffer(coder.ids("a <|endoftext|> b"), coder.dtype).tolist().count(50256) == 1


def test_the_table_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr(tokens, "PARTS", 10)
    coder = tokens.Encoder(BPE)
    some = [f"{i} some {i * i} words {i % 7}" for i in range(300)]
    for text in some:
        assert coder.ids(text) == coder.whole(text)
    assert coder.table.n <= 20


def test_other_tokenizers_encode_whole_texts():
    coder = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not coder.by_parts
    assert coder.ids("Some  Text") == coder.whole("Some  Text") != b""
    assert coder.ids(None) == b""


def plain_ids(text: str | None, end: int) -> np.ndarray:
    coder = tokens.encoder(BPE)
    own = np.frombuffer(coder.whole(text), coder.dtype) if text else np.zeros(0, coder.dtype)
    return np.append(own, end).astype("<u4")


@pytest.mark.parametrize("least_cut", [32, 5000])
def test_pack_keeps_every_id_once(spark, least_cut):
    docs = awkward(spark)
    rows = pack(docs, BPE, open_windows=2, least_cut=least_cut).collect()
    assert set(rows[0].asDict()) == {"doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"}
    sequences: dict[int, list] = {}
    pieces: dict[tuple, list] = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append(row)
        pieces.setdefault((row.doc_id, row.doc_tokens), []).append(row)
    for window in sequences.values():
        place = 0
        for row in sorted(window, key=lambda r: r.offset):
            assert row.offset == place and row.length == len(row.ids) // 4 > 0
            place += row.length
        assert place <= 1024
    wanted: dict[tuple, list[bytes]] = {}
    for doc, text, *_ in awkward_rows():
        ids = plain_ids(text, 0)
        wanted.setdefault((doc, len(ids)), []).append(ids.tobytes())
    assert set(pieces) == set(wanted)
    for key, parts in pieces.items():
        by_start: dict[int, list[bytes]] = {}
        for row in parts:
            by_start.setdefault(row.start, []).append(row.ids)
        whole = [b"".join(run) for run in zip(*(sorted(by_start[s]) for s in sorted(by_start)))]
        if len(wanted[key]) == 1:
            assert whole == wanted[key]
        assert sum(len(r.ids) for r in parts) == 4 * key[1] * len(wanted[key])
    assert pack(nothing(spark), BPE).count() == 0


def test_little_padding(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["word"] * rng.randint(1, 3000))) for i in range(400)]
    pieces = pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), BPE)
    used = [r.n for r in pieces.groupBy("sequence_id").agg({"length": "sum"}).toDF("s", "n").collect()]
    assert sum(used) > 0.99 * 1024 * len(used)


def test_packer_bounds_its_windows_and_prefers_the_best_fit():
    packer = Packer(10, 2, 100)
    assert list(packer.place(("a", 0, 6, 6, np.zeros(6)))) == []
    assert list(packer.place(("b", 0, 7, 7, np.zeros(7)))) == []
    out = list(packer.place(("c", 0, 3, 3, np.zeros(3))))
    assert [[p[0] for p in w] for w in out] == [["b", "c"]]
    assert list(packer.place(("d", 0, 8, 8, np.zeros(8)))) == []
    out = list(packer.place(("e", 0, 5, 5, np.zeros(5))))
    assert [[p[0] for p in w] for w in out] == [["d"]] and len(packer.used) == 2


def test_merge_over_several_levels(spark, monkeypatch):
    from sluice.llm import packing

    monkeypatch.setattr(packing, "FAN_IN", 2)
    docs = spark.range(40).selectExpr("id doc_id", "repeat('ab ', int(id)) text").repartition(9)
    pieces = pack(docs, BPE, size=64)
    got = {(r.doc_id, r.start): r.ids for r in pieces.collect()}
    for i in range(40):
        ids = plain_ids("ab " * i, 0)
        run, place = b"", 0
        while (i, place) in got:
            run += got[i, place]
            place = len(run) // 4
        assert run == ids.tobytes()
    used = [r.n for r in pieces.groupBy("sequence_id").agg({"length": "sum"}).toDF("s", "n").collect()]
    assert sum(1 for n in used if n < 64 - 32) <= 1


def test_files_round_trip(spark):
    files = write_token_files(awkward(spark), scratch(spark, "files"), BPE)
    rows = read_token_files(files).orderBy("start").collect()
    known = [(r, plain_ids(r[1], 2)) for r in awkward_rows()]
    assert len(rows) == len(known)
    place = 0
    for row in rows:
        assert row.start == place and row.n_tokens == len(row.ids) // 4
        place += row.n_tokens
    order = [r.doc_id for r in rows]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert sorted((r.doc_id or -1, r.ids) for r in rows) == sorted((k[0] or -1, ids.tobytes()) for k, ids in known)
    some = read_token_files(files, [9, 11, 99]).collect()
    assert sorted(r.doc_id for r in some) == [9, 9, 11]
    assert {r.start for r in some} <= {r.start for r in rows}
    empty = write_token_files(nothing(spark), scratch(spark, "files"), BPE)
    assert empty.count() == 0 and read_token_files(empty).count() == 0


def test_a_file_is_a_seekable_zstandard_file(tmp_path):
    path = str(tmp_path / "sub" / "x.zst")
    runs = [np.arange(n, dtype="<u2").tobytes() for n in (0, 5, 70_000 % 65_536)]
    writer = TokenFileWriter(open_file(path, "wb"), 2)
    for i, run in enumerate(runs):
        writer.add(None if i == 1 else i, run)
    writer.close()
    data = open(path, "rb").read()
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(runs)
    reader = TokenFileReader(io.BytesIO(data))
    assert [f.tobytes() for f in reader.frames()] == runs
    assert reader.frame(2).tobytes() == runs[2] and reader.known.tolist() == [True, False, True]
    at = int(reader.begin[2]) + int(reader.table[2, 0]) // 2
    broken = data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        TokenFileReader(io.BytesIO(broken)).frame(2)
    swapped = TokenFileReader(io.BytesIO(data))
    swapped.table = swapped.table.copy()
    swapped.table[2, 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        swapped.frame(2)
    with pytest.raises(ValueError, match="seek table"):
        TokenFileReader(io.BytesIO(data[:-1] + b"x"))


def test_crc_is_that_of_the_ids(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    row = pack(docs, BPE).select(F.crc32("ids").alias("c")).first()
    assert row.c == zlib.crc32(plain_ids("some words", 0).tobytes())


def test_uris_of_hadoop_clients_are_taken():
    assert arrow_uri("s3a://lake/ingest/x y") == "s3://lake/ingest/x y"
    assert arrow_uri("s3://lake/x") == "s3://lake/x" and arrow_uri("/a/b") == "/a/b"
