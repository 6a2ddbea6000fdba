import functools
import random
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from spindex.llm import binary_packing as B
from spindex.llm import bitplane as P
from spindex.llm.common import shared_path
from spindex.llm.token_ids import encoder


library = functools.cache(Tokenizer.from_file)


def plain(path, text):
    return library(path).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_library(vocabulary):
    rng = random.Random(1)
    parts = ["word", "Wörter,", "it's", "I'll", " ", "  ", "\n", "\t", "\r\n", " ", " ", "\x1c", "\x85", "日本", "é", "é",
             "123", "½", "...", "—", "'s", "<|endoftext|>", "\U0001f600", "_", "a_b", "«x»", "\x00", "ß.", "ʼn", "x" * 100]
    enc = encoder(vocabulary)
    for _ in range(800):
        text = "".join(rng.choice(parts) + rng.choice(["", " ", "\n", "  "]) for _ in range(rng.randrange(12)))
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == plain(vocabulary, text), repr(text)


def test_binary_lengths():
    for n in range(1, 5000):
        got = B.binary_lengths(n)
        assert sum(got) == n and all(x & (x - 1) == 0 and x <= 1024 for x in got)
        assert sorted(got, reverse=True) == got and sum(x < 1024 for x in got) == bin(n % 1024).count("1")


def check_packing(docs, vocabulary):
    pieces = B.pack(docs, vocabulary).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    assert all(p.offset == 0 and p.length == 1 << p.bucket and len(p.ids) == 4 * p.length for p in pieces)
    by_length = sorted(pieces, key=lambda p: p.sequence_id)
    assert [p.length for p in by_length] == sorted((p.length for p in pieces), reverse=True)
    want = sorted(((r.doc_id is None, r.doc_id or 0), tuple(plain(vocabulary, r.text) + [0])) for r in docs.collect())
    got, rest = [], sorted(pieces, key=lambda p: (p.sequence_id & ((1 << 56) - 1)))
    i = 0
    while i < len(rest):  # pieces of a document stand together in the order of their numbers
        parts = [rest[i]]
        while parts[-1].start + parts[-1].length < parts[0].doc_tokens:
            i += 1
            parts.append(rest[i])
        i += 1
        assert [p.start for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
        ids = np.frombuffer(b"".join(p.ids for p in parts), "<u4").tolist()
        assert len(ids) == parts[0].doc_tokens and len({p.doc_id for p in parts}) == 1
        got.append(((parts[0].doc_id is None, parts[0].doc_id or 0), tuple(ids)))
    assert sorted(got) == want


def test_packing_round_trip(small_docs, odd_docs, vocabulary):
    check_packing(small_docs, vocabulary)
    check_packing(odd_docs, vocabulary)


def test_packing_digests(small_docs, no_docs, vocabulary):
    want = {(r.doc_id, r.start): crc(np.frombuffer(r.ids, "<u4")) for r in B.pack(small_docs, vocabulary).collect()}
    got = {(r.doc_id, r.start): r.ids_crc32 for r in B.digests(B.pack(small_docs, vocabulary)).collect()}
    assert got == want
    assert B.digests(B.pack(no_docs, vocabulary)).collect() == []


def test_planes_are_inverse():
    rng = np.random.default_rng(3)
    for unit in ("byte", "bit"):
        for n in (0, 1, 7, 8, 1000, P.BLOCK):
            for most in (1, 2, 50_000, 1 << 32):
                ids = rng.integers(0, most, n).astype("<u4")
                planes = P.to_planes(ids, unit)
                assert len(planes) == (4 if unit == "byte" else 32)
                assert (P.from_planes(planes, n, unit) == ids).all()
                assert most > 1 or not any(planes)


def test_file_blocks_and_damage(tmp_path):
    docs = [(i, np.arange(n, dtype="<u4").tobytes()) for i, n in ((5, 3), (None, 200_000), (7, 0), (8, 70_000))]
    for unit in ("byte", "bit"):
        name = tmp_path / f"{unit}.bpl"
        with name.open("wb") as f:
            w = P.Writer(f, unit, 3)
            for d in docs:
                w.add(*d)
            assert w.close() == f.tell()
        with pa.OSFile(str(name)) as f:
            r = P.Reader(f, f.size())
            assert list(r.documents()) == docs
            assert [len(r.block(k)) for k in (4, 0)] == [270_003 - 4 * P.BLOCK, P.BLOCK]
        data = bytearray(name.read_bytes())
        data[-30] ^= 1
        name.write_bytes(data)
        try:
            with pa.OSFile(str(name)) as f:
                P.Reader(f, f.size())
            raise AssertionError("a damaged footer was read")
        except ValueError:
            pass


def check_planes(spark, docs, vocabulary, unit):
    manifest = P.write_planes(docs, shared_path(spark, "planes"), vocabulary, 2, unit)
    got = P.digests(P.read_planes(spark, manifest)).collect()
    assert sorted(map(str, got)) == sorted(map(str, P.read_planes(spark, manifest, sums=True).collect()))
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(plain(vocabulary, r.text) + [2])
    assert sorted(len(x) for v in want.values() for x in v) == sorted(r.n_tokens for r in got)
    rows = sorted(got, key=lambda r: r.start)
    assert [r.start for r in rows] == [sum(q.n_tokens for q in rows[:k]) for k in range(len(rows))]
    order = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert order == sorted(order)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids_crc32) for r in rows) == sorted(
        (i is None, i or 0, crc(x)) for i, v in want.items() for x in v)


def test_planes_round_trip(spark, small_docs, odd_docs, no_docs, vocabulary):
    check_planes(spark, small_docs, vocabulary, "byte")
    check_planes(spark, odd_docs, vocabulary, "bit")
    check_planes(spark, no_docs, vocabulary, "byte")
