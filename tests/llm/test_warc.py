import hashlib
import io
import random
from collections import defaultdict

import pyarrow as pa

from spindex.llm import warc_salvage as W
from spindex.llm.common import filesystem, shared_path


def made(n=12, gz=True):
    out = []
    for i in range(n):
        body = (f"<p>{i}</p>".encode() + bytes([13, 10, 13, 10]) + b"WARC/1.1 " + b"\x1f\x8b\x08") * (i + 1)
        data = W.record(i, f"http://h/{i} x", body, hashlib.sha256(body).hexdigest(), "response", None)
        out.append((W.member(data) if gz else data, body))
    return out


def bodies(data):
    found = list(W.salvage(io.BytesIO(data)))
    assert [f[0] for f in found] == [0, *(f[1] for f in found[:-1])] and found[-1][1] == len(data)  # all bytes accounted for
    return [b for _, _, h, b, _ in found if h], [(s, e, g) for s, e, h, _, g in found if not h]


def test_sound_files():
    for gz in (True, False):
        recs = made(gz=gz)
        got, gaps = bodies(b"".join(r for r, _ in recs))
        assert got == [b for _, b in recs] and gaps == []
    assert list(W.salvage(io.BytesIO(b""))) == []


def test_damage_loses_only_what_it_hits():
    rng = random.Random(8)
    for gz in (True, False):
        recs = made(gz=gz)
        starts = [sum(len(r) for r, _ in recs[:k]) for k in range(len(recs) + 1)]
        whole = b"".join(r for r, _ in recs)
        for _ in range(60):
            k, kind = rng.randrange(len(recs)), rng.randrange(4)
            a, b = starts[k], starts[k + 1]
            at = rng.randrange(a, b)
            if kind == 0:    # bytes overwritten
                data = whole[:at] + bytes(x ^ 0x5A for x in whole[at:min(b, at + 5)]) + whole[min(b, at + 5):]
            elif kind == 1:  # bytes missing
                data = whole[:at] + whole[min(b, at + 1 + rng.randrange(20)):]
            elif kind == 2:  # rubbish between records
                data = whole[:a] + rng.randbytes(30) + b"\x1f\x8b\x08 WARC/1." + whole[a:]
            else:            # cut short
                data = whole[:at]
            got, gaps = bodies(data)
            want = [x for i, (_, x) in enumerate(recs) if (kind == 2 or i != k) and (kind != 3 or i < k)]
            # a plain record may survive where its header's optional fields are hit
            assert [x for x in got if x in want] == want
            assert all(x in [y for _, y in recs] for x in got)
            assert len(got) == len(recs) or gaps or at in starts


def test_gaps_larger_than_the_window():
    recs, noise = made(3), b"\x1f\x8b" * W.PIECE + b"WARC/1"
    got, gaps = bodies(recs[0][0] + noise + recs[1][0] + recs[2][0])
    assert got == [b for _, b in recs] and [(e - s) for s, e, _ in gaps] == [len(noise)]


class Asked(io.BytesIO):
    """Remembers the largest read and how far the file was read."""
    most = 0

    def read(self, n=-1):
        assert n >= 0
        self.most = max(self.most, n)
        return super().read(n)


def test_lengths_that_cannot_be(tmp_path):
    recs = made(4, gz=False)
    length = f"Content-Length: {len(recs[1][1])}".encode()
    tail = recs[2][0] + recs[3][0]
    for wrong in (b"99999999999999", b"1" + b"0" * 25, b"9" * 5_000, "\u00b2".encode(), "\u0663".encode(), b"-1", b"", b"300000"):
        data = recs[0][0] + recs[1][0].replace(length, b"Content-Length: " + wrong) + tail
        for size in (len(data), None):
            file = Asked(data)
            found = list(W.salvage(file, size))
            assert [b for _, _, h, b, _ in found if h] == [recs[i][1] for i in (0, 2, 3)]
            assert sum(h is None for _, _, h, _, _ in found) == 1 and found[-1][1] == len(data)
            assert file.most <= W.PIECE
        if wrong == b"1" + b"0" * 25:
            (tmp_path / "x.warc").write_bytes(data)
    path = pa.RecordBatch.from_pydict({"path": [str(tmp_path / "x.warc")]})
    rows = [r for b in W.read_files(iter([path])) for r in b.to_pylist()]
    assert [r["payload"] for r in rows if r["gap"] is None] == [recs[i][1] for i in (0, 2, 3)]
    # leading zeros are a length
    data = recs[0][0] + recs[1][0].replace(length, b"Content-Length: " + b"0" * 5_000 + length[16:]) + tail
    assert bodies(data) == ([b for _, b in recs], [])


def test_a_length_beyond_the_file_does_not_read_the_rest():
    first, second = (W.record(i, None, b"text", hashlib.sha256(b"text").hexdigest(), "response", None) for i in (1, 2))
    data = first.replace(b"Content-Length: 4", b"Content-Length: 99999999") + second + b"x" * (8 * W.PIECE)
    file = Asked(data)
    found = W.salvage(file, len(data))
    assert next(found)[:2] == (0, len(first) + 7) and next(found)[3] == b"text" and file.tell() <= 2 * W.PIECE


def test_a_record_of_many_pieces():
    body = bytes(range(256)) * (4 * W.PIECE // 256) + b"end"
    data = W.record(1, None, body, hashlib.sha256(body).hexdigest(), "response", None)
    assert bodies(data + made(1, gz=False)[0][0])[0] == [body, made(1, gz=False)[0][1]]


def pages_by_hand(rows):
    groups = defaultdict(list)
    for i, h in rows:
        groups[(h or "").encode()].append(i)
    out = []
    for body, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        for i in ids:
            again = len(body) >= 100 and i != first
            out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
                        first if again else None))
    return sorted(out, key=str)


def check(spark, pages, most):
    manifest = W.write_archives(pages, shared_path(spark, "warc"), most=most)
    records = W.read_archives(spark, manifest)
    assert records.where("gap is not null").count() == 0
    got = sorted((tuple(r) for r in W.resolved(records).collect()), key=str)
    assert got == pages_by_hand([(r.page_id, r.html) for r in pages.collect()])
    return manifest


def test_pages_round_trip(spark):
    big = "<html>" + "é" * 200
    rows = [(3, "u 3", big, "d"), (1, None, big, "d"), (2, "u", big, None), (None, "u", big, "x"), (4, "u", None, "x"),
            (5, "u", "", "x"), (6, "u", "short", "x"), (7, "u", "short", "x"), (8, "u\r\nX: y", "a" * 100, "x"),
            (9, "u", "a" * 100, "x"), (9, "u", "a" * 100, "x"), (None, None, "b" * 300, None), (-1, "u", "a" * 99, "x")]
    odd = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    check(spark, odd.repartition(3), 100)  # 100: a file a record
    check(spark, odd.limit(0), W.FILE_BYTES)
    manifest = check(spark, spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), 20_000)
    # a damaged archive gives its other records, and the gap
    path = manifest.first().path
    fs, name = filesystem(path)
    with fs.open_input_file(name) as f:
        data = bytearray(f.read())
    data[len(data) // 2] ^= 0xFF
    with fs.open_output_stream(name, compression=None) as f:
        f.write(bytes(data))
    found = W.read_archives(spark, manifest).where(f"path = '{path}'").collect()
    assert sum(r.gap is not None for r in found) == 1
    assert sum(r.gap is None for r in found) == manifest.first().records - 1


def test_a_damaged_archive_is_an_error(spark, tmp_path):
    import glob

    import pytest
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    manifest = W.write_archives(pages, str(tmp_path / "own"))
    assert W.resolved(W.read_archives(spark, manifest), manifest).count() == pages.count()
    path = max(glob.glob(str(tmp_path / "own" / "**" / "*.gz"), recursive=True))
    raw = bytearray(open(path, "rb").read())
    raw[len(raw) // 2] ^= 0xFF
    with open(path, "wb") as f:
        f.write(raw)
    with pytest.raises(RuntimeError, match="records could be read; gaps"):
        W.resolved(W.read_archives(spark, manifest), manifest)
