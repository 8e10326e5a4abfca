import gzip
import hashlib
import io
import random
import struct
import time
import zipfile
import zlib

from llm.helpers import empty, messy

from fieldlight.llm import media


def gif():
    return b"GIF89a\x01\x00\x01\x00\x80\x00\x00" + bytes(6) + b"\x2c" + bytes(8) + b"\x00\x02\x02D\x01\x00;"


def test_round_trip_and_validators():
    rng = random.Random(0)
    for n in (0, 1, 63, 64, 65, 5000):
        p = media.padded(rng.randbytes(n))
        assert len(p) % 64 == 0 and len(p) >= 64
        for f, kind in ((media.png(p), "image/png"), (media.wav(p), "audio/wav")):
            assert media.sniff(f) == [(0, len(f), kind)] and media.read_back(f, kind) == p
            assert media.sniff(f[:-1]) == []


def test_carving():
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("a.txt", "hello")
    parts = [(media.png(bytes(128)), "image/png"), (media.wav(bytes(64)), "audio/wav"), (gif(), "image/gif"), (gzip.compress(b"abc" * 99), "application/gzip"), (z.getvalue(), "application/zip"), (b"%PDF-1.4\nx\n%%EOF", "application/pdf"), (b"\xff\xd8\xff\xe0\x00\x04ab\xff\xda\x00\x02xyz\xff\xd9", "image/jpeg")]
    blob, want = b"junk BM RIFF GIF89a PK\x03\x04 %PDF-x ", []
    blob = blob.replace(b"PK\x03\x04", b"PK\x03")
    for data, kind in parts:
        want.append((len(blob), len(data), kind))
        blob += data + b" between "
    assert media.sniff(blob) == want
    outer = media.wav(media.padded(media.png(bytes(64))))
    assert media.sniff(outer) == [(0, len(outer), "audio/wav")]


def test_inspect(spark):
    png = media.png(media.padded(b"x" + media.wav(bytes(64))))
    df = spark.createDataFrame([(1, png, "audio/wav"), (2, png[:50], "image/png"), (3, None, None), (4, b"", "x"), (5, png + gif(), None)], "i int, media binary, declared string")
    out = {r.i: r for r in media.inspect(df).collect()}
    assert out[1].detected == "image/png" and out[1].corrected and [tuple(x) for x in out[1].carved] == [(1, len(media.wav(bytes(64))), "audio/wav", True)]
    assert [tuple(x) for x in out[5].carved] == [(1, len(media.wav(bytes(64))), "audio/wav", True), (len(png), len(gif()), "image/gif", False)]
    assert all(out[i].detected == media.UNKNOWN and out[i].payload is None and out[i].carved == [] for i in (2, 3, 4))


def chunks(*parts):
    return b"\x89PNG\r\n\x1a\n" + b"".join(media._chunk(k, x) for k, x in parts)


HEAD = struct.pack(">IIBBBBB", 64, 2, 8, 0, 0, 0, 0)
ROWS = b"".join(b"\0" + bytes(64) for _ in range(2))


def test_broken_images_are_no_images(spark):
    good = chunks((b"IHDR", HEAD), (b"IDAT", zlib.compress(ROWS)), (b"IEND", b""))
    assert media.read_back(good, "image/png") == bytes(128)
    huge = struct.pack(">IIBBBBB", 1 << 30, 1 << 30, 8, 0, 0, 0, 0)
    bad = [
        chunks((b"IHDR", HEAD), (b"IEND", b"")), chunks((b"IHDR", HEAD), (b"IDAT", b"no deflate"), (b"IEND", b"")), chunks((b"IHDR", HEAD[:8]), (b"IDAT", zlib.compress(ROWS)), (b"IEND", b"")),
        chunks((b"IHDR", HEAD), (b"IDAT", zlib.compress(ROWS)[:-3]), (b"IEND", b"")), chunks((b"IHDR", HEAD), (b"IDAT", zlib.compress(ROWS + b"x")), (b"IEND", b"")), chunks((b"IHDR", huge), (b"IDAT", zlib.compress(ROWS)), (b"IEND", b"")),
        chunks((b"IHDR", HEAD), (b"IDAT", zlib.compress(bytes(1 << 26))), (b"IEND", b"")), chunks((b"IDAT", zlib.compress(ROWS)), (b"IHDR", HEAD), (b"IEND", b"")),
    ]
    assert all(media.sniff(x) == [] and media.read_back(x, "image/png") is None for x in bad)
    laced = chunks((b"IHDR", HEAD[:-1] + b"\1"), (b"IDAT", zlib.compress(ROWS)), (b"IEND", b""))
    assert media.sniff(laced) == [(0, len(laced), "image/png")] and media.read_back(laced, "image/png") is None
    df = spark.createDataFrame([(i, x, None) for i, x in enumerate([*bad, laced])], "i int, media binary, declared string")
    out = media.inspect(df).orderBy("i").collect()
    assert [r.detected for r in out] == [media.UNKNOWN] * len(bad) + ["image/png"] and all(r.payload is None for r in out)


def test_many_magic_bytes_cost_little():
    for piece in (b"PK\x03\x04PK\x05\x06", b"%PDF-1", b"\x1f\x8b\x08\0\0\0\0\0\0\0", b"\xff\xd8\xff\xda\0\2", struct.pack(">I4s", 8, b"ftyp"), b"OggS\0\2" + bytes(21), b"II*\0\x08\0\0\0", b"MM\0*"):
        blob, start = piece * 8000, time.perf_counter()
        media.sniff(blob)
        assert time.perf_counter() - start < 1.5, piece
    n, head = 16_000, struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)
    header = struct.pack(">I", 13) + b"IHDR" + head + struct.pack(">I", zlib.crc32(b"IHDR" + head))
    nested = b"".join(b"\x89PNG\r\n\x1a\n" + header + struct.pack(">I", (n - k - 1) * 41) + b"IDAT" for k in range(n)) + b"abcd"
    for blob in (b"\xff\xd8\xff\xe0\0\4" * n, b"\xff\xd8\xff\xe0\0\4" * n + b"\xff\xda\0\2", nested):
        start = time.perf_counter()
        media.sniff(blob)
        assert time.perf_counter() - start < 1.5, blob[:4]


def test_checksums_from_running_ones(monkeypatch):
    monkeypatch.setattr(media, "DIRECT", 100)
    monkeypatch.setattr(media, "RUNNING", 64)
    rng = random.Random(8)
    b = rng.randbytes(5000)
    places = media.Places(b)
    for _ in range(300):
        i, j = sorted((rng.randrange(5001), rng.randrange(5001)))
        assert places.checksum(i, j) == zlib.crc32(b[i:j])


def test_jpeg_starts_that_share_segments():
    inner = b"\xff\xd8" + b"\xff\xe0\0\4ab" + b"\xff\xda\0\2" + b"data\xff\xd9"
    outer = b"\xff\xd8" + b"\xff\xe1" + struct.pack(">H", 2 + len(inner)) + inner + b"\xff\xda\0\2more\xff\xd9"
    assert media.sniff(outer + b"--" + inner) == [(0, len(outer), "image/jpeg"), (len(outer) + 2, len(inner), "image/jpeg")]
    broken = b"\xff\xd8\xff\xe0\0\1" + inner
    assert media.sniff(broken) == [(6, len(inner), "image/jpeg")]


def test_containers():
    box = lambda kind, body=b"": struct.pack(">I4s", 8 + len(body), kind) + body
    page = lambda flags, body: b"OggS\0" + bytes([flags]) + bytes(20) + b"\1" + bytes([len(body)]) + body
    movie = box(b"ftyp", b"isom\0\0\2\0") + box(b"moov", b"x" * 9) + box(b"mdat", b"data")
    sound = page(2, b"head") + page(0, b"abc") + page(4, b"end")
    tiff = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 2) + struct.pack("<HHII", 273, 4, 1, 50) + struct.pack("<HHII", 279, 4, 1, 10) + bytes(4) + bytes(12) + b"0123456789"
    avi = b"RIFF" + struct.pack("<I", 4 + 8 + 4) + b"AVI " + b"LIST" + struct.pack("<I", 4) + b"hdrl"
    for data, kind in ((movie, "video/mp4"), (sound, "audio/ogg"), (tiff, "image/tiff"), (avi, "video/x-msvideo")):
        assert media.sniff(data) == [(0, len(data), kind)] and media.sniff(b"junk" + data + b"----more") == [(4, len(data), kind)]
        assert media.sniff(data[: len(data) // 2]) == []
    flac = b"fLaC" + b"\0\0\0\x22" + bytes(34) + b"\x81\0\0\x02xx" + b"frames"
    assert media.sniff(flac) == [(0, len(flac), "audio/flac")] and media.sniff(flac[:20]) == []


def test_odd_columns(spark):
    df = spark.createDataFrame([(1, "abc", (2, 3), 4, 5)], "doc_id long, text string, s struct<`a b`:int,c:int>, media int, payload int")
    r = media.inspect(media.store(df)).first()
    assert r.s["a b"] == 2 and bytes(r.payload) == media.padded(b"abc") and bytes(r.media[:4]) in (b"RIFF", b"\x89PNG")


def test_messy(spark):
    df = messy(spark)
    out = media.inspect(media.store(df)).collect()
    assert len(out) == df.count() and media.inspect(media.store(empty(spark))).collect() == []
    for r in out:
        raw = (r.text or "").encode()
        assert r.n_bytes == len(raw) and bytes(r.payload) == media.padded(raw) and r.corrected == (r.detected == "image/png") and r.key in (7, None)
    assert len({r.detected for r in out}) == 2


def test_query(spark, sf_dir):
    text = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in media.op6_media(spark, sf_dir).collect():
        p = media.padded(text[r.doc_id])
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
