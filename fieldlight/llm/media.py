"""Media columns by signature sniffing.

One Aho-Corasick automaton finds the magic bytes of all known formats in one pass over a file. A
format's validator then reads its structure (headers, chunk lengths, checksums, a PNG's packed data) and says
how long the file is, so that a chance occurrence of magic bytes is no file. The format at offset 0 corrects the
declared type; valid files further inside are carved out, outermost first. Known are PNG, JPEG, GIF, BMP, TIFF, WebP;
WAV, FLAC, Ogg; AVI, MP4 and QuickTime; gzip, ZIP and PDF (see FORMATS).

`store` keeps bytes losslessly as media: as samples of a WAV file (8-bit PCM, mono) or as pixels of a
PNG (8-bit grey, 64 wide), which of the two by the checksum of the bytes. `read_back` takes them out
of the stored file, by what the sniffer found, not by what was declared.

Cases: a null or empty text is one block of 64 zero bytes; equal texts give equal files; a null,
empty, truncated or broken file is application/octet-stream with nothing carved at its beginning; a null declared type
counts as wrong; repeated rows are alike; an empty table gives no row; a text of any length is stored whole; columns by
the names that are added are replaced, all others are kept as they are. Markers and chains are
searched once per file, so work is about linear in its bytes; only a gzip member that fails late is read in vain.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlight.llm.common import documents, slices, with_fields

BLOCK = 64
UNKNOWN = "application/octet-stream"
RATE = 8000


def padded(raw: bytes) -> bytes:
    """Zero bytes up to a positive multiple of BLOCK."""
    return raw + bytes(-len(raw) % BLOCK or (0 if raw else BLOCK))


def wav(samples: bytes) -> bytes:
    even = samples + bytes(len(samples) % 2)
    body = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(samples)) + even
    return b"RIFF" + struct.pack("<I", len(body)) + body


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png(pixels: bytes, width: int = BLOCK) -> bytes:
    rows = b"".join(b"\0" + pixels[i : i + width] for i in range(0, len(pixels), width))
    header = struct.pack(">IIBBBBB", width, len(pixels) // width, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(rows, 1)) + _chunk(b"IEND", b"")


#: Bytes between running checksums; chunks of more than so many take theirs from two of those.
RUNNING, DIRECT = 1 << 12, 1 << 16
_ALL = 0xFFFFFFFF


@lru_cache(64)
def _zeros(k: int) -> tuple[int, ...]:
    """What becomes of each bit of a checksum's register over 2 ** k zero bytes; all else follows from these, as the checksum is linear."""
    if not k:
        return tuple(zlib.crc32(b"\0", 1 << bit ^ _ALL) ^ _ALL for bit in range(32))
    half = _zeros(k - 1)
    return tuple(_through(half, x) for x in half)


def _through(images: tuple[int, ...], register: int) -> int:
    out = 0
    for bit in range(register.bit_length()):
        if register >> bit & 1:
            out ^= images[bit]
    return out


class Places:
    """Where markers stand in a file, found once per file, so that many magic bytes do not search it again and again."""

    def __init__(self, b: bytes):
        self.b, self.found, self.zips = b, {}, None
        #: Where chains of pages or boxes lead to no file, so that none is walked twice.
        self.vain: set[int] = set()
        #: Of a chain's segments, where the file ends to which they lead, or -1.
        self.segments: dict[int, int] = {}
        self.sums: list[int] = []

    def checksum(self, i: int, j: int) -> int:
        """crc32 of the bytes from i to j. Long ones come from running checksums, so that nested chunks do not read the file again and again."""
        if j - i <= DIRECT:
            return zlib.crc32(memoryview(self.b)[i:j])
        if not self.sums:
            self.sums = [0]
            for at in range(0, len(self.b), RUNNING):
                self.sums.append(zlib.crc32(memoryview(self.b)[at : at + RUNNING], self.sums[-1]))
        before, upto = (zlib.crc32(memoryview(self.b)[k - k % RUNNING : k], self.sums[k // RUNNING]) for k in (i, j))
        for k in range((j - i).bit_length()):
            if j - i >> k & 1:
                before = _through(_zeros(k), before)
        return before ^ upto

    def of(self, marker: bytes) -> list[int]:
        if marker not in self.found:
            self.found[marker] = [m.start() for m in re.finditer(re.escape(marker), self.b)]
        return self.found[marker]

    def next(self, marker: bytes, at: int) -> int:
        """The first place from `at` on, or -1."""
        known = self.of(marker)
        i = bisect_left(known, at)
        return known[i] if i < len(known) else -1

    def zip_ends(self) -> dict[int, int]:
        """Where the archives begin that end in the file, by their end records, and where each ends. Of several that
        begin alike the first counts."""
        if self.zips is None:
            self.zips = {}
            for end in self.of(b"PK\x05\x06"):
                if end + 22 <= len(self.b):
                    size, start, note = struct.unpack_from("<IIH", self.b, end + 12)
                    if end + 22 + note <= len(self.b):
                        self.zips.setdefault(end - size - start, end + 22 + note)
        return self.zips


# Validators: the length of the valid file that begins at `at`, or 0. They never read past the end.


def _png_rows(header: tuple[int, ...], packed: list[bytes]) -> bytes | None:
    """The unpacked rows of an image, or None if they are not exactly what the header says; no more is unpacked."""
    width, height, depth, colour, method, filters, laced = header
    samples = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(colour)
    if not samples or not width or not height or depth not in (1, 2, 4, 8, 16) or method or filters or laced > 1:
        return None
    size = height * (1 + -(-width * samples * depth // 8))
    if size > 1100 * sum(map(len, packed)) + 64:  # more than deflate can hold
        return None
    most = size + 8 * height + 64 if laced else size  # seven reduced images, whose rows are more and filled up each
    d, out, held = zlib.decompressobj(), [], 0
    try:
        for part in packed:
            while part and not d.eof:
                piece = d.decompress(part, 1 << 20)
                part, held = d.unconsumed_tail, held + len(piece)
                if held > most:
                    return None
                out.append(piece)
    except zlib.error:
        return None
    return b"".join(out) if d.eof and (laced or held == size) else None


def _png_parts(b: bytes, at: int, places: Places) -> tuple[int, tuple[int, ...], list[bytes]] | None:
    """(length, header, packed data) of a PNG with sound chunks."""
    i, header, packed = at + 8, None, []
    while i + 12 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, i)
        end = i + 12 + n
        if end > len(b) or (header is None) != (kind == b"IHDR") or places.checksum(i + 4, end - 4) != struct.unpack_from(">I", b, end - 4)[0]:
            return None
        if kind == b"IHDR":
            if n != 13:
                return None
            header = struct.unpack_from(">IIBBBBB", b, i + 8)
        elif kind == b"IDAT":
            packed.append(b[i + 8 : end - 4])
        elif kind == b"IEND":
            return end - at, header, packed
        i = end
    return None


def _png_end(b: bytes, at: int, places: Places) -> int:
    parts = _png_parts(b, at, places)
    return parts[0] if parts and _png_rows(*parts[1:]) is not None else 0


def _riff_end(form: bytes, first: bytes) -> Validator:
    def end(b: bytes, at: int, places: Places) -> int:
        if at + 20 > len(b) or b[at + 8 : at + 12] != form or not b[at + 12 : at + 16].startswith(first):
            return 0
        n = struct.unpack_from("<I", b, at + 4)[0] + 8
        if n < 20 or at + n > len(b):
            return 0
        i = at + 12
        while i + 8 <= at + n:
            size = struct.unpack_from("<I", b, i + 4)[0]
            i += 8 + size + size % 2
        return n if i == at + n else 0

    return end


def _gif_end(b: bytes, at: int, places: Places) -> int:
    if at + 13 > len(b):
        return 0
    i = at + 13 + (3 << (b[at + 10] & 7) + 1 if b[at + 10] & 0x80 else 0)
    while i < len(b):
        if b[i] == 0x3B:
            return i + 1 - at
        if b[i] == 0x21:
            i += 2
        elif b[i] == 0x2C and i + 10 <= len(b):
            i += 10 + (3 << (b[i + 9] & 7) + 1 if b[i + 9] & 0x80 else 0) + 1
        else:
            return 0
        while i < len(b) and b[i]:
            i += b[i] + 1
        i += 1
    return 0


def _jpeg_end(b: bytes, at: int, places: Places) -> int:
    """Segments, one after another, up to the entropy-coded data and the end marker behind it. A segment is walked once, whatever
    starts lead to it."""
    i, seen, end = at + 2, [], -1
    while i + 4 <= len(b) and b[i] == 0xFF and i not in places.segments:
        kind, n = b[i + 1], struct.unpack_from(">H", b, i + 2)[0]
        seen.append(i)
        if n < 2:
            break
        i += 2 + n
        if kind == 0xDA:
            last = places.next(b"\xff\xd9", i)
            end = last + 2 if last >= 0 else -1
            break
    else:
        end = places.segments.get(i, -1)
    places.segments.update(dict.fromkeys(seen, end))
    return end - at if end >= 0 else 0


def _bmp_end(b: bytes, at: int, places: Places) -> int:
    if at + 54 > len(b):
        return 0
    size, zero, start, header = struct.unpack_from("<IIII", b, at + 2)
    planes, bits = struct.unpack_from("<HH", b, at + 26)
    good = zero == 0 and header in (40, 108, 124) and planes == 1 and bits in (1, 4, 8, 16, 24, 32) and 54 <= start <= size
    return size if good and at + size <= len(b) else 0


def _gzip_end(b: bytes, at: int, places: Places) -> int:
    """Members are unpacked in pieces of bounded size, which are not kept. What fails is not looked at again: a failing
    member's bytes are read up to the fault only."""
    if at + 18 > len(b) or b[at + 3] & 0xE0:
        return 0
    d, i = zlib.decompressobj(31), at
    try:
        while i < len(b) and not d.eof:
            piece = b[i : i + 65536]
            i += len(piece)
            while piece and not d.eof:
                d.decompress(piece, 1 << 20)
                piece = d.unconsumed_tail
        return i - len(d.unused_data) - at if d.eof else 0
    except zlib.error:
        return 0


def _zip_end(b: bytes, at: int, places: Places) -> int:
    return places.zip_ends().get(at, at) - at


def _pdf_end(b: bytes, at: int, places: Places) -> int:
    """Up to the last end mark before the next file's beginning."""
    if not b[at + 5 : at + 6].isdigit():
        return 0
    following, ends = places.next(b"%PDF-", at + 5), places.of(b"%%EOF")
    i = bisect_left(ends, following) if following >= 0 else len(ends)
    return ends[i - 1] + 5 - at if i and ends[i - 1] > at else 0


def _flac_end(b: bytes, at: int, places: Places) -> int:
    """Sound metadata blocks with a stream description; the frames have no length, so the file takes what is left."""
    i, first = at + 4, True
    while i + 4 <= len(b):
        kind, n = b[i] & 0x7F, int.from_bytes(b[i + 1 : i + 4], "big")
        if first and (kind, n) != (0, 34) or kind == 127 or i + 4 + n > len(b):
            return 0
        last, i, first = b[i] & 0x80, i + 4 + n, False
        if last:
            return len(b) - at
    return 0


def _ogg_end(b: bytes, at: int, places: Places) -> int:
    """Pages, one after another, from one that begins a stream to one that ends it."""
    i, ended, seen = at, False, []
    while i + 27 <= len(b) and i not in places.vain and b[i : i + 5] == b"OggS\0" and not (i == at and not b[i + 5] & 2):
        seen.append(i)
        n = b[i + 26]
        end = i + 27 + n + sum(b[i + 27 : i + 27 + n])
        if end > len(b):
            ended = False
            break
        ended, i = bool(b[i + 5] & 4), end
    if not ended:
        places.vain.update(seen)
    return i - at if ended else 0


def _mp4_end(b: bytes, at: int, places: Places) -> int:
    """Boxes, one after another, from the file type on; the movie box must be among them."""
    i, kinds, seen = at, set(), []
    while i + 8 <= len(b) and i not in places.vain:
        n, kind = struct.unpack_from(">I4s", b, i)
        if n == 1 and i + 16 <= len(b):
            n = struct.unpack_from(">Q", b, i + 8)[0]
        if kind not in _BOXES or n < 8 or i + n > len(b):
            break
        kinds.add(kind)
        seen.append(i)
        i += n
    if b"moov" not in kinds:
        places.vain.update(seen)
        return 0
    return i - at


def _tiff_end(order: str) -> Validator:
    def end(b: bytes, at: int, places: Places) -> int:
        """Directories of entries; the file reaches as far as its entries', strips' and tiles' data."""
        if at + 8 > len(b):
            return 0
        i, far, seen = struct.unpack_from(order + "I", b, at + 4)[0], 8, set()
        while i:
            if i in seen or i < 8 or at + i + 6 > len(b):
                return 0
            seen.add(i)
            n = struct.unpack_from(order + "H", b, at + i)[0]
            if not n or at + i + 6 + 12 * n > len(b):
                return 0
            values: dict[int, list[int]] = {}
            for k in range(n):
                tag, kind, count, value = struct.unpack_from(order + "HHII", b, at + i + 2 + 12 * k)
                size = (0, 1, 1, 2, 4, 8, 1, 1, 2, 4, 8, 4, 8)[kind] if kind < 13 else 0
                if not size:
                    return 0
                inside = size * count <= 4
                where = i + 10 + 12 * k if inside else value
                if at + where + size * count > len(b):
                    return 0
                far = max(far, where + size * count)
                if tag in (273, 279, 324, 325) and kind in (3, 4):
                    values[tag] = list(struct.unpack_from(f"{order}{count}{'H' if kind == 3 else 'I'}", b, at + where))
            for starts, sizes in ((273, 279), (324, 325)):
                far = max([far, *(x + y for x, y in zip(values.get(starts, ()), values.get(sizes, ()), strict=False))])
            far = max(far, i + 6 + 12 * n)
            i = struct.unpack_from(order + "I", b, at + i + 2 + 12 * n)[0]
        return far if seen and at + far <= len(b) else 0

    return end


Validator = Callable[[bytes, int, Places], int]
#: Boxes at the top of a movie file (fixed values of the public format).
_BOXES = {b"ftyp", b"moov", b"mdat", b"free", b"skip", b"wide", b"uuid", b"moof", b"mfra", b"sidx", b"styp", b"meta", b"pdin"}
#: Magic bytes, where they stand in a file, its type and validator (fixed values of the public formats).
FORMATS: tuple[tuple[bytes, int, str, Validator], ...] = (
    (b"\x89PNG\r\n\x1a\n", 0, "image/png", _png_end),
    (b"RIFF", 0, "audio/wav", _riff_end(b"WAVE", b"fmt ")),
    (b"RIFF", 0, "image/webp", _riff_end(b"WEBP", b"VP8")),
    (b"RIFF", 0, "video/x-msvideo", _riff_end(b"AVI ", b"LIST")),
    (b"GIF87a", 0, "image/gif", _gif_end),
    (b"GIF89a", 0, "image/gif", _gif_end),
    (b"\xff\xd8\xff", 0, "image/jpeg", _jpeg_end),
    (b"BM", 0, "image/bmp", _bmp_end),
    (b"II*\0", 0, "image/tiff", _tiff_end("<")),
    (b"MM\0*", 0, "image/tiff", _tiff_end(">")),
    (b"fLaC", 0, "audio/flac", _flac_end),
    (b"OggS", 0, "audio/ogg", _ogg_end),
    (b"ftyp", 4, "video/mp4", _mp4_end),
    (b"\x1f\x8b\x08", 0, "application/gzip", _gzip_end),
    (b"PK\x03\x04", 0, "application/zip", _zip_end),
    (b"%PDF-", 0, "application/pdf", _pdf_end),
)

_automaton = None


def _magic() -> ahocorasick.Automaton:
    global _automaton
    if _automaton is None:
        _automaton = ahocorasick.Automaton()
        by_magic: dict[str, list] = {}
        for magic, before, kind, end in FORMATS:
            by_magic.setdefault(magic.decode("latin-1"), []).append((len(magic) + before, kind, end))
        for key, known in by_magic.items():
            _automaton.add_word(key, known)
        _automaton.make_automaton()
    return _automaton


def sniff(b: bytes) -> list[tuple[int, int, str]]:
    """(offset, length, type) of all valid files in b, outermost first: what lies inside another is left out."""
    found, over, places = [], 0, Places(b)
    hits = [(end + 1 - n, kind, check) for end, known in _magic().iter(b.decode("latin-1")) for n, kind, check in known]
    for at, kind, check in sorted(hits, key=lambda x: x[0]):
        if at >= over and (length := check(b, at, places)):
            found.append((at, length, kind))
            over = at + length
    return found


def read_back(b: bytes, kind: str) -> bytes | None:
    """The samples of a stored file, or None if it holds none that are stored here (WAV data; PNGs of 8-bit grey
    without lacing and filters), or is broken."""
    if kind == "audio/wav":
        i = 12
        while i + 8 <= len(b):
            n = struct.unpack_from("<I", b, i + 4)[0]
            if b[i : i + 4] == b"data":
                return b[i + 8 : i + 8 + n] if i + 8 + n <= len(b) else None
            i += 8 + n + n % 2
    if kind == "image/png" and (parts := _png_parts(b, 0, Places(b))):
        _, header, packed = parts
        rows = _png_rows(header, packed) if header[2:] == (8, 0, 0, 0, 0) else None
        if rows and not any(rows[:: header[0] + 1]):
            return b"".join(rows[j + 1 : j + 1 + header[0]] for j in range(0, len(rows), header[0] + 1))
    return None


def store(docs: DataFrame, column: str = "text") -> DataFrame:
    """All columns of docs, with n_bytes, media (the stored file) and declared (its type as its maker
    says, which is wrong for every PNG: writers that know one format only are common). Columns of docs by these names
    are replaced."""
    docs = docs.drop("n_bytes", "media", "declared").withColumn("_raw", F.col(column).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_raw", 8 << 20):
            raw = [x or b"" for x in batch.column("_raw").to_pylist()]
            files = [png(p) if zlib.crc32(p) & 1 else wav(p) for p in map(padded, raw)]
            keep = [i for i, name in enumerate(batch.schema.names) if name != "_raw"]
            arrays = [*(batch.column(i) for i in keep), pa.array([len(x) for x in raw], pa.int64()), pa.array(files, pa.binary()), pa.array(["audio/wav"] * len(raw))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*(batch.schema.names[i] for i in keep), "n_bytes", "media", "declared"])

    return docs.mapInArrow(run, with_fields(docs.drop("_raw"), "n_bytes long, media binary, declared string"))


def inspect(files: DataFrame) -> DataFrame:
    """files: has media and declared. Adds detected, corrected (declared was wrong), file_bytes (the length of
    the file at offset 0, or 0), carved (array of (offset, length, type, inside): files behind the first, by their offset
    in the file; and those inside its payload, marked as such, by their offset there) and payload (what read_back gives).
    Columns of files by these names are replaced."""
    files = files.drop("detected", "corrected", "file_bytes", "carved", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string()), ("inside", pa.bool_())]))
        for batch in slices(batches, "media", 8 << 20):
            detected, corrected, length, carved, payload = [], [], [], [], []
            for b, said in zip(batch.column("media").to_pylist(), batch.column("declared").to_pylist(), strict=True):
                b = b or b""
                found = [(*x, False) for x in sniff(b)]
                outer = found.pop(0) if found and found[0][0] == 0 else (0, 0, UNKNOWN, False)
                inside = read_back(b, outer[2])
                if inside is not None:
                    found = [(*x, True) for x in sniff(inside)] + found
                detected.append(outer[2])
                corrected.append(said != outer[2])
                length.append(outer[1])
                carved.append([{"offset": o, "length": n, "type": k, "inside": i} for o, n, k, i in found])
                payload.append(inside)
            arrays = [pa.array(detected, pa.string()), pa.array(corrected, pa.bool_()), pa.array(length, pa.int64()), pa.array(carved, kind), pa.array(payload, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, "detected", "corrected", "file_bytes", "carved", "payload"])

    return files.mapInArrow(run, with_fields(files, "detected string, corrected boolean, file_bytes long, carved array<struct<offset:long,length:long,type:string,inside:boolean>>, payload binary"))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = inspect(store(documents(spark, sf_dir).select("doc_id", "text")).drop("text"))
    n = F.octet_length("payload")
    shown = F.array_join(F.transform("carved", lambda x: F.concat_ws(":", x["type"], F.when(x["inside"], "payload").otherwise("file"), x["offset"], x["length"])), ",")
    return seen.select(
        "doc_id", "n_bytes", n.cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.expr("substring(payload, -64, 64)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(";", "detected", "file_bytes", F.when(F.col("corrected"), "corrected").otherwise("as declared"), shown).alias("feature"),
    )
