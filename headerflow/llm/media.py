"""Media columns: signature sniffing.

An Aho-Corasick automaton finds the magic bytes of all known formats in one pass. A validator of each format confirms its
structure and gives its length, so a chance match is no hit. The hit at byte 0 corrects the declared type; confirmed hits
further on are carved as embedded media.

Null content: type application/octet-stream, nothing embedded. Long content is scanned whole.
"""

import hashlib
import struct
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, as_bytes, bounded_batches, table

RATE = 8000
UNKNOWN = "application/octet-stream"


def _u(b: bytes, at: int, kind: str) -> int:
    return struct.unpack_from(kind, b, at)[0]


def _wav(b: bytes, at: int) -> int:
    """RIFF chunks inside the stated size, a fmt chunk before a data chunk."""
    if at + 12 > len(b) or b[at + 8 : at + 12] != b"WAVE":
        return 0
    end, p, seen = at + 8 + _u(b, at + 4, "<I"), at + 12, False
    if end > len(b):
        return 0
    while p + 8 <= end:
        name, size = b[p : p + 4], _u(b, p + 4, "<I")
        if p + 8 + size > end:
            return 0
        if name == b"data":
            return end - at if seen else 0
        seen |= name == b"fmt " and size >= 16
        p += 8 + size + size % 2
    return 0


def _png(b: bytes, at: int) -> int:
    """Chunks with right checksums from IHDR to IEND."""
    p, first = at + 8, True
    while p + 12 <= len(b):
        size = _u(b, p, ">I")
        body = b[p + 4 : p + 8 + size]
        if p + 12 + size > len(b) or zlib.crc32(body) != _u(b, p + 8 + size, ">I") or (first and body[:4] != b"IHDR"):
            return 0
        p, first = p + 12 + size, False
        if body[:4] == b"IEND":
            return p - at
    return 0


def _gif(b: bytes, at: int) -> int:
    """Screen, extension and image blocks up to the trailer."""
    if at + 13 > len(b):
        return 0
    flags = b[at + 10]
    p = at + 13 + (3 << ((flags & 7) + 1) if flags & 128 else 0)
    while p < len(b):
        kind = b[p]
        if kind == 0x3B:
            return p + 1 - at
        if kind == 0x21:
            p += 2
        elif kind == 0x2C and p + 10 <= len(b):
            f = b[p + 9]
            p += 10 + (3 << ((f & 7) + 1) if f & 128 else 0) + 1
        else:
            return 0
        while p < len(b) and b[p]:
            p += b[p] + 1
        p += 1
    return 0


def _jpeg(b: bytes, at: int) -> int:
    """Marker segments up to the scan, then the end marker."""
    p = at + 2
    while p + 4 <= len(b) and b[p] == 0xFF and 0xC0 <= b[p + 1] <= 0xFE:
        if b[p + 1] == 0xDA:
            end = b.find(b"\xff\xd9", p + 4)
            return end + 2 - at if end > 0 else 0
        p += 2 + _u(b, p + 2, ">H")
    return 0


def _bmp(b: bytes, at: int) -> int:
    if at + 30 > len(b):
        return 0
    size, zero, start, head = struct.unpack_from("<IIII", b, at + 2)
    return size if not zero and head in (12, 40, 108, 124) and 14 + head <= start <= size <= len(b) - at and _u(b, at + 26, "<H") == 1 else 0


def _pdf(b: bytes, at: int) -> int:
    end = b.find(b"%%EOF", at)
    return end + 5 - at if end > 0 and b.find(b"startxref", at, end) > 0 else 0


def _gzip(b: bytes, at: int) -> int:
    d = zlib.decompressobj(31)
    try:
        for p in range(at, len(b), 65536):
            d.decompress(b[p : p + 65536])
            if d.eof:
                return min(p + 65536, len(b)) - at - len(d.unused_data)
    except zlib.error:
        pass
    return 0


def _zip(b: bytes, at: int) -> int:
    end = b.find(b"PK\x05\x06", at)
    return end + 22 + _u(b, end + 20, "<H") - at if 0 < end <= len(b) - 22 and _u(b, end + 10, "<H") and end + 22 + _u(b, end + 20, "<H") <= len(b) else 0


#: Magic bytes, type and validator (bytes, start) -> length or 0.
FORMATS = [
    (b"RIFF", "audio/wav", _wav),
    (b"\x89PNG\r\n\x1a\n", "image/png", _png),
    (b"GIF87a", "image/gif", _gif),
    (b"GIF89a", "image/gif", _gif),
    (b"\xff\xd8\xff", "image/jpeg", _jpeg),
    (b"BM", "image/bmp", _bmp),
    (b"%PDF-", "application/pdf", _pdf),
    (b"\x1f\x8b\x08", "application/gzip", _gzip),
    (b"PK\x03\x04", "application/zip", _zip),
]
_automaton = None


def automaton():
    global _automaton
    if _automaton is None:
        _automaton = ahocorasick.Automaton()
        for i, (magic, _, _) in enumerate(FORMATS):
            _automaton.add_word(magic.decode("latin-1"), i)
        _automaton.make_automaton()
    return _automaton


def sniff(content: bytes) -> list[tuple[int, int, str]]:
    """(start, length, type) of each confirmed format; a hit inside the file at byte 0 counts as embedded in it."""
    out, free = [], 0
    for end, i in automaton().iter(content.decode("latin-1")):
        magic, kind, valid = FORMATS[i]
        at = end + 1 - len(magic)
        if at >= free and (n := valid(content, at)):
            out.append((at, n, kind))
            free = at + n if at else free
    return out


def wav(samples: bytes) -> bytes:
    """One channel of unsigned 8-bit samples."""
    return b"RIFF" + struct.pack("<I", 36 + len(samples)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(samples)) + samples


def wav_samples(b: bytes) -> bytes:
    p = 12
    while p + 8 <= len(b):
        name, size = b[p : p + 4], _u(b, p + 4, "<I")
        if name == b"data":
            return b[p + 8 : p + 8 + size]
        p += 8 + size + size % 2
    raise ValueError("no data chunk")


def payload(text: bytes) -> bytes:
    return text + bytes(max(64, -(-len(text) // 64) * 64) - len(text))


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, declared type, media: each text's payload as a WAV file under a type that says nothing of it."""

    def run(batches):
        for b in batches:
            texts = as_bytes(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([UNKNOWN] * len(texts)), pa.array([wav(payload(t)) for t in texts], pa.binary())], ["doc_id", "n_bytes", "declared", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, declared string, media binary")


def annotate(media: DataFrame) -> DataFrame:
    """Corrects declared types and lists embedded media: adds type, corrected, embedded (array of start, length, type)."""
    fields = [x for x in media.columns if x not in ("type", "corrected", "embedded")]

    def run(batches):
        for b in batches:
            found = [sniff(x) for x in as_bytes(b.column("media"))]
            types = [next((k for at, _, k in f if at == 0), UNKNOWN) for f in found]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("type", pa.string())]))
            inner = pa.array([[dict(start=a, length=n, type=k) for a, n, k in f if a] for f in found], kind)
            declared = b.column("declared").to_pylist()
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in fields), pa.array(types), pa.array([d != t for d, t in zip(declared, types, strict=True)]), inner], [*fields, "type", "corrected", "embedded"])

    return media.select(fields).mapInArrow(run, media.select(fields).schema.simpleString()[7:-1] + ",type:string,corrected:boolean,embedded:array<struct<start:bigint,length:bigint,type:string>>")


def _digest(batches):
    for b in batches:
        cols = [[] for _ in range(6)]
        for x, kind, inner in zip(as_bytes(b.column("media")), b.column("type").to_pylist(), b.column("embedded").to_pylist(), strict=True):
            p = wav_samples(x)
            v = np.frombuffer(p, np.uint8)
            feature = f"{kind};{_u(x, 24, '<I')}Hz;{_u(x, 34, '<H')}bit;n={len(p)};peak={int(v.max())};zeros={int((v == 0).sum())};sum={int(v.sum(dtype=np.int64))};embedded=" + ",".join(f"{e['type']}@{e['start']}+{e['length']}" for e in inner)
            for c, y in zip(cols, (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(x), hashlib.sha256(x).hexdigest(), feature), strict=True):
                c.append(y)
        names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), *(pa.array(c, pa.string() if isinstance(c[0] if c else 0, str) or n in ("payload_sha256", "media_sha256", "feature") else pa.int64()) for n, c in zip(names, cols, strict=True))], ["doc_id", "n_bytes", *names])


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    stored = Scratch(spark, "op8").keep(store(table(spark, sf_dir, "documents").withColumn("text", F.col("text"))), "media")
    return annotate(stored).mapInArrow(_digest, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
