"""Operator 9: media columns in ISO media containers.

``build`` stores a payload as samples of one track in an ISO base media file: boxes ``ftyp``,
``moov`` (with the sample tables) and ``mdat``. ``walk`` goes through nested boxes of any such
file; ``describe`` decodes the sample tables and gives codec, duration and the byte ranges of
keyframes without looking at the payload; ``samples`` gives every sample's byte range.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadsift.llm.common import map_batches

#: Bytes to which payloads are padded, bytes of a sample, samples from one keyframe to the next, ticks a second.
UNIT, SAMPLE, KEY_EVERY, TIMESCALE = 64, 1024, 8, 8000
#: Boxes that hold boxes.
CONTAINERS = frozenset((b"moov", b"trak", b"edts", b"mdia", b"minf", b"dinf", b"stbl", b"mvex", b"moof", b"traf", b"udta"))


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def pad(data: bytes) -> bytes:
    """Bytes 0 appended up to a positive multiple of UNIT."""
    return data + bytes(-len(data) % UNIT if data else UNIT)


def build(payload: bytes) -> bytes:
    """A file whose one track holds the payload as unsigned 8-bit mono sound, SAMPLE bytes a sample."""
    n, last = -(-len(payload) // SAMPLE), len(payload) % SAMPLE or SAMPLE
    units = len(payload)
    runs = [(n - 1, SAMPLE), (1, last)] if n > 1 and last != SAMPLE else [(n, last)]
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    ftyp = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isom", b"mp41")

    def moov(offset: int) -> bytes:
        entry = box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, TIMESCALE << 16))
        tables = (
            full(b"stsd", struct.pack(">I", 1), entry),
            full(b"stts", struct.pack(">I", len(runs)), *(struct.pack(">II", *r) for r in runs)),
            full(b"stss", struct.pack(">I", -(-n // KEY_EVERY)), *(struct.pack(">I", k) for k in range(1, n + 1, KEY_EVERY))),
            full(b"stsc", struct.pack(">IIII", 1, 1, n, 1)),
            full(b"stsz", struct.pack(">II", 0, n), *(struct.pack(">I", SAMPLE) for _ in range(n - 1)), struct.pack(">I", last)),
            full(b"co64", struct.pack(">IQ", 1, offset)),
        )
        dinf = box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1)))
        minf = box(b"minf", full(b"smhd", bytes(4)), dinf, box(b"stbl", *tables))
        mdhd = full(b"mdhd", struct.pack(">QQIQHH", 0, 0, TIMESCALE, units, 0x55C4, 0), version=1)
        hdlr = full(b"hdlr", bytes(4), b"soun", bytes(12), b"sound\0")
        tkhd = full(b"tkhd", struct.pack(">QQIIQ", 0, 0, 1, 0, units), bytes(8), struct.pack(">HHHH", 0, 0, 0x100, 0), matrix, bytes(8), version=1, flags=3)
        mvhd = full(b"mvhd", struct.pack(">QQIQ", 0, 0, TIMESCALE, units), struct.pack(">IH", 0x10000, 0x100), bytes(10), matrix, bytes(24), struct.pack(">I", 2), version=1)
        return box(b"moov", mvhd, box(b"trak", tkhd, box(b"mdia", mdhd, hdlr, minf)))

    head = ftyp + moov(0)
    mdat = box(b"mdat", payload)
    return ftyp + moov(len(head) + len(mdat) - len(payload)) + mdat


def walk(data: bytes, start: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path of kinds, first byte of the body, end) of every box, outer before inner."""
    end = len(data) if end is None else end
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            (size,), head = struct.unpack_from(">Q", data, start + 8), 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise ValueError(f"box {kind!r} at {start} has a wrong size")
        yield (*path, kind), start + head, start + size
        if kind in CONTAINERS:
            yield from walk(data, start + head, start + size, (*path, kind))
        start += size


def tracks(data: bytes) -> list[dict[bytes, tuple[int, int]]]:
    """For each track, the body range of each kind of box in it."""
    out: list[dict[bytes, tuple[int, int]]] = []
    for path, a, b in walk(data):
        if path[-1] == b"trak":
            out.append({})
        elif b"trak" in path:
            out[-1].setdefault(path[-1], (a, b))
    return out


def _column(data: bytes, at: int, form: str) -> list[tuple]:
    """The entries of a counted table."""
    (n,) = struct.unpack_from(">I", data, at + 4)
    return list(struct.iter_unpack(form, data[at + 8 : at + 8 + n * struct.calcsize(form)]))


def samples(data: bytes, track: dict[bytes, tuple[int, int]]) -> list[tuple[int, int]]:
    """(first byte, end) of each sample in the file, from stsz, stsc and stco or co64."""
    at = track[b"stsz"][0]
    same, n = struct.unpack_from(">II", data, at + 4)
    sizes = [same] * n if same else [x for (x,) in struct.iter_unpack(">I", data[at + 12 : at + 12 + 4 * n])]
    chunks = [x for (x,) in (_column(data, track[b"co64"][0], ">Q") if b"co64" in track else _column(data, track[b"stco"][0], ">I"))]
    runs = _column(data, track[b"stsc"][0], ">III")
    out: list[tuple[int, int]] = []
    for k, (first, per, _) in enumerate(runs):
        until = runs[k + 1][0] if k + 1 < len(runs) else len(chunks) + 1
        for at in chunks[first - 1 : until - 1]:
            ends = list(accumulate(sizes[len(out) : len(out) + per], initial=at))
            out += zip(ends, ends[1:], strict=False)
    return out


def describe(data: bytes) -> dict:
    """Codec, timescale, duration in ticks, number of samples and keyframe byte ranges of the first track."""
    track = tracks(data)[0]
    at = track[b"mdhd"][0]
    if data[at]:
        timescale, _ = struct.unpack_from(">IQ", data, at + 20)
    else:
        timescale, _ = struct.unpack_from(">II", data, at + 12)
    ranges = samples(data, track)
    duration = sum(n * ticks for n, ticks in _column(data, track[b"stts"][0], ">II"))
    keys = [k for (k,) in _column(data, track[b"stss"][0], ">I")] if b"stss" in track else range(1, len(ranges) + 1)
    codec = data[track[b"stsd"][0] + 12 : track[b"stsd"][0] + 16].decode("latin-1").strip()
    return {"codec": codec, "timescale": timescale, "duration": duration, "samples": len(ranges), "keyframes": [ranges[k - 1] for k in keys]}


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store each whole text as a media file and describe it from the stored bytes.

    Returns doc_id, n_bytes, media (binary), payload (binary, read back by the sample tables),
    codec, timescale, duration, n_samples and keyframes (array of first byte and end). Null text
    counts as empty; an empty one is stored as 64 bytes 0. Rows are kept one for one, null and
    repeated ids included; other columns are left out. An empty table gives an empty result.
    """
    spans = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    names = ["doc_id", "n_bytes", "media", "payload", "codec", "timescale", "duration", "n_samples", "keyframes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [(t or "").encode() for t in batch.column(1).to_pylist()]
            media = [build(pad(x)) for x in raw]
            payload = [b"".join(m[a:b] for a, b in samples(m, tracks(m)[0])) for m in media]
            told = [describe(m) for m in media]
            keys = [[{"first": a, "end": b} for a, b in d["keyframes"]] for d in told]
            columns = [
                batch.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary()), pa.array(payload, pa.binary()),
                pa.array([d["codec"] for d in told], pa.string()), *(pa.array([d[k] for d in told], pa.int64()) for k in ("timescale", "duration", "samples")), pa.array(keys, spans),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(source, run, "doc_id long, n_bytes long, media binary, payload binary, codec string, timescale long, duration long, n_samples long, keyframes array<struct<first: long, end: long>>")


def media_digests(docs: DataFrame) -> DataFrame:
    """The figures of media_column() that a reader compares."""
    m = media_column(docs)
    ranges = F.array_join(F.transform("keyframes", lambda k: F.concat_ws("-", k["first"].cast("string"), k["end"].cast("string"))), ",")
    return m.select(
        "doc_id", "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -UNIT, UNIT)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(";", F.concat(F.lit("codec="), "codec"), F.concat(F.lit("duration="), F.col("duration").cast("string"), F.lit("/"), F.col("timescale").cast("string")),
                    F.concat(F.lit("samples="), F.col("n_samples").cast("string")), F.concat(F.lit("keyframes="), ranges)).alias("feature"),
    )
