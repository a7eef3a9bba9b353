"""Matroska: a muxer for 8-bit samples and a parser of EBML elements, clusters, lacing and cues into packet tables.

Element ids and layouts follow the public specifications (RFC 8794, RFC 9559).
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import tidy, written

# fixed values: element ids
EBML, VERSION, READ_VERSION, MAX_ID, MAX_SIZE, DOC_TYPE, DOC_VERSION, DOC_READ = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, SCALE, DURATION, MUXER, WRITER = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK, NUMBER, UID, KIND, LACING, CODEC, AUDIO, RATE, CHANNELS, DEPTH = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIME, SIMPLE, GROUP, BLOCK, BLOCK_DURATION = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0x9B
CUES, CUE, CUE_TIME, CUE_PLACES, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
VOID, CRC = 0xEC, 0xBF
MASTERS = {EBML, SEGMENT, INFO, TRACKS, TRACK, AUDIO, CLUSTER, GROUP, CUES, CUE, CUE_PLACES}
#: what may follow a segment or cluster of unknown size
TOP = {EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES}

FRAME, LACED, BLOCKS, RATE_HZ = 1024, 8, 16, 8000


def vint(value: int, width: int = 0) -> bytes:
    """A size as a variable-length integer (the shortest without width)."""
    width = width or next(w for w in range(1, 9) if value < (1 << 7 * w) - 1)
    return ((1 << 7 * width) | value).to_bytes(width, "big")


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def number(ident: int, value: int) -> bytes:
    return element(ident, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


_HEAD = element(EBML, number(VERSION, 1) + number(READ_VERSION, 1) + number(MAX_ID, 4) + number(MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + number(DOC_VERSION, 4) + number(DOC_READ, 2))
_TRACKS = element(TRACKS, element(TRACK, number(NUMBER, 1) + number(UID, 1) + number(KIND, 2) + number(LACING, 1) + element(CODEC, b"A_PCM/INT/LIT") + element(AUDIO, element(RATE, struct.pack(">d", RATE_HZ)) + number(CHANNELS, 1) + number(DEPTH, 8))))


def _laced(frames: list[bytes], when: int) -> bytes:
    """A SimpleBlock of track 1: one frame, frames of one size (fixed lacing) or of any sizes (EBML lacing)."""
    sizes = [len(f) for f in frames]
    if len(frames) == 1:
        flags, sizing = 0x80, b""
    elif len(set(sizes)) == 1:
        flags, sizing = 0x84, bytes([len(frames) - 1])
    else:
        flags, parts = 0x86, [bytes([len(frames) - 1]), vint(sizes[0])]
        for a, b in zip(sizes, sizes[1:-1]):
            width = next(w for w in range(1, 9) if abs(b - a) < (1 << 7 * w - 1) - 1)
            parts.append(vint(b - a + (1 << 7 * width - 1) - 1, width))
        sizing = b"".join(parts)
    return element(SIMPLE, b"\x81" + struct.pack(">hB", when, flags) + sizing + b"".join(frames))


def mux(payload: bytes, frame: int = FRAME) -> bytes:
    """payload as a track of 8-bit mono samples; times are in milliseconds at 8000 samples a second."""
    frames = [payload[k : k + frame] for k in range(0, len(payload), frame)]
    info = element(INFO, number(SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(payload) * 1000 / RATE_HZ)) + element(MUXER, b"methlake") + element(WRITER, b"methlake"))
    clusters, cues, at = [], [], len(info) + len(_TRACKS)
    for c in range(0, len(frames), LACED * BLOCKS):
        begin = c * frame * 1000 // RATE_HZ
        body = number(TIME, begin)
        for b in range(c, min(len(frames), c + LACED * BLOCKS), LACED):
            body += _laced(frames[b : b + LACED], b * frame * 1000 // RATE_HZ - begin)
        cues.append(element(CUE, number(CUE_TIME, begin) + element(CUE_PLACES, number(CUE_TRACK, 1) + number(CUE_CLUSTER, at))))
        clusters.append(element(CLUSTER, body))
        at += len(clusters[-1])
    return _HEAD + element(SEGMENT, info + _TRACKS + b"".join(clusters) + element(CUES, b"".join(cues)))


class Broken(ValueError):
    """The bytes are no Matroska file, or end too early."""


def read_vint(data: bytes, at: int, keep: bool = False) -> tuple[int | None, int]:
    """(value, next place); with keep the marker stays (ids). None is the unknown size."""
    if at >= len(data) or not data[at]:
        raise Broken(f"no variable-length integer at {at}")
    width = 9 - data[at].bit_length()
    if at + width > len(data):
        raise Broken(f"cut at {at}")
    value = int.from_bytes(data[at : at + width], "big")
    if keep:
        return value, at + width
    value &= (1 << 7 * width) - 1
    return (None if value == (1 << 7 * width) - 1 else value), at + width


def elements(data: bytes, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(id, body start, body end) of the elements between two places; a master of unknown size runs to the next element of its level."""
    while at < end:
        ident, body = read_vint(data, at, keep=True)
        size, body = read_vint(data, body)
        if size is None:
            if ident not in (SEGMENT, CLUSTER):
                raise Broken(f"element {ident:x} of unknown size")
            stop = end
            if ident == CLUSTER:
                stop = body
                while stop < end:
                    inner, inner_body = read_vint(data, stop, keep=True)
                    if inner in TOP:
                        break
                    length, inner_body = read_vint(data, inner_body)
                    if length is None:
                        raise Broken("unknown size inside a cluster")
                    stop = inner_body + length
        else:
            stop = body + size
        if stop > end:
            raise Broken(f"element {ident:x} at {at} runs past its parent")
        yield ident, body, stop
        at = stop


def _uint(data: bytes, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def block_frames(data: bytes, a: int, b: int) -> tuple[int, int, bool, list[tuple[int, int]]]:
    """(track, relative time, key flag, byte ranges of the frames) of a block's body, for all four kinds of lacing."""
    track, at = read_vint(data, a)
    if at + 3 > b:
        raise Broken("short block")
    when, flags = struct.unpack_from(">hB", data, at)
    at += 3
    lacing = flags & 0x06
    if not lacing:
        return track, when, bool(flags & 0x80), [(at, b)]

    def byte(at: int) -> int:
        if at >= b:
            raise Broken("laced sizes run past the block")
        return data[at]

    n = byte(at) + 1
    at += 1
    if lacing == 0x04:
        if (b - at) % n:
            raise Broken("fixed lacing does not divide the block")
        sizes = [(b - at) // n] * n
    else:
        sizes = []
        for k in range(n - 1):
            if lacing == 0x02:
                size = 0
                while byte(at) == 255:
                    size, at = size + 255, at + 1
                size, at = size + byte(at), at + 1
            else:
                first = at
                byte(at)
                size, at = read_vint(data, at)
                if size is None or at > b:
                    raise Broken("laced sizes run past the block")
                if k:
                    size = sizes[-1] + size - ((1 << 7 * (at - first) - 1) - 1)
            sizes.append(size)
        sizes.append(b - at - sum(sizes))
    if min(sizes) < 0:
        raise Broken("laced sizes run past the block")
    found = []
    for size in sizes:
        found.append((at, at + size))
        at += size
    return track, when, bool(flags & 0x80), found


def parse(data: bytes) -> dict:
    """The packet table of a Matroska file.

    packets: (track, time, start, end, cluster, block, lace, key); tracks: number -> codec, rate, depth;
    cues: (time, track, place), each checked to be the start of a cluster; scale in nanoseconds. Raises Broken on malformed bytes.
    """
    out: dict = {"packets": [], "tracks": {}, "cues": [], "scale": 1_000_000, "duration": None}
    clusters: dict[int, int] = {}
    seen = False
    for top, a, b in elements(data, 0, len(data)):
        if top == EBML:
            seen = True
        if top != SEGMENT:
            continue
        if not seen:
            raise Broken("no EBML header")
        at = a
        for ident, c, d in elements(data, a, b):
            place, at = at - a, d
            if ident == INFO:
                for i, e, f in elements(data, c, d):
                    if i == SCALE:
                        out["scale"] = _uint(data, e, f)
                    elif i == DURATION:
                        if f - e not in (4, 8):
                            raise Broken("duration of an odd width")
                        out["duration"] = struct.unpack(">d" if f - e == 8 else ">f", data[e:f])[0]
            elif ident == TRACKS:
                for i, e, f in elements(data, c, d):
                    if i == TRACK:
                        track: dict = {}
                        for j, g, h in elements(data, e, f):
                            if j in (NUMBER, KIND):
                                track[{NUMBER: "number", KIND: "kind"}[j]] = _uint(data, g, h)
                            elif j == CODEC:
                                track["codec"] = data[g:h].decode()
                            elif j == AUDIO:
                                for k, m, n in elements(data, g, h):
                                    if k == RATE:
                                        track["rate"] = struct.unpack(">d" if n - m == 8 else ">f", data[m:n])[0]
                                    elif k in (CHANNELS, DEPTH):
                                        track[{CHANNELS: "channels", DEPTH: "depth"}[k]] = _uint(data, m, n)
                        out["tracks"][track.get("number")] = track
            elif ident == CLUSTER:
                clusters[place], base, block = len(clusters), 0, 0
                for i, e, f in elements(data, c, d):
                    if i == TIME:
                        base = _uint(data, e, f)
                    elif i == GROUP:
                        found = next(((g, h) for j, g, h in elements(data, e, f) if j == BLOCK), None)
                        if found is None:
                            continue
                        e, f = found
                    if i in (SIMPLE, GROUP):
                        track_no, when, key, frames = block_frames(data, e, f)
                        out["packets"] += [(track_no, base + when, g, h, len(clusters) - 1, block, k, key) for k, (g, h) in enumerate(frames)]
                        block += 1
            elif ident == CUES:
                for i, e, f in elements(data, c, d):
                    if i == CUE:
                        when = 0
                        for j, g, h in elements(data, e, f):
                            if j == CUE_TIME:
                                when = _uint(data, g, h)
                            elif j == CUE_PLACES:
                                values = {k: _uint(data, m, n) for k, m, n in elements(data, g, h)}
                                out["cues"].append((when, values.get(CUE_TRACK), values.get(CUE_CLUSTER)))
    if not seen:
        raise Broken("no EBML header")
    if any(place not in clusters for _, _, place in out["cues"]):
        raise Broken("a cue points at no cluster")
    out["clusters"] = len(clusters)
    return out


def padded(text: str | None) -> tuple[int, bytes]:
    """(bytes of the text, its UTF-8 with zeros up to a positive multiple of 64)."""
    raw = b"" if text is None else text.encode()
    return len(raw), raw + bytes(-len(raw) % 64 if raw else 64)


MEDIA = "doc_id long, n_bytes long, media binary"
PACKETS = "doc_id long, track int, time long, start long, end long, cluster int, block int, lace int, key boolean"


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media (a Matroska file) of every row; null and empty texts store 64 zeros. Repeated rows give repeated rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                both = [padded(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in both], pa.int64()), pa.array([mux(p) for _, p in both], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(tidy(run), MEDIA)


def packets(media: DataFrame) -> DataFrame:
    """The packet table of a media column: a row for each packet with its track, time, byte range, cluster, block, place in the lace and key flag. Null media give no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PACKETS.split(", ")]
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if data is not None:
                    columns = zip(*((doc_id, *p) for p in parse(data)["packets"]))
                    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return media.select("doc_id", "media").mapInArrow(tidy(run), PACKETS)


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, packets long, clusters long, cues long, feature string"


def describe(data: bytes) -> tuple[bytes, dict, str]:
    """(payload read back, parsed file, feature): the feature holds the packets, the duration and 16 shares of the byte histogram."""
    file = parse(data)
    payload = b"".join(data[a:b] for _, _, a, b, *_ in file["packets"])
    bins = np.bincount(np.frombuffer(payload, "u1") >> 4, minlength=16)
    shares = (bins * 255 + len(payload) // 2) // max(1, len(payload))
    return payload, file, f"p{len(file['packets'])}.d{int(file['duration'] or 0)}.h" + bytes(shares.astype("u1")).hex()


def media_digests(media: DataFrame) -> DataFrame:
    """Per media row: what its bytes hold, read back through the packet table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, n, data in zip(*(batch.column(k).to_pylist() for k in range(3))):
                payload, file, feature = describe(data)
                out.append((doc_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), len(file["packets"]), file["clusters"], len(file["cues"]), feature))
            kinds = {"string": pa.string(), "long": pa.int64()}
            fields = [x.split() for x in DIGEST.split(", ")]
            columns = list(zip(*out)) if out else [()] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])

    return media.mapInArrow(tidy(run), DIGEST)


def op5_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> a stored column of Matroska files -> digests of what is read back from it."""
    return media_digests(written(media_column(spark.read.parquet(f"{sf_dir}/documents.parquet")), "media"))
