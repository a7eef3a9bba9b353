"""Alignment containers as a Spark data source.

A file is read in ranges of bytes. The reader of a range moves on to the first block in it and from there to the first record, which it recognises by its own fields
and those of the records after it; it reads the records that start in its blocks, and the rest of the last one from the blocks behind. Then it looks for the first
record of the next range in the way that the next reader does, and fails if that is not where its own records end. So the ranges of a file agree, from its
header to its last block, or the job fails; damaged blocks, cut files and files without the closing block fail too.

Records are laid out in Arrow columns by whole buffers. Their order in a file is that of ``place``.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from methlake.sources.bgzf import BLOCK, END, Blocks, Broken, block
from methlake.sources.files import filesystem, listed

SCHEMA = "qname string, flag int, rname string, pos long, mapq int, cigar array<struct<op: int, len: int>>, rnext string, pnext long, tlen int, seq string, qual string, tags map<string, string>, file string, place long"
#: fixed values of the format: base codes, operations and the kinds of tags
BASES = "=ACMGRSVTWYHKDBN"
HEAD = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("ops", "<u2"), ("flag", "<u2"), ("len", "<i4"), ("next", "<i4"), ("pnext", "<i4"), ("tlen", "<i4")])
TAG = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}
#: bytes of a range, and of blocks that are decoded together
SPLIT, BATCH = 64 << 20, 4 << 20
#: records that must follow a first record for it to be one, or the file's end
CHAIN = 8
#: the rest of a sorted range holds no wanted contig
SKIPPED = object()

_PAIRS = np.array([[BASES[k >> 4], BASES[k & 15]] for k in range(256)], "S1").view(np.uint8).reshape(256, 2)


@dataclass
class Header:
    text: str
    names: list[str]
    lengths: list[int]
    # the first record: block address and place in the block
    first: tuple[int, int] | None


def header(blocks: Blocks) -> Header:
    """The header of a file whose blocks are read from the start on."""
    held, marks = bytearray(), []

    def need(n: int) -> None:
        while len(held) < n:
            b = blocks.next()
            if b is None:
                raise Broken(f"{blocks.path}: cut off in the header")
            marks.append((len(held), b[0]))
            held.extend(b[1])

    need(12)
    if held[:4] != b"BAM\1":
        raise Broken(f"{blocks.path}: no alignment file")
    n_text = struct.unpack_from("<i", held, 4)[0]
    need(12 + n_text)
    text = held[8 : 8 + n_text].decode().rstrip("\0")
    n, at = struct.unpack_from("<i", held, 8 + n_text)[0], 12 + n_text
    names, lengths = [], []
    for _ in range(n):
        need(at + 4)
        size = struct.unpack_from("<i", held, at)[0]
        need(at + 8 + size)
        names.append(held[at + 4 : at + 3 + size].decode())
        lengths.append(struct.unpack_from("<i", held, at + 4 + size)[0])
        at += 8 + size
    while len(held) == at and (b := blocks.next()) is not None:
        marks.append((len(held), b[0]))
        held.extend(b[1])
    if len(held) == at:
        return Header(text, names, lengths, None)
    start, address = max(m for m in marks if m[0] <= at)
    return Header(text, names, lengths, (address, at - start))


def _plausible(data: bytes, at: int, lengths: list[int]) -> int | None:
    """Bytes of the record at a place, None if its fields say that it is none; 0 if the data end before its fields do."""
    if at + 36 > len(data):
        return 0
    size, ref, pos, name, _, _, ops, _, n, nref, npos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    fixed = 32 + name + 4 * ops + (n + 1) // 2 + n
    if not (name >= 1 and 0 <= n and fixed <= size < 1 << 28 and -1 <= ref < len(lengths) and -1 <= nref < len(lengths) and -1 <= pos and -1 <= npos):
        return None
    if (ref >= 0 and pos > lengths[ref]) or (nref >= 0 and npos > lengths[nref]):
        return None
    text = data[at + 36 : at + 36 + name]
    if len(text) == name and (text[-1] != 0 or any(not 33 <= c <= 126 for c in text[:-1])):
        return None
    codes = data[at + 36 + name : at + 36 + name + 4 * ops : 4]
    return None if any(c & 15 > 8 for c in codes) else 4 + size


def first_record(fs, path: str, size: int, start: int, lengths: list[int]) -> tuple[int, int] | None:
    """(block address, place) of the first record in the blocks from byte start on, or None. A record that begins in an earlier block is passed over."""
    with Blocks(fs, path, size, start, 1 << 18) as blocks:
        if not blocks.seek():
            return None
        data, marks, at, ended = bytearray(), [], 0, False

        def more() -> bool:
            b = blocks.next()
            if b is not None and b[1]:
                marks.append((len(data), b[0]))
                data.extend(b[1])
            return b is not None

        while True:
            # a chain of records from here, or the file's end
            p, n = at, 0
            while n < CHAIN:
                step = _plausible(data, p, lengths)
                if step is None:
                    break
                if step and p + step <= len(data):
                    p, n = p + step, n + 1
                elif not ended:
                    ended = not more()
                else:
                    break
            if n == CHAIN or (ended and p == len(data)):
                if at == len(data):
                    return None
                begin, address = max(m for m in marks if m[0] <= at)
                return address, at - begin
            at += 1


def _decoded(buf: bytes, at: np.ndarray, place: np.ndarray, names: list[str], file: str, tags: bool) -> pa.RecordBatch:
    """Arrow columns of the records that start at the places ``at`` of a buffer."""
    a = np.frombuffer(buf, np.uint8)
    h = a[at[:, None] + np.arange(36)].copy().view(HEAD)[:, 0]

    def ragged(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, places in the buffer) of pieces."""
        offsets = np.zeros(len(start) + 1, np.int64)
        np.cumsum(length, out=offsets[1:])
        return offsets, np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])

    def texts(offsets: np.ndarray, values: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
        s = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values)))
        s = s.cast(pa.string())
        return s if valid is None else pa.compute.if_else(pa.array(valid), s, None)

    name_at = at + 36
    ops_at = name_at + h["name"]
    seq_at = ops_at + 4 * h["ops"].astype(np.int64)
    n = h["len"].astype(np.int64)
    half = (n + 1) // 2
    qual_at = seq_at + half
    o, i = ragged(name_at, h["name"].astype(np.int64) - 1)
    qname = texts(o, a[i])
    o, i = ragged(ops_at, 4 * h["ops"].astype(np.int64))
    ops = a[i].view("<u4") if len(i) else np.zeros(0, np.uint32)
    pair = pa.StructArray.from_arrays([pa.array((ops & 15).astype(np.int32)), pa.array((ops >> 4).astype(np.int32))], ["op", "len"])
    cigar = pa.ListArray.from_arrays(pa.array((o // 4).astype(np.int32)), pair)
    o, i = ragged(seq_at, half)
    letters = _PAIRS[a[i]].reshape(-1)
    # an odd sequence leaves half a byte
    keep = np.ones(2 * len(i), bool)
    keep[2 * o[1:][n % 2 == 1] - 1] = False
    so = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=so[1:])
    seq = texts(so, letters[keep], n > 0)
    o, i = ragged(qual_at, n)
    raw = a[i]
    some = np.ones(len(n), bool)
    some[n > 0] = raw[o[:-1][n > 0]] != 255
    qual = texts(o, np.where(raw == 255, 0, raw) + np.uint8(33), some & (n > 0))
    dictionary = pa.array(names or [""], pa.string())

    def contigs(ref: np.ndarray) -> pa.Array:
        return dictionary.take(pa.array(ref, mask=ref < 0))

    def places(pos: np.ndarray) -> pa.Array:
        return pa.array(pos.astype(np.int64), mask=pos < 0)

    ends = at + 4 + h["size"].astype(np.int64)
    kind = pa.map_(pa.string(), pa.string())
    found = pa.array([list(_tags(buf, s, e).items()) for s, e in zip((qual_at + n).tolist(), ends.tolist())], kind) if tags else pa.nulls(len(at), kind)
    columns = [
        qname, pa.array(h["flag"].astype(np.int32)), contigs(h["ref"]), places(h["pos"]), pa.array(h["mapq"].astype(np.int32)), cigar, contigs(h["next"]), places(h["pnext"]), pa.array(h["tlen"]), seq, qual,
        found, pa.array([file] * len(at), pa.string()), pa.array(place)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.replace("array<struct<op: int, len: int>>", "a").replace("map<string, string>", "m").split(", ")])


def _tags(buf: bytes, at: int, end: int) -> dict[str, str]:
    out = {}
    while at < end:
        name, kind = buf[at : at + 2].decode(), chr(buf[at + 2])
        at += 3
        if kind == "A":
            value, at = chr(buf[at]), at + 1
        elif kind in TAG:
            value, at = str(struct.unpack_from(TAG[kind], buf, at)[0]), at + struct.calcsize(TAG[kind])
        elif kind in "ZH":
            stop = buf.index(b"\0", at, end)
            value, at = buf[at:stop].decode(), stop + 1
        elif kind == "B":
            sub, n = chr(buf[at]), struct.unpack_from("<I", buf, at + 1)[0]
            value = sub + "".join(f",{x}" for x in struct.unpack_from(f"<{n}{TAG[sub][1]}", buf, at + 5))
            at += 5 + n * struct.calcsize(TAG[sub])
        else:
            raise Broken(f"tag of kind {kind!r}")
        out[name] = value
    return out


def records(fs, path: str, size: int, start: int, end: int, contigs: list[str] | None = None, tags: bool = False, batch: int = BATCH) -> Iterator[pa.RecordBatch]:
    """The records that start in the blocks from byte start up to end. contigs: only records on these; a coordinate-sorted file's ranges without any are not decoded."""
    with Blocks(fs, path, size) as blocks:
        head = header(blocks)
    first = head.first if start == 0 else first_record(fs, path, size, start, head.lengths)
    wanted = None if contigs is None else {k for k, n in enumerate(head.names) if n in contigs}
    ordered = wanted is not None and "SO:coordinate" in head.text.split("\n", 1)[0]
    after = first
    if first is not None and first[0] < end:
        for out in _walk(fs, path, size, first, end, head, wanted, ordered, tags, batch):
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                after = out
        if after is SKIPPED:
            return
    if end < size and after != (found := first_record(fs, path, size, end, head.lengths)):
        raise Broken(f"{path}: records end at {after}, but those after byte {end} begin at {found}")
    if end >= size:
        with Blocks(fs, path, size, max(0, size - len(END))) as last:
            if size < len(END) or last._bytes(len(END)) != END:
                raise Broken(f"{path}: the closing block is missing")


def _walk(fs, path, size, first, end, head, wanted, ordered, tags, batch):
    """Batches of records from a first one on, and last where the first record behind them starts: (address, place), None at the end of the file, or SKIPPED."""
    with Blocks(fs, path, size, first[0]) as blocks:
        buf, marks, at, stop, ended = bytearray(), [], first[1], None, False
        while True:
            grown = 0
            while grown < batch and not ended:
                b = blocks.next()
                if b is None:
                    ended = True
                elif b[1]:
                    if b[0] >= end and stop is None:
                        stop = len(buf)
                    marks.append((len(buf), b[0]))
                    buf.extend(b[1])
                    grown += len(b[1])
                    if stop is not None and at >= stop:
                        break
            whole, places, limit = bytes(buf), [], len(buf) if stop is None else stop
            unpack = struct.Struct("<i").unpack_from
            while at < limit and at + 4 <= len(whole):
                n = unpack(whole, at)[0]
                if n < 32:
                    raise Broken(f"{path}: a record of {n} bytes")
                if at + 4 + n > len(whole):
                    break
                places.append(at)
                at += 4 + n
            if places:
                p = np.array(places, np.int64)
                begins, addresses = (np.array(x, np.int64) for x in zip(*marks))
                k = np.searchsorted(begins, p, "right") - 1
                where = (addresses[k] << 16) | (p - begins[k])
                ref = np.frombuffer(whole, np.uint8)[p[:, None] + np.arange(4, 8)].copy().view("<i4")[:, 0]
                if wanted is not None:
                    own = np.isin(ref, list(wanted))
                    p, where = p[own], where[own]
                if len(p):
                    yield _decoded(whole, p, where, head.names, path, tags)
                if ordered and (ref[-1] < 0 or ref[-1] > max(wanted, default=-1)):
                    # nothing wanted comes any more
                    yield SKIPPED
                    return
            if at >= limit and (stop is not None or ended):
                break
            if ended:
                raise Broken(f"{path}: cut off inside a record")
            # what is left of a record moves to the front
            keep = max(m[0] for m in marks if m[0] <= at) if at < len(buf) else len(buf)
            del buf[:keep]
            marks = [(o - keep, x) for o, x in marks if o >= keep]
            at -= keep
            stop = None if stop is None else stop - keep
        while at == len(buf) and not ended:
            b = blocks.next()
            if b is None:
                ended = True
            elif b[1]:
                marks.append((len(buf), b[0]))
                buf.extend(b[1])
        if at == len(buf):
            yield None
        else:
            begin, address = max(m for m in marks if m[0] <= at)
            yield address, at - begin


class Range(InputPartition):
    def __init__(self, path: str, size: int, start: int, end: int):
        self.path, self.size, self.start, self.end = path, size, start, end


class BamReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri, self.split, self.tags = options["path"], int(options.get("splitBytes", SPLIT)), options.get("tags", "false").lower() == "true"
        self.contigs = options["contigs"].split(",") if options.get("contigs") else None

    def partitions(self) -> list[InputPartition]:
        """Ranges from the files' sizes; nothing of them is read on the driver."""
        found = [Range(i.path, i.size, s, min(i.size, s + self.split)) for i in listed(self.uri, "*.bam") for s in range(0, max(1, i.size), self.split)]
        return found or [Range("", 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition.path:
            fs, _ = filesystem(self.uri)
            yield from records(fs, partition.path, partition.size, partition.start, partition.end, self.contigs, self.tags)


def region_bin(begin: int, end: int) -> int:
    """The smallest bin of the format's five-level scheme (16 KiB, then eightfold) that holds [begin, end)."""
    for level in range(5, 0, -1):
        shift = 14 + 3 * (5 - level)
        if begin >> shift == (end - 1) >> shift:
            return ((1 << 3 * level) - 1) // 7 + (begin >> shift)
    return 0


def encoded(row, refs: dict[str, int]) -> bytes:
    """One record; tags become text tags (kind Z)."""
    name = row["qname"].encode() + b"\0"
    cigar, seq = row["cigar"] or [], row["seq"] or ""
    if len(name) > 255 or len(cigar) > 65535:
        raise ValueError(f"{row['qname']}: name or alignment is too long for a record")
    ref, pos = refs[row["rname"]] if row["rname"] is not None else -1, -1 if row["pos"] is None else row["pos"]
    span = sum(c["len"] for c in cigar if c["op"] in (0, 2, 3, 7, 8)) or 1
    codes = [max(BASES.find(b), 0) if b != "N" else 15 for b in seq] + [0] * (len(seq) % 2)
    packed = bytes(x << 4 | y for x, y in zip(codes[::2], codes[1::2]))
    qual = bytes(ord(c) - 33 for c in row["qual"]) if row["qual"] else b"\xff" * len(seq)
    if len(qual) != len(seq):
        raise ValueError(f"{row['qname']}: qualities and bases differ in number")
    tags = b"".join(k.encode() + b"Z" + v.encode() + b"\0" for k, v in (row["tags"] or {}).items())
    body = struct.pack(
        "<iiBBHHHiiii", ref, pos, len(name), row["mapq"], region_bin(pos, pos + span) if pos >= 0 else 4680, len(cigar), row["flag"], len(seq),
        refs[row["rnext"]] if row["rnext"] is not None else -1, -1 if row["pnext"] is None else row["pnext"], row["tlen"] or 0)
    body += name + b"".join(struct.pack("<I", c["len"] << 4 | c["op"]) for c in cigar) + packed + qual + tags
    return struct.pack("<i", len(body)) + body


@dataclass
class Staged(WriterCommitMessage):
    name: str | None


class BamWriter(DataSourceWriter):
    """One file for each task, under its name only once all tasks are done."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        if overwrite:
            raise ValueError("alignment files are written to a new folder or added to one")
        self.uri, self.batch = options["path"].rstrip("/"), uuid.uuid4().hex
        pairs = [r.rsplit(":", 1) for r in options["references"].split(",") if r]
        self.refs = [(n, int(size)) for n, size in pairs]
        self.text = f"@HD\tVN:1.6\tSO:{options.get('order', 'unknown')}\n" + "".join(f"@SQ\tSN:{n}\tLN:{size}\n" for n, size in self.refs)

    def write(self, iterator) -> Staged:
        fs, path = filesystem(self.uri)
        held, out, name = bytearray(), None, None
        text, refs = self.text.encode(), {n: k for k, (n, _) in enumerate(self.refs)}
        for row in iterator:
            if out is None:
                name = f"{uuid.uuid4().hex}.bam"
                fs.create_dir(f"{path}/_staged-{self.batch}", recursive=True)
                out = fs.open_output_stream(f"{path}/_staged-{self.batch}/{name}", compression=None)
                held += b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(self.refs))
                for n, size in self.refs:
                    held += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", size)
            held += encoded(row, refs)
            while len(held) >= BLOCK:
                out.write(block(bytes(held[:BLOCK])))
                del held[:BLOCK]
        if out is not None:
            out.write(block(bytes(held)) + END)
            out.close()
        return Staged(name)

    def commit(self, messages: list[Staged]) -> None:
        fs, path = filesystem(self.uri)
        fs.create_dir(path, recursive=True)
        for k, m in enumerate(messages):
            if m is not None and m.name:
                fs.move(f"{path}/_staged-{self.batch}/{m.name}", f"{path}/part-{k:05d}-{self.batch}.bam")
        self.abort(messages)

    def abort(self, messages: list[Staged]) -> None:
        fs, path = filesystem(self.uri)
        fs.delete_dir_contents(f"{path}/_staged-{self.batch}", missing_dir_ok=True)


class BamSource(DataSource):
    """Options: path (a file or folder), splitBytes, tags (true: read them), contigs (names with commas); for writing references (name:length with commas) and order."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(self.options)

    def writer(self, schema, overwrite: bool) -> BamWriter:
        return BamWriter(self.options, overwrite)


def read_bam(spark: SparkSession, path: str, contigs: list[str] | None = None, tags: bool = False, split: int = SPLIT) -> DataFrame:
    """Records (SCHEMA) of the .bam files under a path. Missing contigs, places, bases and qualities are null; tags is null unless asked for."""
    spark.dataSource.register(BamSource)
    options = {"splitBytes": split, "tags": str(tags).lower()} | ({"contigs": ",".join(contigs)} if contigs is not None else {})
    return spark.read.format("bam").options(**options).load(path)


def write_bam(rows: DataFrame, path: str, references: list[tuple[str, int]], ordered: bool = True) -> None:
    """Records as .bam files of a folder. ordered: by contig (in the order of references) and place, each task a range, so a contig may be several files."""
    from pyspark.sql import functions as F

    spark = rows.sparkSession
    spark.dataSource.register(BamSource)
    columns = [c for c in rows.columns if c not in ("file", "place")]
    if ordered:
        at = F.coalesce(F.array_position(F.array(*[F.lit(n) for n, _ in references]), F.col("rname")), F.lit(len(references) + 1))
        rows = rows.withColumn("__ref", at).repartitionByRange("__ref", "pos", "qname", "flag").sortWithinPartitions("__ref", "pos", "qname", "flag")
    writer = rows.select(*columns).write.format("bam").mode("append")
    writer.option("references", ",".join(f"{n}:{size}" for n, size in references)).option("order", "coordinate" if ordered else "unsorted").save(path)
