"""Alignment files: any split reads what a whole read does; cut and damaged files fail."""

import os
import random

import pyarrow.fs as pafs
import pytest

from methlake.sources import bam, bgzf

REFS = [("chr1", 100000), ("chr2", 5000), ("lambda", 48502)]
FS = pafs.LocalFileSystem()


def some_rows(n, seed=1, longest=300):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        size = rng.choice([0, 1, 2, rng.randrange(longest)])
        mapped = rng.random() < 0.8
        ref = rng.choice(REFS) if mapped else None
        cut = rng.randrange(size + 1)
        out.append({
            "qname": f"q{k}", "flag": rng.randrange(4096), "rname": ref and ref[0], "pos": rng.randrange(ref[1]) if mapped else None, "mapq": rng.randrange(255),
            "cigar": [{"op": o, "len": x} for o, x in ((4, cut), (0, size - cut)) if x] if mapped else [], "rnext": ref and ref[0], "pnext": 7 if mapped else None, "tlen": rng.randrange(-500, 500),
            "seq": "".join(rng.choice("ACGTN") for _ in range(size)) or None, "qual": "".join(chr(33 + rng.randrange(60)) for _ in range(size)) or None, "tags": {"RG": f"S{k % 7}", "XM": "z." * (k % 5)}})
    return out


def put(path, rows, blocks=bgzf.BLOCK, end=True, text="@HD\tVN:1.6\tSO:unsorted\n"):
    import struct

    data = b"BAM\1" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(REFS))
    for n, size in REFS:
        data += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", size)
    data += b"".join(bam.encoded(r, {n: k for k, (n, _) in enumerate(REFS)}) for r in rows)
    raw = b"".join(bgzf.block(data[k : k + blocks]) for k in range(0, len(data), blocks))
    with open(path, "wb") as f:
        f.write(raw + (bgzf.END if end else b""))
    return os.path.getsize(path)


def read(path, split, **options):
    size = os.path.getsize(path)
    found = []
    for start in range(0, size, split):
        for b in bam.records(FS, path, size, start, min(size, start + split), tags=True, **options):
            found += b.to_pylist()
    return found


def plain(rows):
    return [{k: dict(v) if k == "tags" else v for k, v in r.items() if k not in ("file", "place")} for r in rows]


@pytest.mark.parametrize("blocks, longest", [(bgzf.BLOCK, 300), (700, 300), (500, 6000)])
def test_any_split(tmp_path, blocks, longest):
    rows = some_rows(1500, longest=longest)
    path = f"{tmp_path}/a.bam"
    size = put(path, rows, blocks)
    whole = read(path, size)
    assert plain(whole) == rows
    assert [r["place"] for r in whole] == sorted({r["place"] for r in whole})
    for split in (size // 2, size // 7 + 1, 5000, 1777):
        assert read(path, split) == whole
    # small buffers too
    assert read(path, size, batch=1000) == whole


def test_no_records(tmp_path):
    size = put(f"{tmp_path}/a.bam", [])
    assert read(f"{tmp_path}/a.bam", size) == read(f"{tmp_path}/a.bam", 20) == []


@pytest.mark.parametrize("split", [10**9, 3000])
def test_damage(tmp_path, split):
    rows = some_rows(800)
    path = f"{tmp_path}/a.bam"
    size = put(path, rows, 4000)
    raw = open(path, "rb").read()
    rng = random.Random(5)

    def fails(data):
        with open(path, "wb") as f:
            f.write(data)
        with pytest.raises(bgzf.Broken):
            read(path, split)

    # a bit inside the data or the checksum of a block; headers of blocks; the file's end
    for _ in range(25):
        at = rng.randrange(30, size - 40)
        fails(raw[:at] + bytes([raw[at] ^ 1 << rng.randrange(8)]) + raw[at + 1 :]) if not _harmless(raw, at) else None
    for cut in (size - 1, size - 28, size - 29, size // 2, 1000):
        fails(raw[:cut])
    # a whole block is missing
    at = raw.index(bgzf.MAGIC, size // 2)
    n = bgzf.block_size(raw, at)
    fails(raw[:at] + raw[at + n :])


def _harmless(raw, at):
    """Bytes of a block's header that carry nothing: time, flags of the packer, its system."""
    start = raw.rfind(bgzf.MAGIC, 0, at + 1)
    return 4 <= at - start < 10


def test_contigs_of_a_sorted_file(tmp_path):
    order = {n: k for k, (n, _) in enumerate(REFS)}
    rows = sorted(some_rows(3000), key=lambda r: (order.get(r["rname"], 9), r["pos"] or 0))
    path = f"{tmp_path}/a.bam"
    size = put(path, rows, 2000, text="@HD\tVN:1.6\tSO:coordinate\n")
    for names in (["chr2"], ["chr1", "lambda"], ["none"]):
        for split in (size, 6000):
            assert plain(read(path, split, contigs=names)) == [r for r in rows if r["rname"] in names]


def test_region_bins():
    # the ends of a level's bins, and one that only the root holds
    assert [bam.region_bin(*x) for x in ((0, 1), (16383, 16384), (16384, 16385), (16383, 16385), (0, 1 << 29), ((1 << 26) - 1, (1 << 26) + 1))] == [4681, 4681, 4682, 585, 0, 0]


def test_source(spark, tmp_path):
    rows = some_rows(2000)
    df = spark.createDataFrame(rows, bam.SCHEMA.split(", file")[0])
    # added to a folder, file by file
    bam.write_bam(df.where("flag % 3 = 0"), f"file://{tmp_path}/out", REFS)
    bam.write_bam(df.where("flag % 3 > 0").repartition(3), f"file://{tmp_path}/out", REFS, ordered=False)
    assert len([f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".bam")]) == 4
    for split in (bam.SPLIT, 4000):
        found = bam.read_bam(spark, f"file://{tmp_path}/out", tags=True, split=split)
        got = [r.asDict(True) for r in found.collect()]
        assert sorted(plain(got), key=lambda r: r["qname"]) == sorted(rows, key=lambda r: r["qname"])
    assert bam.read_bam(spark, f"{tmp_path}/out", contigs=["chr2"]).count() == sum(r["rname"] == "chr2" for r in rows)
    name = next(f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".bam"))
    with open(f"{tmp_path}/out/{name}", "r+b") as f:
        f.truncate(os.path.getsize(f"{tmp_path}/out/{name}") - 40)
    with pytest.raises(Exception, match="cut off|closing block"):
        bam.read_bam(spark, f"{tmp_path}/out").count()
