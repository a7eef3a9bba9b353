"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of BLOCK bytes. All blocks of the corpus are sorted, by a hash and then by their bytes, and a block's name is its rank among the
different blocks. Then neighbouring names of a document are paired, the pairs are sorted and named in the same way, and so on until a document has one
name. Texts of one length have as many names at each level, so (length, last name) stands for the whole text: names are ranks, not hashes, and nothing
collides. A document with a block, or pair, that occurs nowhere else is told apart by it and goes no further.

Sorting is by ranges of (content, row, place), so equal contents may fill many ranges. The bounds of the blocks' ranges are of (hash, row, place), which keeps what they are drawn from small; if contents of one
hash should lie on both sides of a bound, which the ranges tell of, the blocks are sorted by bytes instead. A range counts the different contents in it and tells its first
and last; a name is its count plus the prefix sum of the ranges before, less one where a content goes on from one range into the next. Levels halve.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import tidy, written

#: bytes of a block
BLOCK = 512
#: what does not count when texts are compared
SPACE = r"[\x20\x09-\x0D]+"

NAMED = "key long, pos int, name long, single boolean, part int, first binary, last binary, names long, lead_first long, lead_last long, mixed_first boolean, mixed_last boolean"


def _edge(columns: list[pa.Array], at: int) -> bytes:
    values = [c[at].as_py() for c in columns]
    return values[0] if isinstance(values[0], bytes) else struct.pack(f">{len(values)}q", *values)


def _runs(hashed: bool):
    """A sorted range's rows (key, pos, the hash if hashed, content columns) -> key, pos, number of the content in the range (from 1), and whether it occurs once for certain.

    A last row describes the range: its first and last content and their hashes, how many contents it has, and whether several share its first or its last hash.
    """
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in NAMED.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, count, fresh, first, lead_first = None, 0, True, None, None
        opening, mixed_first, mixed_last = True, False, False

        def rows(keys, places, names, single):
            n = len(names)
            own = [keys, places, pa.array(names, pa.int64()), pa.array(single, pa.bool_()), pa.array(np.full(n, part, np.int32))]
            return pa.RecordBatch.from_arrays([*own, *[pa.nulls(n, f.type) for f in list(schema)[5:]]], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                # the last row of the batch before waits for what follows it
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            columns = batch.columns[3 if hashed else 2 :]
            if first is None:
                first, count = _edge(columns, 0), 1
                lead_first = batch.column(2)[0].as_py() if hashed else None
            n = batch.num_rows
            new = np.zeros(n, bool)
            for c in columns:
                new[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            names = count + np.cumsum(new)
            if hashed:
                h = batch.column(2).to_numpy()
                other = h[1:] != h[:-1]
                mixed = new[1:] & ~other
                turns = np.flatnonzero(other)
                if opening:
                    mixed_first |= bool(mixed[: turns[0]].any()) if len(turns) else bool(mixed.any())
                    opening = not len(turns)
                mixed_last = bool(mixed[turns[-1] :].any()) if len(turns) else mixed_last or bool(mixed.any())
            new[0] = fresh
            # the range's first content may go on from the range before
            single = new[:-1] & new[1:] & (names[:-1] > 1)
            yield rows(batch.column(0).slice(0, n - 1), batch.column(1).slice(0, n - 1), names[:-1], single)
            held, count, fresh = batch.slice(n - 1), int(names[-1]), bool(new[-1])
        if held is not None:
            # and its last into the next
            yield rows(held.column(0), held.column(1), [count], [False])
            lead_last = held.column(2)[0].as_py() if hashed else None
            edge = {"part": part, "first": first, "last": _edge(held.columns[3 if hashed else 2 :], 0), "names": count, "lead_first": lead_first, "lead_last": lead_last, "mixed_first": mixed_first, "mixed_last": mixed_last}
            yield pa.RecordBatch.from_pydict({f.name: [edge.get(f.name)] for f in schema}, schema=schema)

    return run


def named(rows: DataFrame, content: list[str], hashed: bool = False, lead=F.xxhash64) -> DataFrame:
    """key, pos, name, single of rows (key, pos and the content columns): equal contents have one name from 1 on, in order of content (hashed: of its hash, lead, and content). single: it occurs once.

    Only one row for each range (its first and last content and a count) passes the driver.
    """
    spark = rows.sparkSession
    if hashed:
        rows = rows.select("key", "pos", lead(*content).alias("h"), *content)
        ranged = rows.repartitionByRange("h", "key", "pos").sortWithinPartitions("h", *content, "key", "pos")
    else:
        order = [*content, "key", "pos"]
        ranged = rows.select("key", "pos", *content).repartitionByRange(*order).sortWithinPartitions(*order)
    found = written(ranged.mapInArrow(tidy(_runs(hashed)), NAMED), "names")
    bases, total, before = [], 0, None
    for r in sorted(found.where("names is not null").drop("key", "pos", "name", "single").collect()):
        shared = before is not None and r["first"] == before["last"]
        if hashed and before is not None and r["lead_first"] == before["lead_last"] and (before["mixed_last"] or r["mixed_first"] or not shared):
            return named(rows.drop("h"), content)
        bases.append((r["part"], total - shared))
        total, before = total - shared + r["names"], r
    base = spark.createDataFrame(bases, "part int, base long")
    return found.where("names is null").join(F.broadcast(base), "part").select("key", "pos", (F.col("name") + F.col("base")).alias("name"), "single")


def identities(texts: DataFrame) -> DataFrame:
    """key, name, alone of texts (key, blocks): (number of bytes, name) is the identity of a text that is not alone; an alone one is equal to no other."""
    rows = texts.select("key", F.posexplode("blocks").alias("pos", "block"))
    content, done = ["block"], []
    while True:
        docs = named(rows, content, hashed=content == ["block"]).groupBy("key").agg(F.bool_or("single").alias("alone"), F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("m"))
        docs = written(docs.select("key", "alone", F.col("m.name").alias("m")), "level")
        ended = F.col("alone") | (F.size("m") == 1)
        done.append(docs.where(ended).select("key", F.get("m", F.lit(0)).alias("name"), "alone"))
        going = docs.where(~ended)
        if going.isEmpty():
            break
        # an odd last name is paired with 0, which is no name
        pairs = F.transform(F.sequence(F.lit(0), F.floor((F.size("m") - 1) / 2).cast("int")), lambda i: F.struct(F.get("m", 2 * i).alias("a"), F.coalesce(F.get("m", 2 * i + 1), F.lit(0)).alias("b")))
        rows = going.select("key", F.posexplode(pairs).alias("pos", "p")).select("key", "pos", "p.a", "p.b")
        content = ["a", "b"]
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row: classes of texts that are equal without white space (SPACE).

    Of a class the row with the most code points in its original text, then the smallest id (null last), then the first in the scan stays; exactly one. Null texts count as empty, and
    empty texts, and texts of nothing but white space, are one class. Rows that repeat an id are rows of their own. Very long texts are cut into as many blocks as they need. An empty table gives none;
    other columns are not read. text_sha256 is of the normalised text.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("chars"), F.regexp_replace(text, SPACE, "").alias("t"))
    size = F.octet_length("t")
    cut = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(size - 1, F.lit(0)) / block).cast("int")), lambda i: F.substring(F.col("t").cast("binary"), i * block + 1, F.lit(block)))
    # the keys of the rows hold once they are written
    rows = written(plain.select(F.monotonically_increasing_id().alias("key"), "doc_id", "chars", size.alias("bytes"), F.sha2("t", 256).alias("text_sha256"), cut.alias("blocks")), "texts")
    # joined by key in full: no side is small
    members = rows.drop("blocks").join(identities(rows).hint("merge"), "key")
    members = written(members, "members")
    rank = F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    groups = members.where("not alone").groupBy("bytes", "name").agg(F.count("*").alias("group_size"), F.min(rank).alias("keep"))
    # written, so that the join has an exchange on both sides and a class of very many rows is split
    groups = written(groups.select("bytes", "name", "group_size", F.col("keep.doc_id").alias("keep_id"), F.col("keep.key").alias("keep_key")), "classes")
    same = members.where("not alone").join(groups.hint("merge"), ["bytes", "name"])
    same = same.select("doc_id", "keep_id", "group_size", (F.col("key") == F.col("keep_key")).alias("kept"), "text_sha256")
    alone = members.where("alone").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return same.unionByName(alone)


def op12_block_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> class of equal texts of each document."""
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
