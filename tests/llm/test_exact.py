"""Exact duplicates and whitening against brute force."""

import hashlib
import random
import re
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from methlake.llm import blocknames, queries, whitening

SF = "/root/testdata/sf0.001"


def brute_classes(rows):
    plain = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    out = []
    for (i, t), p in zip(rows, plain):
        members = [(-len(u or ""), j is None, j or 0) for (j, u), q in zip(rows, plain) if q == p]
        best = min(members)
        out.append((i, None if best[1] else best[2], len(members), hashlib.sha256(p.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [2, 7, 512])
def test_block_names(spark, block):
    random.seed(block)
    texts = ["", None, " \t\n\x0b\x0c\r", "a", " a", "é", " a", "ab" * 900, "ab" * 900 + " ", "ab" * 899 + "ba", "x" * 5000, "x" * 4999, "x" * 5000]
    texts += ["".join(random.choice("ab ") for _ in range(random.randrange(40))) for _ in range(300)]
    base = ["".join(random.choice("abcdef ghi") for _ in range(3000)) for _ in range(5)]
    texts += [b[:k] + random.choice(["", " ", "  "]) + b[k:] for b in base for k in (0, 10, 2999)] + [b[:1500] + "Z" + b[1501:] for b in base]
    texts += ["one copy of many"] * 400
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)] + [(7, "a"), (7, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'c' key", "1 pos", "2 name", "3 bytes")
    found = blocknames.exact_duplicates(docs, block=block).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=repr) == brute_classes(rows)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in found}) and all(r.doc_id == r.keep_id for r in kept)


def test_block_names_of_nothing(spark):
    assert blocknames.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_names_span_ranges(spark):
    rows = spark.range(4000).selectExpr("id key", "cast(0 as int) pos", "cast(if(id % 3 = 0, 'm', cast(id % 500 as string)) as binary) block")
    want = {b: i + 1 for i, b in enumerate(sorted({b"m"} | {str(k % 500).encode() for k in range(4000) if k % 3}))}
    content = {k: b"m" if k % 3 == 0 else str(k % 500).encode() for k in range(4000)}
    assert {r.key: r.name for r in blocknames.named(rows, ["block"]).collect()} == {k: want[c] for k, c in content.items()}
    # by hash: of every block its own, of few values (so that contents of one hash lie on both sides of a bound), of one
    for lead in (F.xxhash64, lambda c: F.pmod(F.xxhash64(c), F.lit(7)), lambda c: F.lit(1).cast("long")):
        got = {r.key: (r.name, r.single) for r in blocknames.named(rows, ["block"], hashed=True, lead=lead).collect()}
        names = {}
        for k, (name, single) in got.items():
            names.setdefault(content[k], set()).add(name)
            assert not single or sum(c == content[k] for c in content.values()) == 1
        assert len(got) == 4000 and all(len(v) == 1 for v in names.values()) and {n for v in names.values() for n in v} == set(range(1, len(want) + 1))


def test_block_names_query(spark):
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = c.sql(queries.ORACLE_SQL["op12_block_names"])
    df = queries.QUERIES["op12_block_names"](spark, SF).select(*want.columns)
    assert sorted(map(tuple, df.collect())) == sorted(want.fetchall())


def brute_whitening(vectors):
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    once = sorted(set(map(tuple, x)))
    n, sums = len(once), [sum(c) for c in zip(*once)]
    mean = [Fraction(s, n) for s in sums]
    y = np.array([[float(a - m) for a, m in zip(r, mean)] for r in once])
    e, v = np.linalg.eigh(y.T @ y / n)
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    white = np.array([[float(a - m) for a, m in zip(r, mean)] for r in x]) @ v[:, ::-1] / np.sqrt(np.maximum(e[::-1], 1e-300))
    return n, deviation, white, e[::-1] / e.sum()


def held(found, ids, want, k):
    n, deviation, white, explained = want
    by = {(r.vec_id, r.component): r for r in found}
    assert len(by) == len(found) == len(ids) * k
    for i, d in zip(ids, deviation):
        assert all(by[i, c + 1].deviation == d and by[i, c + 1].n == n for c in range(k))
    for c in range(k):
        got = np.array([by[i, c + 1].whitened for i in ids])
        sign = 1 if got @ white[:, c] > 0 else -1
        assert np.allclose(got * sign, white[:, c], atol=1e-6)
        assert abs(by[ids[0], c + 1].explained / explained[c] - 1) < 1e-6
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-8


def test_whitening(spark):
    rng = np.random.default_rng(3)
    v = (rng.normal(size=(300, 20)) @ rng.normal(size=(20, 20))).astype(np.float32)
    rows = [(i, r.tolist()) for i, r in enumerate(v)] + [(1000 + i, r.tolist()) for i, r in enumerate(v[:40])] + [(2**60 + 1, v[0].tolist())]
    bad = [(5000, None), (5001, []), (5002, [None] * 20), (5003, [float("nan")] * 20), (5004, [float("inf")] * 20), (5005, [1.0]), (5006, [1e30] * 20), (5007, [1.0] * 19 + [None])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").selectExpr("*", "1 x", "'n' n", "2 i")
    held(whitening.whitened(df).collect(), [i for i, _ in rows], brute_whitening([x for _, x in rows]), 16)
    held(whitening.whitened(df, components=3).collect(), [i for i, _ in rows], brute_whitening([x for _, x in rows]), 3)


def test_whitening_edges(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whitened(make([])).collect() == []
    assert whitening.whitened(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    # two dimensions of which one is constant; a null id
    found = whitening.whitened(make([(1, [1.0, 2.0]), (None, [1.0, 3.0]), (3, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation) for r in found] == [(1, 2, 64**2)] * 3
    assert sorted(round(abs(r.whitened), 9) for r in found) == [1.0] * 3 and any(r.vec_id is None for r in found)
    # beyond 64 bits
    wide = whitening.whitened(make([(1, [2.0**32]), (2, [-(2.0**32)]), (3, [0.0])])).collect()
    assert {r.vec_id: r.deviation for r in wide} == {1: None, 2: None, 3: 0}


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute_whitening([x for _, x in rows])
    held(queries.QUERIES["op11_whitening"](spark, SF).collect(), [i for i, _ in rows], want, min(16, want[0] - 1))
