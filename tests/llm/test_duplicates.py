"""Near duplicates, repeated strings, embeddings and components against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from methlake.llm import bagminhash, embeddings, substrings
from methlake.llm.components import components
from methlake.llm.rindex import RunIndex
from methlake.llm.shingles import counted, shingles, words

SF = "/root/testdata/sf0.001"


def roots(edges, nodes=()):
    p = {}

    def f(x):
        p.setdefault(x, x)
        while p[x] != x:
            x = p[x]
        return x

    for n in nodes:
        f(n)
    for a, b in edges:
        a, b = f(a), f(b)
        p[max(a, b)] = min(a, b)
    return {x: f(x) for x in p}


def test_components(spark):
    random.seed(4)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(230)] + [(k, k + 1) for k in range(500, 540)] + [(700, k) for k in range(701, 760)]
    got = dict(components(spark.createDataFrame([*edges, (3, 3), (None, 5)], "a long, b long")).collect())
    want = roots([e for e in edges if e[0] != e[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_words(t):
    return re.findall("[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())


def brute_shingles(t, size=5):
    w = brute_words(t)
    return collections.Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else None


def jaccard(a, b):
    m = sum((a & b).values())
    return m / (sum(a.values()) + sum(b.values()) - m)


def brute_classes(rows, threshold=0.8):
    sets = [(i, brute_shingles(t)) for i, t in rows]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and y and a is not None and b is not None and jaccard(x, y) >= threshold]
    return roots(links, [i for i, _ in sets if i is not None])


def edited(text, rng, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
    return " ".join(w)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    base = [" ".join(word() for _ in range(rng.randrange(30, 160))) for _ in range(25)]
    rows = list(base)
    for t in base[:8]:
        rows += [t, t.upper() + "!"] + [edited(t, rng, rng.randrange(1, 6)) for _ in range(6)]
    rows += ["line again here now once\n" * 40, "line again here now once\n" * 44, "line again here now once\n" * 20]
    rows += ["one two", "one two", "one two three", "", "", "...", None]
    return [(k * 3 + 1, t) for k, t in enumerate(rows)] + [(1000, base[3]), (1000, base[3]), (None, base[4])]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 5, [1]) for i, t in rows], "doc_id long, text string, node string, component int, bands array<int>")


def test_words_and_shingles():
    t = ["A b-c Ünï 12\n\nd", None, "", "z"]
    h, of = words(t)
    assert np.bincount(of, minlength=4).tolist() == [6, 0, 0, 1]
    h, of, n = counted(*shingles(["a b c d e f", "a b c d e", "a b", "a b", None]))
    assert np.bincount(of, minlength=5).tolist() == [2, 1, 1, 1, 0] and h[of == 2] == h[of == 3] and n.sum() == 5


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    for _ in range(4):
        h = rng.integers(0, 2**63, 50, dtype=np.uint64)
        a, b = rng.integers(1, 12, 50), rng.integers(0, 12, 50)
        keep = b > 0
        t, s = bagminhash.signatures(np.concatenate([h, h[keep]]), np.concatenate([np.zeros(50, int), np.ones(keep.sum(), int)]), np.concatenate([a, b[keep]]), 2, 4096)
        j = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((s[0] == s[1]).mean() - j) < 4 * np.sqrt(j * (1 - j) / 4096)
        assert np.isfinite(t).all()


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates(spark, texts, block):
    got = bagminhash.near_duplicates(frame(spark, texts), block=block).collect()
    assert len(got) == len(texts)
    want = brute_classes(texts)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == want[r.doc_id]) for r in got)


def test_near_duplicates_of_nothing(spark, texts):
    assert bagminhash.near_duplicates(frame(spark, texts).limit(0)).count() == 0
    assert bagminhash.near_duplicates(frame(spark, [(1, None), (2, "")])).where("kept").count() == 2


def test_edited_copies(spark):
    """Of copies with 0.5 to 4 % of their words replaced (2 % is a similarity of 0.8), all that keep a similarity of 0.8 are found, in one block or many; a very long text is one of them."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    rows, base = [], {}
    for k in range(60):
        n = 30_000 if k == 0 else rng.randrange(60, 400)
        t = " ".join(word() for _ in range(n))
        rows.append((10 * k, t))
        for j in range(1, 4):
            copy = edited(t, rng, max(1, round(n * rng.uniform(0.005, 0.04))) if k else 400 * j)
            rows.append((10 * k + j, copy))
            base[10 * k + j] = jaccard(brute_shingles(copy), brute_shingles(t))
    for block in (512, 5):
        got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(frame(spark, rows), block=block).collect()}
        close = [i for i, s in base.items() if s >= 0.8]
        assert len(close) > 60 and all(got[i] == i // 10 * 10 for i in close)
        # copies of copies may be nearer to each other than to the first; different texts never meet
        assert all(c // 10 == i // 10 for i, c in got.items())
        assert got == brute_classes(rows)


def test_links_of_block_is_exact():
    rng = random.Random(3)
    base = " ".join(str(rng.randrange(50)) for _ in range(60))
    x = [(k, edited(base, rng, rng.randrange(4))) for k in range(40)]
    links = [(a, b) for a, s in x for b, t in x if a < b and jaccard(brute_shingles(s), brute_shingles(t)) >= 0.8]
    assert roots(bagminhash.links_of_block(x, None, 5, 0.8), range(40)) == roots(links, range(40))
    cross = [(a, b) for a, b in links if (a < 20) != (b < 20)]
    assert roots(bagminhash.links_of_block(x[:20], x[20:], 5, 0.8), range(40)) == roots(cross, range(40))


def test_run_index():
    random.seed(2)
    for _ in range(150):
        ss = [bytes(random.choice(b"ab\0") for _ in range(random.randrange(0, 40))) for _ in range(random.randrange(1, 8))]
        n = random.randrange(1, 12)
        index = RunIndex(ss)
        got = index.repeated(n)
        c = collections.Counter(s[i : i + n] for s in ss for i in range(len(s) - n + 1))
        for k, s in enumerate(ss):
            assert got[index.begin[k] : index.begin[k] + len(s) + 1].tolist() == [i + n <= len(s) and c[s[i : i + n]] > 1 for i in range(len(s) + 1)]
    same = RunIndex([b"abcdefgh" * 60] * 30)
    assert same.runs < same.size / 5


def brute_cut(texts, n):
    raw = [(t or "").encode() for t in texts]
    c = collections.Counter(b[i : i + n] for b in raw for i in range(len(b) - n + 1))
    out = []
    for b in raw:
        m = np.zeros(len(b) + 1, int)
        for i in range(len(b) - n + 1):
            if c[b[i : i + n]] > 1:
                m[i] += 1
                m[i + n] -= 1
        m = np.cumsum(m)[: len(b)] > 0
        spans = int((np.diff(np.concatenate([[0], m.view("i1")])) == 1).sum())
        out.append((len(b), int(m.sum()), spans, bytes(np.frombuffer(b, "u1")[~m])))
    return out


@pytest.mark.parametrize("crowd", [600, 2])
def test_repeated_strings(spark, crowd):
    rng = random.Random(6)
    rand = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, period = rand(150), rand(37)
    rows = [rand(200) + passage + rand(100) for _ in range(12)] + [rand(90) + passage[:130] + rand(20) for _ in range(6)]
    rows += [period * 9, "x" * 500, rand(50), rand(50) + period * 4, rand(300), None, "", "short"]
    rows += [rows[3], rows[3], rows[0][:260]]
    near = rand(700)
    rows += [near[:k] + "#" + near[k + 1 :] for k in range(5, 700, 90)]  # most runs have the same bytes in all of these
    d = spark.createDataFrame([(k, t, "q", b"z") for k, t in enumerate(rows)], "doc_id long, text string, spans string, bytes binary")
    got = substrings.repeated_strings(d, length=120, gram=40, crowd=crowd).collect()
    by = {bytes(r.text_id): r for r in got}
    for t, (n, removed, spans, kept) in zip(rows, brute_cut(rows, 120)):
        r = by[hashlib.sha256((t or "").encode()).digest()[:16]]
        assert (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) == (n, removed, spans, kept)
    cut = {r.doc_id: r.text for r in substrings.without_repeats(d, length=120).collect()}
    assert len(cut) == len(rows) and cut[rows.index(None)] is None
    assert substrings.repeated_strings(d.limit(0), length=120).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("texts_")]


def test_anchor_runs_of_a_text_beyond_the_slab(monkeypatch):
    data = np.random.default_rng(8).integers(97, 100, 5000).astype("u1")
    length, gram = 60, 20
    monkeypatch.setattr(substrings, "SLAB", 700)
    x, a, lo, hi = substrings.anchor_runs(data, length, gram)
    starts = np.concatenate([np.arange(f, t + 1) for f, t in zip(lo, hi)])
    assert starts.tolist() == list(range(len(data) - length + 1))
    monkeypatch.undo()
    whole = {int(s): (int(h), int(p)) for h, p, f, t in zip(*substrings.anchor_runs(data, length, gram)) for s in range(f, t + 1)}
    # ties between equal grams go to the leftmost of the window in either way
    assert {int(s): (int(h), int(p)) for h, p, f, t in zip(x, a, lo, hi) for s in range(f, t + 1)} == whole


def test_run_length_query(spark):
    import duckdb

    texts = [t for (t,) in duckdb.sql(f"select text from '{SF}/documents.parquet' order by doc_id").fetchall()]
    got = substrings.op8_run_length_index(spark, SF).orderBy("doc_id").collect()
    want = brute_cut(texts, 400)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == [(a, b, c, hashlib.sha256(k).hexdigest()) for a, b, c, k in want]


@pytest.mark.parametrize("block", [1024, 20])
def test_near_vectors(spark, block):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(150, 16)).astype("f4")
    for k in range(40):
        x[100 + k] = x[k % 10] + rng.normal(size=16) * rng.choice([0.01, 0.05, 0.2])
    x[145] = x[3]
    label = rng.integers(0, 3, 150)
    label[100:] = label[np.arange(50) % 10]
    d = spark.createDataFrame([(int(k), [float(v) for v in x[k]], int(label[k]), "h", 3) for k in range(150)], "vec_id long, embedding array<float>, label int, h string, n int")
    got = {r.vec_id: r for r in embeddings.near_vectors(d, block=block).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = (u @ u.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(s, False)
    want = roots([(int(a), int(b)) for a, b in zip(*np.nonzero(s))], range(150))
    assert s.sum() > 20
    for k in range(150):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (s[k].sum(), want[k], want[k] == k)


def test_near_vectors_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, None], 1), (4, None, 1), (5, [nan, 1.0], 1), (6, [0.0, 0.0], 1), (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (8, [1.0, 0.0], 1), (9, [-0.0, 1.0], 2), (10, [0.0, 1.0], 2), (11, [1.0, 0.0, 0.0], 1), (12, [], 1), (13, [inf, 1.0], 1), (14, [-1.0, 0.0], 1)]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert len(got) == len(rows)
    n = {r.vec_id: (r.n_links, r.component_id) for r in got}
    assert n[1] == (3, 1) and n[2] == (3, 1) and n[8] == (3, 1) and n[9] == (1, 9) and n[10] == (1, 9)
    assert all(n[k] == (0, k) for k in (3, 4, 5, 6, 7, 11, 12, 13, 14))
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_quantisation_bound():
    rng = np.random.default_rng(2)
    x, y = embeddings.unit(rng.normal(size=(200, 64))), embeddings.unit(rng.normal(size=(200, 64)))
    q, s, norm, err = embeddings.quantised(x)
    r, t, _, err_y = embeddings.quantised(y)
    about = (q.astype(float) @ r.astype(float).T) * s[:, None] * t
    assert (np.abs(about - x @ y.T) <= err[:, None] + norm[:, None] * err_y + 1e-12).all()
    assert embeddings.tile(x, x, 0.98)[2] < 400


def test_vectors_of_many_dimensions_and_extreme_sizes(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(12, 5000))
    x[1], x[2], x[3] = x[0] * 1e-30, x[0] * 1e30, x[0] + 0.05 * rng.normal(size=5000)
    x[5] = x[4] * -1e-20
    d = spark.createDataFrame([(k, [float(v) for v in x[k]], 1) for k in range(12)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(d).collect()}
    assert {k: got[k] for k in range(4)} == {k: (3, 0) for k in range(4)} and all(got[k] == (0, k) for k in range(4, 12))
    u = embeddings.unit(np.array([[1e-300, 1e300, 0.0], [0.0, 1.0, 1e-200], [3e-320, 0.0, 0.0]]))
    q, s, norm, err = embeddings.quantised(u)
    assert np.isfinite(u).all() and np.isfinite(s).all() and (np.abs(q.astype(float) * s[:, None] - u) <= err[:, None] + 1e-12).all()


def test_tile_of_close_vectors_in_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(2)
    x = embeddings.unit(1 + 0.01 * rng.normal(size=(1024, 256)))
    tracemalloc.start()
    i, j, tried = embeddings.tile(x, x, 0.98)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # all pairs at once would take 2 * 2**20 * 256 * 8 bytes
    assert len(i) == tried == 1024 * 1024 and peak < 300e6
    assert (x @ x.T >= 0.98).sum() == len(i)


def test_a_node_of_very_many_edges_is_split(spark):
    from pyspark.sql import functions as F

    from methlake.llm import components as K

    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in confs}
    star = spark.range(1, 100_001).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
    few = spark.range(200_000, 200_400).select(F.col("id").alias("u"), (F.col("id") + 1000).alias("v"))
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        df = K._star(star.unionByName(few).repartition(16))
        assert len(df.collect()) == 100_400
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert components(star.unionByName(few), "u", "v").where("component = 0").count() == 100_001
