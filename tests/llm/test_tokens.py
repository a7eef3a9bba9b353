"""Token files, packing and BPE against the libraries, on documents with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from methlake.llm import bpe, packing, token_files
from methlake.llm.common import new_path
from methlake.llm.wordcache import Encoder

SF = "/root/testdata/sf0.001"
EDGE = [(5, "a  b's\n\n c <|endoftext|> 漢字 ½ İx"), (1, None), (2, ""), (3, "the " * 30_000), (3, "other"), (7, "same"), (7, "same"), (None, "no id"), (9, "x\x85y\x1f z"), (4, "aaaa" * 400 + " %%%%%%%%")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, "k", 1, b"z") for i, t in EDGE], "doc_id long, text string, key string, part int, ids binary")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()


def want_ids(name, texts):
    t = Tokenizer.from_file(P.path(name))
    return [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name,words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_encoder_equals_library(name, words):
    e = Encoder(P.path(name), words, limit=50)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.text(st.sampled_from("ab 's\n\t,.1é½<|>İ漢 ß"), max_size=40), max_size=5))
    def check(texts):
        assert [x.tolist() for x in e.encode(texts)] == want_ids(name, texts)

    check()


@pytest.mark.parametrize("name,words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_added_tokens_are_the_librarys(name, words):
    added = [x.content for x in Tokenizer.from_file(P.path(name)).get_added_tokens_decoder().values()]
    texts = [f"a {x} b{x.upper()}c{x}" for x in added] + ["<|endoftext", "|>", "don't 'tis it's, 1st\t\n x" + "y" * 400 + ". z", "  a", "a  ", "\n\na", "café, naïve×2÷3"]
    assert [x.tolist() for x in Encoder(P.path(name), words).encode(texts)] == want_ids(name, texts)


def test_word_table_grows_and_finds():
    from methlake.llm.wordcache import WordTable

    t, rnd = WordTable("<u2"), np.random.default_rng(5)
    h = np.unique(rnd.integers(1, 2**63, 200_000).astype(np.uint64))
    h = np.concatenate([h, np.arange(1, 300, dtype=np.uint64)])  # 299 that want one slot
    rnd.shuffle(h)
    for at in range(0, len(h), 9000):
        part = h[at : at + 9000]
        t.add(part, np.full(len(part), 2), np.repeat(part.astype("<u2"), 2))
    entries = t.find(h)
    ids, n = t.gather(entries)
    assert (n == 2).all() and (ids == np.repeat(h.astype("<u2"), 2)).all()
    assert (t.find(np.array([2**63 + 5, 400], np.uint64)) < 0).all()


def test_token_files(spark, docs):
    got = token_files.op1_token_files(spark, SF).orderBy("doc_id").collect()
    start = 0
    for r, ids in zip(got, want_ids("byte_bpe_50k.json", [t for _, t in docs])):
        ids = [*ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert [r.doc_id for r in got] == [i for i, _ in docs]


def test_token_files_edges(spark, edge):
    folder = new_path(spark, "t")
    token_files.write_tokens(edge, folder, P.path("byte_bpe_50k.json"), 2)
    got = token_files.read_tokens(spark, folder).orderBy("start").collect()
    rows = sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    ids = want_ids("byte_bpe_50k.json", [t for _, t in rows])
    assert [(r.doc_id, r.n_tokens) for r in got] == [(i, len(x) + 1) for (i, _), x in zip(rows, ids)]
    empty = new_path(spark, "t")
    token_files.write_tokens(edge.limit(0), empty, P.path("byte_bpe_50k.json"), 2)
    assert token_files.read_tokens(spark, empty).count() == 0


def check_pieces(rows, want):
    by = {}
    for r in rows:
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    seen = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == seen.get(r.sequence_id, 0)
        seen[r.sequence_id] = r.offset + r.length
    assert sorted(seen) == list(range(len(seen)))
    assert all(n == 4096 for q, n in seen.items() if q != len(seen) - 1) and max(seen.values(), default=0) <= 4096
    assert sum(seen.values()) == sum(len(x) for x in want)


def test_packing(spark, docs):
    rows = packing.op2_packing(spark, SF).collect()
    want = {i: [*x, 2] for (i, _), x in zip(docs, want_ids("word_bpe_49k.json", [t for _, t in docs]))}
    check_pieces(rows, list(want.values()))
    for i, ids in want.items():
        at = 0
        for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_packing_edges(spark, edge):
    rows = packing.pack(edge, P.path("word_bpe_49k.json")).collect()
    check_pieces(rows, [[*x, 2] for x in want_ids("word_bpe_49k.json", [t for _, t in EDGE])])
    assert packing.pack(edge.limit(0), P.path("word_bpe_49k.json")).count() == 0
    assert packing.pack(edge.where("text = ''"), P.path("word_bpe_49k.json"), end_id=None).count() == 0


def test_hilbert_visits_neighbours():
    g = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    h = packing.hilbert(g, 3)
    assert sorted(h) == list(range(512))
    assert (np.abs(np.diff(g[np.argsort(h)], axis=0)).sum(1) == 1).all()


@pytest.fixture(scope="module")
def tik():
    ranks = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_equals_library(tik):
    codec = bpe.Codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.text(st.sampled_from("abcethrn %\n漢é😀'"), max_size=120), max_size=6))
    def check(texts):
        for t, (n, ids, raw) in zip(texts, codec.texts(texts)):
            want = tik.encode_ordinary(t)
            assert n == len(want) and ids.decode() == ",".join(map(str, want)) and raw == t.encode()

    check()
    hard = ["a" * 999, "ab" * 300, "%" * 50 + "=" * 33, " " * 300 + "x", "don't 'tis\t\nx  \n", "café, 1st ²×÷ª."]
    assert [x[1].decode() for x in codec.texts(hard)] == [",".join(map(str, tik.encode_ordinary(t))) for t in hard]
    # another pattern, which says nothing about where texts may be cut: whole texts
    other = r"\w+ \w+|\s+|."
    lib = tiktoken.Encoding("o", pat_str=other, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    texts = ["some more words here. and", "", "a b c d"]
    assert [x.tolist() for x in bpe.Codec(P.path("byte_bpe_multi_50k.tiktoken"), other).encode(texts)] == [lib.encode_ordinary(t) for t in texts]


def test_replay_lower_rank_after_merge():
    # bc ranks under ab's product with c: after "ab" merges, "abc" ranks lower than a second "ab"
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257, b"aba": 258}
    m = bpe.Merges(ranks)
    lib = tiktoken.Encoding("x", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    for t in ("abcab", "ababc", "abab", "aabcabab", "abaabcab"):
        assert m.replay([t.encode()])[0].tolist() == lib.encode_ordinary(t), t


def test_bpe_edges(spark, edge, tik):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(edge, path, P.PATTERN).collect())
    want = []
    for i, t in EDGE:
        ids = tik.encode_ordinary(t or "")
        want.append((i is not None, i or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    back = bpe.decode(bpe.encode(edge, path, P.PATTERN), path, P.PATTERN).collect()
    assert sorted(bytes(r.bytes) for r in back) == sorted((t or "").encode() for _, t in EDGE)
    assert bpe.round_trip(edge.limit(0), path, P.PATTERN).count() == 0
