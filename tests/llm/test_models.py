"""Language identification, toxicity, wrappers, Matroska and the pipeline."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from methlake.llm import langid, matroska, toxicity, wrappers
from methlake.llm.common import written

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
EDGE = [(1, None, None), (2, "", "en"), (3, "123 !?", "en"), (4, "the with and of that " * 20_000, None), (5, "the of and", "en"), (5, "the of and", "en"), (None, "der die das und", "de")]


def edge(spark, more=()):
    return spark.createDataFrame([*EDGE, *more], "doc_id long, text string, lang string").withColumns({"langid": F.lit(1), "toxicity": F.lit("t"), "score": F.lit(0.5), "key": F.lit(b"z")})


def test_kneser_ney_sums_to_one():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcd ") for _ in range(300)) for _ in range(5)]
    c, _ = langid.codes(texts)
    key, n = np.unique(langid.grams(c)[c != langid.PAD], return_counts=True)
    letters = sorted({*"abcd "})
    counts = langid._Counts(key, n, len(letters))
    for ctx in ("abc", "a b", "ddd", " ab", "zzz", "bzz"):
        keys = np.array([sum(ord(x) << 16 * (3 - k) for k, x in enumerate(ctx + w)) for w in letters], np.uint64)
        assert counts.probability(4, keys).sum() == pytest.approx(1)
    # the shared arrays give what the counts give, for n-grams seen, unseen, and of unseen contexts
    model = langid._built(["x"], {"x": (key, n)})
    probe = np.array([sum(ord(x) << 16 * (3 - k) for k, x in enumerate(g)) for g in ("abcd", "abca", "zzza", "azza", "dddd", " ab ")], np.uint64)
    want = _Shift(counts, model).log(probe)
    assert np.allclose(model.log_probabilities(probe)[:, 0], want, atol=1e-5)


class _Shift:
    """Counts with the model's alphabet size (which holds one more letter for the unseen)."""

    def __init__(self, counts, model):
        self.c = counts
        self.c.letters = round(1 / np.exp(model.floor))

    def log(self, keys):
        return np.log(self.c.probability(4, keys))


def test_codes_fold_and_collapse():
    c, of = langid.codes(["Äb, 12\n C", None, "😀𝒳"])
    assert "".join(map(chr, c[of == 0][3:])) == "äb c" and len(c[of == 1]) == 3 and len(c[of == 2]) == 3 + 1


def test_hash_array():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**40, 5000, dtype=np.uint64))
    a = langid.HashArray(keys)
    at = a.find(keys)
    assert (keys[a.order][at] == keys).all() and (a.find(keys + np.uint64(2**41)) == -1).all()
    assert (langid.HashArray(keys[:0]).find(keys[:3]) == -1).all()


def plain_kneser_ney(texts, letters):
    """Interpolated Kneser-Ney from dictionaries: text -> nats per character."""
    pad = chr(langid.PAD) * 3
    level = {4: Counter(t[i - 3 : i + 1] for t in (pad + x for x in texts) for i in range(3, len(t)))}
    for n in (3, 2, 1):
        level[n] = Counter(g[1:] for g in level[n + 1])  # how many letters stand before
    discount, total, kinds = {}, {}, {}
    for n, c in level.items():
        ones, twos = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        discount[n] = ones / (ones + 2 * twos) if ones and twos else 0.75
        total[n], kinds[n] = Counter(), Counter()
        for g, v in c.items():
            total[n][g[:-1]] += v
            kinds[n][g[:-1]] += 1

    def p(g):
        n = len(g)
        if not n:
            return 1 / letters
        t = total[n][g[:-1]]
        return max(level[n][g] - discount[n], 0) / t + discount[n] * kinds[n][g[:-1]] / t * p(g[1:]) if t else p(g[1:])

    return lambda text: -sum(math.log(p((pad + text)[i - 3 : i + 1])) for i in range(3, len(text) + 3)) / len(text)


def test_entropies_against_plain_models():
    """Languages are told by the models that dictionaries give."""
    rows = duckdb.sql(f"select lang, text from '{SF}/documents.parquet' where lang is not null and text is not null order by doc_id").fetchall()
    clean = lambda t: "".join(map(chr, langid.codes([t])[0][3:]))
    by = {}
    for lang, t in rows[:120]:
        by.setdefault(lang, []).append(t)
    tables = {}
    for lang, texts in by.items():
        c, _ = langid.codes(texts)
        tables[lang] = np.unique(langid.grams(c)[c != langid.PAD], return_counts=True)
    model = langid._built(sorted(by), tables)
    letters = len({ch for texts in by.values() for t in texts for ch in clean(t)}) + 1
    plain = [plain_kneser_ney([clean(t) for t in by[x]], letters) for x in sorted(by)]
    probe = [t for _, t in rows[120:140]] + ["x", "the of and der die das", "Ω unseen Ж"]
    got, n, _ = model.entropies(probe)
    for k, t in enumerate(probe):
        assert n[k] == len(clean(t)) and np.allclose(got[k], [f(clean(t)) for f in plain], atol=1e-4)


def test_langid_accuracy(spark):
    got = langid.op3_langid(spark, SF2).toPandas()
    lang = duckdb.sql(f"select doc_id, lang from '{SF2}/documents.parquet'").df()
    m = got.merge(lang, on="doc_id")
    assert len(m) == len(got) == 1000 and m.score.between(0, 1).all()
    held = m[m.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98 and held.accepted.mean() > 0.99
    assert (held.held_out == held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()


def test_langid_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs, F.lit(True))
    rows = langid.identify(edge(spark), model, name="__l").select("doc_id", "langid", "__l.*").collect()
    assert len(rows) == len(EDGE)
    by = {r.doc_id: r for r in rows}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 and not by[k].accepted for k in (1, 2, 3))
    assert by[4].lang_pred == "en" and by[None].lang_pred == "de"
    none = langid.fit(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.identify(edge(spark), none, name="__l").select("__l.*").collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_langid_rejects_noise(spark):
    model = langid.fit(spark.read.parquet(f"{SF2}/documents.parquet"), F.lit(True))
    names, score, h, ok = model.predict(["qzxjvk wqxzkj vvqzx kjqwx" * 40])
    assert not ok[0] or score[0] < 0.6


def test_langid_limits(spark):
    """Noise and an unlearned language are rejected at all lengths, held-out texts stay."""
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    train = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    held = docs.where(~train).select("lang", "text").toPandas()
    noise = "qzxjvk wqxzkj vvqzx kjqwx" * 40
    for lost in ("es", "fr"):
        model = langid.fit(docs.where(F.col("lang") != lost), train)
        assert lost not in model.languages
        assert not model.predict([noise, noise[:200], noise[:50], noise[:20]])[3].any()
        foreign = [t for t in held.text[held.lang == lost] if t and len(t) >= 20]
        assert len(foreign) >= 25 and model.predict(foreign)[3].mean() < 0.05
        known = held.text[held.lang != lost].tolist()
        assert model.predict(known)[3].mean() > 0.98


@pytest.mark.parametrize("common,weak", [(1 / 16, 1 / 3), (0.0, 2.0), (2.0, 0.0)])
def test_block_max_is_exact(monkeypatch, common, weak):
    """Against all cosines, with some, all and none of the terms kept as block columns."""
    monkeypatch.setattr(toxicity, "COMMON", common)
    monkeypatch.setattr(toxicity, "WEAK", weak)
    rng = np.random.default_rng(3)
    worth = rng.random(80) * (rng.random(80) < 0.9)
    dense = rng.random((400, 80)) * (rng.random((400, 80)) < np.linspace(0.01, 0.5, 80)) * worth
    dense[7] = dense[300]
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    e, t = np.nonzero(dense)
    index = toxicity.BlockMaxIndex(t, e, dense[e, t], 400, 80, worth)
    some = np.flatnonzero(e < 90)
    got, c = index.nearest(t[some], e[some], dense[e[some], t[some]], 90, 7, np.arange(90))
    s = dense[:90] @ dense.T
    s[np.arange(90), np.arange(90)] = 0
    for k in range(90):
        want = np.lexsort((np.arange(400), -np.round(s[k], 5)))[:7]
        assert np.allclose(c[k], s[k][want], atol=3e-5) and np.allclose(s[k][got[k]], s[k][want], atol=3e-5)
    none = toxicity.BlockMaxIndex(*[np.empty(0, int)] * 2, np.empty(0), 0, 3, np.zeros(3))
    assert none.nearest(np.array([1]), np.array([0]), np.array([1.0]), 2, 5)[0].shape == (2, 0)


def test_toxicity_against_plain_cosines(spark):
    """The query's neighbours and scores, from dictionaries of words."""
    docs = duckdb.sql(f"select d.doc_id, text, toxic from '{SF}/documents.parquet' d left join '{SF}/labels.parquet' l on l.doc_id = d.doc_id order by 1").fetchall()
    got = {r.doc_id: r for r in toxicity.op6_toxicity(spark, SF).collect()}
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    known = [(i, t, y) for i, t, y in docs if y is not None and zlib.crc32(str(i).encode()) % 5]
    assert set(model.example_ids.tolist()) <= {i for i, _, _ in known}
    known = [x for x in known if x[0] in set(model.example_ids.tolist())]

    def bag(text):
        ws = re.findall("[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
        return Counter([w.encode() for w in ws] + [(k, w.encode()[:k]) for w in ws for k in (4, 5, 6) if len(w.encode()) >= k])

    bags = [(i, bag(t), y) for i, t, y in known]
    n, bad = len(bags), sum(y for *_, y in bags)
    df = Counter(x for _, b, _ in bags for x in b)
    worse = Counter(x for _, b, y in bags if y for x in b)

    def worth(x):
        a, c = worse[x], df[x] - worse[x]
        cells = [(a, df[x], bad), (c, df[x], n - bad), (bad - a, n - df[x], bad), (n - bad - c, n - df[x], n - bad)]
        return (math.log((n + 1) / (df[x] + 1)) + 1) * math.sqrt(max(0, 2 * sum(v * math.log(v * n / (r * k)) for v, r, k in cells if v)))

    worths = {x: worth(x) for x in df}

    def vector(b):
        v = {x: (1 + math.log(m)) * worths[x] for x, m in b.items() if worths.get(x, 0) > 0}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {x: w / norm for x, w in v.items()} if norm else {}

    vectors = [(i, vector(b)) for i, b, _ in bags]
    for i, t, _ in docs[::4]:
        q = vector(bag(t))
        cos = sorted((round(sum(w * v.get(x, 0) for x, w in q.items()), 5) for _, v in vectors), reverse=True)[:15]
        assert np.allclose(got[i].nearest_cosines, [c for c in cos if c > 0], atol=5e-5)
        by = dict(vectors)
        assert np.allclose([sum(w * by[e].get(x, 0) for x, w in q.items()) for e in got[i].nearest_examples], got[i].nearest_cosines, atol=5e-5)


def test_toxicity_held_out(spark):
    got = toxicity.op6_toxicity(spark, SF2).toPandas()
    y = duckdb.sql(f"select doc_id, toxic from '{SF2}/labels.parquet'").df()
    assert len(got) == 1000 and got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    m = got.merge(y, on="doc_id")
    clean, bad = m[m.toxic == 0], m[m.toxic == 1]
    assert clean.predicted.mean() < 0.01 and bad.predicted.mean() > 0.95
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    used = {e for x in got.nearest_examples for e in x}
    assert used and not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in used)


def test_toxicity_edges(spark):
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"]
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choices(words, k=30)) + (" vileword" if k % 2 else "")) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, "x") for k in range(60)] + [(3, 0, "x"), (61, None, "x"), (None, 1, "x"), (999, 1, "x")], "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, labels, F.lit(True))
    out = {r.doc_id: r for r in toxicity.judge(docs, model, name="__t").select("doc_id", "__t.*").collect()}
    assert all((out[k].score >= 0.5) == bool(k % 2) for k in range(80)) and len(out[79].examples) == len(out[79].cosines) > 0
    e = toxicity.judge(edge(spark), model, name="__t").select("doc_id", "toxicity", "__t.*").collect()
    assert len(e) == len(EDGE) and all(r.score < 0.5 and r.examples == [] for r in e)
    none = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in toxicity.judge(edge(spark), none, name="__t").select("__t.*").collect()} == {0.0}
    assert toxicity.judge(docs.limit(0), model).count() == 0


def page(title, paragraphs, k, extra=""):
    body = "".join(f"<p>{p}</p>" if i % 3 else f"<p><b>{p}<br>" for i, p in enumerate(paragraphs))
    menu = "".join(f'<li><a href="/{j}">m{j * k}</a></li>' for j in range(2 + k % 4))
    return f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t="</p>";</script></head><body><header class="site-header"><h2>Site {k}</h2></header><nav><ul>{menu}</ul></nav><!-- c --><div class="ad banner">Buy {k}!</div><div class="content"><h1>{title}</h1>{body}{extra}</div><aside>side {k}</aside><div id="comments"><p>nice {k}</p></div><form><input name="q"><button>go</button></form><footer>&copy; {k}</footer>'


def test_wrappers(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefg&é") for _ in range(5))
    rows, want = [], {}
    for k in range(60):
        paragraphs = [" ".join(word() for _ in range(8)) for _ in range(1 + k % 5)]
        from html import escape

        shown = [escape(p) for p in paragraphs]
        rows.append((k, f"https://Host{k % 3}.example/{k}", page(f"T {k}", shown, k, "<table><tr><td>x  1</td><td>y\n2</td></tr></table>" if k % 7 == 0 else "")))
        want[k] = "\n".join([f"T {k}", *paragraphs] + (["x 1", "y 2"] if k % 7 == 0 else []))
    rows += [(100, "nourl", None), (101, None, ""), (102, "https://one.example/", "plain text &amp; more"), (103, "https://one.example/", "<p>a<p>b"), (59, rows[59][1], rows[59][2])]
    pages = spark.createDataFrame([(*r, "x", "h") for r in rows], "page_id long, url string, html string, host string, wrapper string")
    out = wrappers.extract(pages).collect()
    assert len(out) == len(rows)
    by = {r.page_id: r for r in out}
    for k, t in want.items():
        assert by[k].text == t and by[k].n_chars == len(t)
    assert by[100].text == "" and by[101].text == "" and by[102].text == "plain text & more" and by[103].text == "a\nb"
    table = wrappers.learn_hosts(pages)
    keep, wrappers.BROADCAST = wrappers.BROADCAST, 0
    try:
        assert sorted((r.page_id, r.text) for r in wrappers.extract(pages).collect()) == sorted((r.page_id, r.text) for r in out)
    finally:
        wrappers.BROADCAST = keep
    assert table.count() >= 4 and wrappers.extract(pages.limit(0)).count() == 0


def test_wrapper_template_is_confirmed(spark):
    """A lead line that only the sampled pages share stays, on them and on all others; the template's own line goes; an article wins on its page."""
    ids = spark.range(40).selectExpr("id page_id", "concat('https://one.example/', id) url")
    least = {}
    for r in ids.selectExpr("page_id", "xxhash64(page_id, url) h", f"pmod(xxhash64(page_id, url), {wrappers.SAMPLE}) slot").collect():
        least[r.slot] = min(least.get(r.slot, (r.h, r.page_id)), (r.h, r.page_id))
    sampled = {i for _, i in least.values()}
    assert 4 <= len(sampled) < 20
    other = max(set(range(40)) - sampled)
    rows, want = [], {}
    for k in range(40):
        lead = "The usual lead" if k in sampled else f"Lead {k}"
        body = f"<div class='content'><h1>T{k}</h1><p>{lead}</p><p>A{k}</p><p>B{k}</p><p>C{k}</p><p>D{k}</p><p>All rights reserved</p></div>"
        want[k] = "\n".join([f"T{k}", lead, f"A{k}", f"B{k}", f"C{k}", f"D{k}"])
        if k == other:
            body = f"<article><p>Own {k}</p></article><div class='content'><p>teaser</p></div>"
            want[k] = f"Own {k}"
        rows.append((k, f"https://one.example/{k}", f"<html><body><nav>menu</nav>{body}</body></html>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrappers.extract(pages).collect()} == want
    keep, wrappers.BROADCAST = wrappers.BROADCAST, 0
    try:
        assert {r.page_id: r.text for r in wrappers.extract(pages).collect()} == want
    finally:
        wrappers.BROADCAST = keep


def neutral(k, names, rng):
    """(page, article) of a host with one template whose class names say nothing: menu and footer are constant, articles differ."""
    say = lambda n: " ".join(rng.choice(["over", "the", "hill", "stone", "river", "late", "green", "walk"]) + str(rng.randrange(99)) for _ in range(n))
    parts = [say(rng.randint(4, 9)) for _ in range(1 + k % 4)]
    body = "".join(f"<p>{x}</p>" for x in parts) + "<p>Price: <b>" + str(k) + "</b></p>"
    menu = "".join(f"<li><a href='/{m}'>{m}</a></li>" for m in ("Home", "About us"))
    page = f"<html><body><div class='{names[0]}'><ul>{menu}</ul></div><div class='{names[1]}'><h1>Title {k}</h1>{body}</div><div class='{names[2]}'>Copyright Example Ltd<br>all rights reserved</div></body></html>"
    return page, "\n".join([f"Title {k}", *parts, f"Price: {k}"])


def test_wrapper_decides_without_names(spark):
    """The template's texts are known by being the same on all pages, not by class names; copies of one page show nothing."""
    rng = random.Random(9)
    made = [neutral(k, ("x1", "x2", "x3"), rng) for k in range(8)]
    w = wrappers.Wrapper(json.loads(json.dumps(wrappers.learn([p for p, _ in made]))))
    assert [w.extract(wrappers.tokens(p)) for p, _ in made] == [t for _, t in made]
    assert {"Home", "About us", "Copyright Example Ltd", "all rights reserved"} <= {t for _, t in w.template}
    alike = [made[0][0].replace("Price: <b>0", f"Price: <b>{k}") for k in range(8)]
    assert wrappers.learn(alike)["template"] == [] and wrappers.learn([p for p, _ in made[:3]])["template"] == []
    rows = [(k, f"https://a.example/{k}", *neutral(k, ("x1", "x2", "x3"), rng)) for k in range(60)]
    rows.append((60, "https://a.example/60", "<html><body><div><p>odd</p></div><table><tr><td>page</td></tr></table></body></html>", "odd\npage"))
    rows.append((61, "https://a.example/61", "<div><p>" + "long words " * 60_000 + "</p></div>", " ".join(["long words"] * 60_000)))
    got = wrappers.extract(spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {r[0]: r[3] for r in rows}


def test_wrapper_groups():
    a, b = wrappers.tokens("<ul><li>a</li><li>b</li></ul><p>x</p>"), wrappers.tokens("<ul><li>a</li><li>b</li><li>c</li></ul><i>o</i><p>y</p>")
    w = wrappers.align(wrappers._as_nodes(a), b)
    assert any(isinstance(x, list) and x[0] == wrappers.MANY for x in w) and any(isinstance(x, list) and x[0] == wrappers.MAYBE for x in w)
    assert all(wrappers.read(w, s, 0) == len(s) for s in (a, b))


def test_matroska_round_trip():
    rng = random.Random(1)
    for n in (1, 64, 1000, 1024, 1025, 8192, 8200, 131072, 140001):
        data = rng.randbytes(n)
        m = matroska.mux(data)
        f = matroska.parse(m)
        assert b"".join(m[a:b] for _, _, a, b, *_ in f["packets"]) == data
        assert len(f["cues"]) == f["clusters"] and f["tracks"][1]["codec"] == "A_PCM/INT/LIT" and f["tracks"][1]["depth"] == 8
        assert [p[1] for p in f["packets"][:: matroska.LACED]] == [k * 1024 * 1000 // 8000 for k in range(0, -(-n // 1024), matroska.LACED)]


def test_matroska_lacings_and_unknown_sizes():
    e, v = matroska.element, matroska.vint
    frames = [b"a" * 300, b"b" * 20, b"c" * 5]
    xiph = b"\x81\x00\x05\x02" + bytes([2, 255, 45, 20]) + b"".join(frames)
    signed = b"\x82\xff\xff\x06" + bytes([2]) + v(300) + (20 - 300 + 8191 | 0x4000).to_bytes(2, "big") + b"".join(frames)
    fixed = b"\x81\x00\x06\x84" + bytes([1]) + b"xxyy"
    cluster = bytes.fromhex("1f43b675") + b"\x01" + b"\xff" * 7 + e(matroska.TIME, b"\x64") + e(matroska.SIMPLE, xiph) + e(matroska.GROUP, e(matroska.BLOCK, signed)) + e(matroska.VOID, b"zz")
    after = e(matroska.CLUSTER, e(matroska.TIME, b"\xc8") + e(matroska.SIMPLE, fixed))
    data = matroska._HEAD + bytes.fromhex("18538067") + b"\xff" + matroska._TRACKS + cluster + after
    f = matroska.parse(data)
    assert [data[a:b] for _, _, a, b, *_ in f["packets"]] == [*frames, *frames, b"xx", b"yy"]
    assert [(p[0], p[1]) for p in f["packets"]] == [(1, 105)] * 3 + [(2, 99)] * 3 + [(1, 206)] * 2
    for cut in (3, 60, len(data) - 3):
        with pytest.raises(matroska.Broken):
            matroska.parse(data[:cut])
    with pytest.raises(matroska.Broken):
        matroska.parse(b"\x00" * 20)


def test_media_query(spark):
    texts = dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    for r in matroska.op5_matroska(spark, SF).collect():
        raw = texts[r.doc_id].encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    media = matroska.media_column(edge(spark))
    d = {r.doc_id: r for r in matroska.media_digests(media).collect()}
    assert d[1].payload_bytes == d[2].payload_bytes == 64 and d[1].media_sha256 == d[2].media_sha256 and d[1].feature == d[2].feature
    p = matroska.packets(media)
    assert p.count() == sum(r.packets for r in matroska.media_digests(media).collect())
    assert matroska.media_digests(matroska.media_column(edge(spark).limit(0))).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as C

    assert [n for n, _ in C.STAGES] == ["toxicity", "language", "near_duplicates", "repeated_strings", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, "same words here for all of us", "en", "s", 1), (9003, "same words here for all of us", "en", "s", 1)], docs.schema)).withColumns({"node": F.lit(1), "__x": F.lit("y")})
    n = [docs.count()]
    for name, stage in C.STAGES:
        before = docs
        docs = written(stage(spark, docs, SF), name)
        n.append(docs.count())
        if name != "packing":
            assert docs.columns == before.columns
            if name != "repeated_strings":
                assert docs.exceptAll(before).count() == 0
    assert n[0] >= n[1] > 0.8 * n[0] and n[2] > 0.95 * n[1] and n[3] < n[2] and n[4] == n[3]
    for name, stage in C.STAGES[:4]:
        assert stage(spark, before.limit(0), SF).count() == 0


def test_pipeline_on_planted_documents(spark, tmp_path):
    """Passages of 51 to 80 words that two documents share, near copies, toxic texts and a foreign script, among clean documents."""
    import corpus_pipeline as C
    import test_duplicates as D

    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{SF2}/labels.parquet'").fetchall())
    en = [(r.doc_id, r.text) for r in docs.where("lang = 'en' and n_chars between 600 and 3000").orderBy("doc_id").collect() if labels.get(r.doc_id) == 0]
    rng = random.Random(12)
    words = [w for _, t in en for w in t.split() if w.isalpha()]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [say(51 + k) for k in range(30)]
    rows, planted = [], {}
    for k, passage in enumerate(passages):
        for j in range(2):
            i = 10**6 + 2 * k + j
            rows.append((i, say(120) + " " + passage + " " + say(90), "en", "plant", 0))
            planted[i] = passage
    copies = {2 * 10**6 + k: D.edited(t, rng, 2) for k, t in enumerate([say(150) for _ in range(10)])}
    for k, t in list(copies.items()):
        rows += [(k, t, "en", "plant", 0), (k + 500, D.edited(t, rng, 3), "en", "plant", 0)]
    rows += [(3 * 10**6 + k, "漢字仮名交じり文" * 30, None, "plant", 0) for k in range(3)] + [(None, say(60), "en", "plant", 0)]
    rows += [(4 * 10**6, say(40), "en", "a", 0), (4 * 10**6, say(40), "en", "b", 0)]
    all_docs = docs.unionByName(spark.createDataFrame(rows, docs.schema)).repartition(4)
    out = {}
    now = all_docs
    for name, stage in C.STAGES[:4]:
        now = written(stage(spark, now, SF2), name)
        out[name] = {r.doc_id: r.text for r in now.collect()}
    toxic = {i for i, y in labels.items() if y}
    assert len(toxic - set(out["toxicity"])) > 0.95 * len(toxic) and len({i for i, y in labels.items() if not y} & set(out["toxicity"])) > 0.98 * sum(not y for y in labels.values())
    clean = {r[0] for r in rows if r[0] and r[0] < 3 * 10**6}
    assert len(clean & set(out["toxicity"])) >= 0.98 * len(clean)
    assert len(clean & set(out["language"])) >= 0.98 * len(clean & set(out["toxicity"])) and not any(3 * 10**6 + k in out["language"] for k in range(3))
    third = out["near_duplicates"]
    assert all(i in third and i + 500 not in third for i in copies if i in out["language"] and i + 500 in out["language"]) and all(i in third for i in planted if i in out["language"])
    least = min(t for i, t, *_ in rows if i == 4 * 10**6)
    assert None in third and third.get(4 * 10**6) == least
    last = out["repeated_strings"]
    assert set(last) == set(third)
    texts = list(third.values())
    want = D.brute_cut(texts, C.PASSAGE)
    for (i, t), (_, removed, _, kept) in zip(third.items(), want):
        assert last[i] == (kept.decode("utf-8", "ignore") if removed else t)
    caught = [passage not in last[i] and len(last[i]) < len(third[i]) - 0.9 * len(passage) for i, passage in planted.items() if i in last and i ^ 1 in last]
    assert len(caught) > 40 and all(caught)


@pytest.mark.parametrize("html, text", [
    ('<article><p>a <a href="x>link</a> tail</p><p>b</p></article>', "a link tail\nb"),
    ("<article><p>a <a href='x>link</a> tail</p><p class=\"c\">b</p></article>", "a link tail\nb"),
    ('<article><p>a <a title="1 > 0 <b>" href="?q=">link</a> &lt;i&gt;</p><img alt="" src=x><p data-x="">b</p></article>', "a link <i>\nb"),
    ('<article><p>say "one" and <a href="x>he said "two" again</a></p></article>', 'say "one" and he said "two" again'),
    ('<script src="a>var x = "<p>no</p>";</script><article><p>yes</p></article>', "yes"),
    ('<div class="article"><p>one two</p><div class="related-work"><p>Related work section</p></div><div class="share-price"><p>up</p></div><div class="related"><p>no</p></div><div class="site-footer">no</div></div>', "one two\nRelated work section\nup"),
    ("<main><article><p>Teaser</p></article><div><p>Real long text here</p></div></main>", "Teaser\nReal long text here"),
    ("<main><article><p>The article is long enough here</p></article><div><p>Short note</p></div></main>", "The article is long enough here"),
])
def test_article_of_odd_pages(html, text):
    """Quotes that nobody closed, class names that only begin like a layout's, and teasers in a main part."""
    assert wrappers.alone(wrappers.tokens(html)) == text


@pytest.mark.parametrize("body", ["81000002", "81000006", "8100000201ff", "8100000202ffffffff", "810000060140", "8100000601ff", "8100000605", "81000004", "810000040201020304", "8100", "810000020105", "810000060285bf85"])
def test_truncated_laces_are_broken(body):
    data = bytes.fromhex(body) + bytes.fromhex("01" * 40)
    with pytest.raises(matroska.Broken):
        matroska.block_frames(data, 0, len(body) // 2)


def test_matroska_fails_as_broken_only():
    """Cut or changed bytes are parsed or Broken, and nothing else."""
    rng = random.Random(12)
    whole = matroska.mux(rng.randbytes(3000))
    for _ in range(400):
        data = bytearray(whole)
        for _ in range(rng.randrange(1, 4)):
            data[rng.randrange(len(data))] = rng.randrange(256)
        try:
            matroska.parse(bytes(data[: rng.randrange(1, len(data) + 1)] if rng.random() < 0.5 else data))
        except matroska.Broken:
            pass
