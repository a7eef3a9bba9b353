"""Language identification by interpolated Kneser-Ney character models.

One model of order 4 for each language, fitted on a bounded sample of labelled texts. The models share sorted arrays of n-gram hashes, one
for each order, with a column of log probabilities (and one of log back-off weights for contexts) per language. A text goes to the
language with the lowest cross-entropy per character; it is rejected if that is implausibly high for the language, by limits calibrated on labelled texts
that the models have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_bucket, released, tidy, written
from .shingles import mix

ORDER, PAD, SPACE = 4, 1, 32
#: texts per language, at most, that models are fitted on (seven eighths) and calibrated on (one eighth)
SAMPLE = 1200
#: share of the held-out texts of a length class that the rejection limit accepts, and the classes' bounds in characters
QUANTILE, LENGTHS = 0.995, (64, 256, 1024)
#: no limit is tighter than FLOOR[0] + FLOOR[1] / sqrt(characters) nats a character above the mean: a class may have few held-out texts
FLOOR = (0.25, 4.0)

_table: list[np.ndarray] = []


def alphabet() -> np.ndarray:
    """Code point (below 65536) -> lower-case letter, or SPACE for all that is no letter; PAD stays."""
    if not _table:
        t = np.full(65536, SPACE, np.uint16)
        for c in range(65536):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                t[c] = ord(low) if len(low) == 1 and ord(low) < 65536 else c
        t[PAD] = PAD
        _table.append(t)
    return _table[0]


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(letters with runs of other characters as one SPACE, text's index) of all texts, each after ORDER-1 pads.

    Letters beyond the basic plane are folded into the private-use area.
    """
    pads = chr(PAD) * (ORDER - 1)
    raw = np.frombuffer("".join(pads + (t or "") for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    of = np.repeat(np.arange(len(texts)), [len(t or "") + ORDER - 1 for t in texts])
    low = alphabet()[np.minimum(raw, 65535)]
    far = np.flatnonzero(raw > 65535)
    if len(far):
        letter = np.array([chr(c).isalpha() for c in raw[far].tolist()], bool)
        low[far] = np.where(letter, 0xE000 + raw[far] % 0x1900, SPACE)
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != SPACE) | ((low[:-1] != SPACE) & (low[:-1] != PAD))
    return low[keep], of[keep]


def grams(c: np.ndarray) -> np.ndarray:
    """The n-grams of order ORDER that end at each place (the first ORDER-1 places wrap and are never used: they are pads)."""
    key = c.astype(np.uint64)
    out = key.copy()
    for k in range(1, ORDER):
        out[k:] |= key[:-k] << np.uint64(16 * k)
    return out


class HashArray:
    """Sorted 64-bit hashes, found through an index on their leading bits."""

    def __init__(self, keys: np.ndarray):
        h = mix(keys)
        self.order = np.argsort(h)
        self.hash = h[self.order]
        self.bits = max(1, int(np.ceil(np.log2(max(2, len(h))))) + 1)
        self.start = np.searchsorted(self.hash >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys in the sorted array, -1 where absent."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.hash) or not len(keys):
            return out
        h = mix(keys)
        bucket = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.start[bucket], self.start[bucket + 1]
        hit = self.hash[np.minimum(at, len(self.hash) - 1)] == h
        out[hit] = at[hit]
        rest = np.flatnonzero(~hit & (at + 1 < end))
        at, end, h = at[rest] + 1, end[rest], h[rest]
        while len(rest):
            hit = self.hash[at] == h
            out[rest[hit]] = at[hit]
            more = ~hit & (at + 1 < end)
            rest, at, end, h = rest[more], at[more] + 1, end[more], h[more]
        return out


class _Counts:
    """One language's n-gram and continuation counts with Kneser-Ney weights."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, letters: int):
        self.letters = letters
        self.level = {}
        for n in range(ORDER, 0, -1):
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order].astype(float)
            ones, twos = (counts == 1).sum(), (counts == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.75
            ctx, start = np.unique(keys >> np.uint64(16), return_index=True)
            total, kinds = np.add.reduceat(counts, start), np.diff([*start, len(keys)])
            self.level[n] = keys, counts, discount, ctx, total, discount * kinds / total
            if n > 1:
                keys, counts = np.unique(keys & np.uint64((1 << 16 * (n - 1)) - 1), return_counts=True)

    @staticmethod
    def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def backoff(self, n: int, ctx: np.ndarray) -> np.ndarray:
        _, _, _, known, _, weight = self.level[n]
        at, has = self._at(known, ctx)
        return np.where(has, weight[at], 1.0)

    def probability(self, n: int, keys: np.ndarray) -> np.ndarray:
        if n == 0:
            return np.full(len(keys), 1.0 / self.letters)
        mine, counts, discount, known, total, _ = self.level[n]
        lower = self.probability(n - 1, keys & np.uint64((1 << 16 * (n - 1)) - 1))
        at, has = self._at(mine, keys)
        c, ctx_has = self._at(known, keys >> np.uint64(16))
        own = np.where(has & ctx_has, np.maximum(counts[at] - discount, 0) / total[c], 0.0)
        return own + self.backoff(n, keys >> np.uint64(16)) * lower


@dataclass
class Model:
    """Shared hash arrays of all languages. means: each language's cross-entropy on held-out texts; margins: the greatest excess accepted, by length class.

    Without held-out texts only what is worse than a uniform distribution over the letters is rejected.
    """

    languages: list[str]
    arrays: dict[int, HashArray]
    logp: dict[int, np.ndarray]
    contexts: dict[int, HashArray]
    logb: dict[int, np.ndarray]
    floor: float
    sharpness: float = 1.0
    means: np.ndarray | None = None
    margins: np.ndarray | None = None

    def allowed(self, n: np.ndarray) -> np.ndarray:
        """Nats per character above the language's mean up to which a text of n characters is accepted."""
        return np.maximum(self.margins[np.searchsorted(LENGTHS, n, side="right")], FLOOR[0] + FLOOR[1] / np.sqrt(np.maximum(n, 1)))

    def log_probabilities(self, keys: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Natural log of the probability of each n-gram's last character in each language."""
        if n == 0:
            return np.full((len(keys), len(self.languages)), self.floor, np.float32)
        at = self.arrays[n].find(keys)
        out = self.logp[n][at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            k = keys[miss]
            c = self.contexts[n].find(k >> np.uint64(16))
            back = np.where((c >= 0)[:, None], self.logb[n][c], 0) if len(self.logb[n]) else 0
            out[miss] = back + self.log_probabilities(k & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nats per character [texts, languages], characters, whether a letter is among them)."""
        c, of = codes(texts)
        keys = grams(c)
        real = c != PAD
        letter = np.bincount(of[real & (c != SPACE)], minlength=len(texts)) > 0
        keys, of = keys[real], of[real]
        n = np.bincount(of, minlength=len(texts))
        out = np.zeros((len(texts), len(self.languages)))
        for at in range(0, len(keys), 1 << 18):
            logs, o = self.log_probabilities(keys[at : at + (1 << 18)]), of[at : at + (1 << 18)]
            start = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]]))
            out[o[start]] -= np.add.reduceat(logs, start, axis=0, dtype=float)
        return out / np.maximum(n, 1)[:, None], n, letter

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, nats per character, accepted) of each text."""
        if not self.languages:
            zero = np.zeros(len(texts))
            return ["und"] * len(texts), zero, zero, zero > 0
        h, n, letter = self.entropies(texts)
        best = h.argmin(1)
        own = h[np.arange(len(h)), best]
        share = 1 / np.exp(-self.sharpness * np.minimum(n, 200)[:, None] * (h - own[:, None])).sum(1)
        over = (own - self.means[best]) / self.allowed(n)
        score = np.where(letter, share * np.exp(-3 * np.maximum(over - 1 / 3, 0)), 0.0)
        names = [self.languages[b] if ok else "und" for b, ok in zip(best.tolist(), letter.tolist())]
        return names, score, own, letter & (over <= 1)


def _counted(sample: DataFrame) -> DataFrame:
    """(lang, key, n): n-gram counts of order ORDER of a sample of (lang, text), summed per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            for x in sorted(set(lang.tolist())):
                c, _ = codes([t for t, y in zip(texts, lang) if y == x])
                key, n = np.unique(grams(c)[c != PAD], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([x] * len(key), pa.string()), pa.array(key.view(np.int64)), pa.array(n)], ["lang", "key", "n"])

    return sample.select("lang", "text").mapInArrow(tidy(run), "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Models for the languages of docs' rows where the column ``train`` holds and text and lang are not null.

    A bounded sample is read: of each language about ``sample`` texts, chosen by a hash of the id. Whole texts are used. Without
    labelled texts the model has no language and predicts ``und``.
    """
    spark = docs.sparkSession
    rows = docs.where(train & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    sizes = rows.groupBy(F.col(lang_col).alias("lang")).count()
    cuts = sizes.select("lang", F.least(F.lit(1.0), sample / F.col("count")).alias("share")).collect()
    shares = F.create_map(*[F.lit(x) for r in cuts for x in (r["lang"], r["share"])]) if cuts else F.create_map()
    place = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20))
    picked = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), place.alias("place")).where(F.col("place") < shares[F.col("lang")] * (1 << 20)) if cuts else rows.limit(0).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), place.alias("place"))
    picked = written(picked, "langsample")
    held = F.pmod(F.xxhash64("place"), F.lit(8)) == 0
    table = _counted(picked.where(~held)).toPandas()
    languages = sorted(table["lang"].unique())
    model = _built(languages, {x: (g["key"].to_numpy(np.int64).view(np.uint64), g["n"].to_numpy()) for x, g in table.groupby("lang")})
    if languages:
        _calibrate(model, picked.where(held), spark)
    return model


def _built(languages: list[str], tables: dict) -> Model:
    letters = len(np.unique(np.concatenate([t[0] & np.uint64(0xFFFF) for t in tables.values()]))) + 1 if tables else 1
    parts = [_Counts(*tables[x], letters) for x in languages]
    arrays, logp, contexts, logb = {}, {}, {}, {}
    for n in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([p.level[n][0] for p in parts])) if parts else np.empty(0, np.uint64)
        ctx = np.unique(keys >> np.uint64(16))
        arrays[n], contexts[n] = HashArray(keys), HashArray(ctx)
        logp[n] = np.array([np.log(p.probability(n, keys)) for p in parts], np.float32).T[arrays[n].order] if parts else np.empty((0, 0), np.float32)
        logb[n] = np.array([np.log(p.backoff(n, ctx)) for p in parts], np.float32).T[contexts[n].order] if parts else np.empty((0, 0), np.float32)
    return Model(languages, arrays, logp, contexts, logb, float(np.log(1 / letters)))


def _calibrate(model: Model, held: DataFrame, spark: SparkSession) -> None:
    """Sets the limits and the sharpness of the scores from texts the models were not fitted on (a bounded sample)."""
    shared = spark.sparkContext.broadcast(model)
    width = len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n, _ = shared.value.entropies(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(h.tolist(), pa.list_(pa.float64()))], ["lang", "n", "h"])

    seen = held.select("lang", "text").mapInArrow(tidy(run), "lang string, n long, h array<double>").where("n > 0").toPandas()
    model.means, model.margins = np.zeros(width), np.full(len(LENGTHS) + 1, -model.floor)
    if not len(seen):
        return
    h = np.array(seen["h"].tolist())
    index = {x: i for i, x in enumerate(model.languages)}
    known = seen["lang"].isin(index)
    h, n, y = h[known], seen["n"].to_numpy()[known], seen["lang"][known].map(index).to_numpy()
    if len(y):
        own = h[np.arange(len(y)), y]
        mean = [np.average(own[y == k], weights=np.minimum(n[y == k], 2000)) if (y == k).any() else np.nan for k in range(width)]
        model.means = np.where(np.isnan(mean), np.nanmax(mean), mean)
        over, group = own - model.means[y], np.searchsorted(LENGTHS, n, side="right")
        model.margins = np.array([np.quantile(over[group == k], QUANTILE, method="higher") if (group == k).any() else 0.0 for k in range(len(LENGTHS) + 1)])
    best = (np.inf, 1.0)
    for s in np.geomspace(0.01, 1, 13):
        z = -s * np.minimum(n, 200)[:, None] * (h - h.min(1, keepdims=True))
        loss = (np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]).mean() if len(y) else 0
        best = min(best, (float(loss), float(s)))
    model.sharpness = best[1]


PREDICTED = "lang_pred string, score double, cross_entropy double, accepted boolean"


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, name: str = "langid") -> DataFrame:
    """The columns ``keep`` of docs (all by default) with the struct column ``name``: lang_pred, score (0 to 1), cross_entropy, accepted.

    Null texts and texts without a letter are ``und`` with score 0 and not accepted. Each row is judged alone, by its text only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("accepted", pa.bool_())])

    from pyspark.sql.functions import arrow_udf

    @arrow_udf(PREDICTED)
    def judge(texts: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, max(1, len(texts)), 250):
            part = texts.slice(at, 250).to_pylist()
            names, score, h, ok = shared.value.predict(part)
            parts.append(pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(h, pa.float64()), pa.array(ok, pa.bool_())], fields=list(kind)))
        released()
        return pa.concat_arrays(parts)

    columns = [docs[f"`{c}`"] for c in (keep if keep is not None else docs.columns)]
    return docs.select(*columns, judge(docs[f"`{text_col}`"].cast("string")).alias(name))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> predicted language of each; one third of the ids is held out of the fit."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, id_bucket("doc_id", 3) != 1)
    return identify(docs, model, keep=["doc_id"]).select("doc_id", (id_bucket("doc_id", 3) == 1).alias("held_out"), "langid.lang_pred", "langid.score", "langid.accepted")
