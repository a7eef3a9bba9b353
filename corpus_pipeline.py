"""A corpus pipeline of five stages over documents: toxicity, language, near duplicates, repeated strings, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from methlake.llm import bagminhash, langid, packing, substrings, toxicity
from methlake.llm.common import written


#: bytes of a repeated string that the fourth stage takes out, and of its anchors: passages of over 50 words, at under five bytes a word with its space
PASSAGE, ANCHOR = 240, 64


def _columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*(df[f"`{c}`"] for c in like.columns))


# Every stage returns the columns of its docs, whatever others they have (names that start with two underscores are the stages' own), and an empty
# table for an empty table. Rows are judged by text; a null id is an id of its own in each row.


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic. Null and empty texts stay; repeated rows and rows with one text share their fate; very long texts are read whole."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = toxicity.judge(docs, toxicity.fit(docs, labels, F.lit(True)), name="__toxicity")
    return _columns(judged.where(F.col("__toxicity.score") < 0.5), docs)


def spoken(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus's languages. Null texts, texts without a letter and implausible ones go; without any labelled text all go."""
    judged = langid.identify(docs, langid.fit(docs, F.lit(True)), name="__langid")
    return _columns(judged.where("__langid.accepted"), docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each class of near duplicates. Null and empty texts are classes of their own and stay.

    Rows that repeat an id are one document: of these the row with the least text (null first), then the least JSON form, stays. Rows with a null id stay.
    """
    kept = bagminhash.near_duplicates(docs).where("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("__rows"))
    kept = written(kept, "kept")
    # the ids grow with the corpus: no size at which they would be broadcast
    rows = docs.join(kept.hint("merge"), "doc_id")
    found = _columns(rows, docs)
    if not kept.where("__rows > 1").isEmpty():
        row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
        one = rows.where("__rows > 1").groupBy("doc_id").agg(F.min_by(row, F.struct("text", F.to_json(row))).alias("__row")).select("__row.*")
        found = _columns(rows.where("__rows = 1"), docs).unionByName(one)
    return found.unionByName(docs.where("doc_id is null"))


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of PASSAGE bytes that occur at another place too; n_chars is that of the new text. Null stays null, shorter texts stay as they are."""
    cut = substrings.without_repeats(docs, length=PASSAGE, gram=ANCHOR)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a packed sequence of 4096 tokens. A null text is an empty one: its piece is the end id. Repeated rows are packed each."""
    import public_tokenizers as P

    return packing.piece_digests(packing.pack(docs, P.path("word_bpe_49k.json")))


STAGES = [("toxicity", clean), ("language", spoken), ("near_duplicates", distinct), ("repeated_strings", unrepeated), ("packing", packed)]

#: The stages can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written in the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, name)
    return docs
