"""A training corpus from raw documents, in five stages.

Each stage takes the documents its predecessor kept and returns those it keeps; ``run`` writes what a
stage returns as Parquet and reads it again for the next one. All but the last return the columns of
``documents``; the last returns token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm import byte_bpe
from tidemill.llm.common import Workspace, importable
from tidemill.llm.line_dedup import dedup_lines, word_count
from tidemill.llm.mixing import Tempered, mix, with_topic
from tidemill.llm.ngram_jaccard import checked, similar_components
from tidemill.llm.quality import judge, n_words, with_votes

MIN_RUN_WORDS = 50
NEAR_WORDS, NEAR_PERCENT = 5, 80
TARGETS = {"source": Tempered(0.7), "lang": Tempered(0.8), "topic": Tempered(0.9)}
RANKS = "byte_bpe_multi_50k.tiktoken"


def packed() -> Column:
    """All columns of the documents as one, so that no working column has the name of one of them."""
    return F.struct("*").alias("doc")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that pass the base rule and are probably good by the weighed rules.

    A null or empty text fails the base rule; very long ones are judged whole; repeated rows are judged
    alike; an empty table gives an empty one; columns of any name stay as they are.
    """
    judged, _ = judge(with_votes(docs.select(packed()), "doc.text"), fresh(spark))
    return judged.where("kept").select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of line runs of 50 words or more; a document that loses all its words to
    that goes. ``n_chars`` follows the text.

    A null or empty text stays as it is; of repeated rows with a run that is long enough
    the first in the order of ids keeps it (null ids come first); an empty table gives an empty one;
    columns of any other name stay as they are.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *others).alias("doc"))
    left = dedup_lines(rows, fresh(spark), min_words=MIN_RUN_WORDS)
    lost = F.col("n_deleted") > 0
    left = left.where(~lost | F.coalesce(F.trim("text") != "", F.lit(False)))
    left = left.where(~lost | (word_count(F.replace("text", F.lit("\n"), F.lit(" "))) > 0))
    own = {c: F.col(f"doc.{c}") for c in others} | {c: F.col(c) for c in ("doc_id", "text")}
    if "n_chars" in own:
        own["n_chars"] = F.when(lost, F.length("text")).otherwise(own["n_chars"])
    return left.select(*(own[c].alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with similar 5-word shingles stays, the one of the smallest id.

    A text that is null or without words is like no other; one of fewer than five words is one shingle;
    rows repeated with id and text are one document; a null id is larger than any other; an empty table
    gives an empty one; columns of any other name stay as they are.
    """
    importable(spark)
    work = fresh(spark)
    found = similar_components(docs, work, words=NEAR_WORDS, percent=NEAR_PERCENT)
    found = work.keep(found.select("_id", "_hash", "first"), "found")
    key = ["_id", "_hash"]
    out = checked(work.keep(found.where("NOT first").select(key).distinct(), "out"))
    # Rows repeated with id and text are one document.
    counts = found.where("first").groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = checked(work.keep(counts.select(key), "repeated"))
    rows = docs.select(packed(), F.xxhash64("text").alias("own_hash"))

    def among(some: DataFrame) -> Column:
        return rows["doc.doc_id"].eqNullSafe(some["_id"]) & (rows["own_hash"] == some["_hash"])

    single = rows.join(out, among(out), "left_anti").join(repeated, among(repeated), "left_anti")
    one = Window.partitionBy("doc.doc_id", "own_hash").orderBy("doc.text")
    many = rows.join(repeated, among(repeated), "left_semi").withColumn("_n", F.row_number().over(one))
    return single.select("doc.*").union(many.where("_n = 1").select("doc.*"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents so that tokens meet the target weights of sources, languages and topics.

    A null source, language or topic is a value like any other; a document without tokens has the
    probability of its cell; rows of one id go together where their probabilities are equal; an empty
    table gives an empty one; columns of any other name stay as they are.
    """
    rows = docs.select("doc_id", "source", "lang", n_words().alias("tokens"), packed())
    mixed = mix(with_topic(spark, rows, sf_dir), TARGETS, F.col("tokens"), fresh(spark))
    return mixed.where("sampled").select("doc.*")


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text back.

    A null or empty text has no ids; texts of any length are encoded whole; each of repeated rows gives a
    row; an empty table gives an empty one; other columns are left out.
    """
    importable(spark)
    fresh(spark)
    path = public_tokenizers.path(RANKS)
    vocabulary = byte_bpe.Vocabulary(spark, path, public_tokenizers.PATTERN)
    coded = byte_bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), vocabulary)
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "intact"
    )


_open: list[Workspace] = []


def fresh(spark: SparkSession) -> Workspace:
    """A workspace for a stage. The tables of the stage before go: what it returned has been written
    by now, as this stage was given it."""
    while _open:
        _open.pop().close()
    _open.append(Workspace(spark))
    return _open[-1]


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing", mixing),
    ("byte-level BPE", byte_level_bpe),
]

# SQL cannot express the token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Workspace(spark)
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
