"""From raw documents to packed training sequences, in stages that can each be written and read again.

Each stage takes what the one before has kept; all but the last return the columns of documents. In
order: language ID (documents without letters go), line dedup (lines held by an earlier document
go), n-gram Jaccard join (the smallest id of each group of near duplicates stays), benchmark
decontamination (hit passages are cut out), packing.

In all stages: rows with a null id stay, but for null texts; such rows share no lines and no near duplicates with
others. Rows that repeat an id are one document: they stay or go together where ids decide (lines,
near duplicates), else row by row; so equal rows with one id all stay. A null or empty text goes in the first stage, as it has no
letter. Columns besides those of documents go with the first stage. An empty table goes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge.llm.decontam import find_leaks
from candleforge.llm.jaccard import MOST_BROADCAST, near_duplicates
from candleforge.llm.langid import identify
from candleforge.llm.lines import dedup_lines
from candleforge.llm.packing import pack_documents, word_bpe

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Below this score no language claims the text: its best one-versus-rest margin is -0.2.
LEAST_SCORE = 0.4
#: SQL can't express the models and the tokenizer.
ORACLE_SQL = None


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found, with that language. In effect only letterless texts go.

    The models have no intercept: a text unlike all learned languages scores near 0.5 and stays, so
    LEAST_SCORE seldom fires.
    """
    found = identify(docs, keep=("doc_id", "source", "n_chars"))
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.withColumnRenamed("lang_pred", "lang").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that earlier ones hold; those of which no line is left go."""
    found = dedup_lines(docs, keep=("doc_id", "lang", "source"))
    return _sized(found.where("n_dropped < n_lines"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates.

    Up to MOST_BROADCAST ids that go are broadcast, by their count; beyond it the texts are shuffled.
    """
    gone = near_duplicates(docs).where("component_id <> doc_id").select("doc_id").distinct()
    gone = F.broadcast(gone) if gone.count() <= MOST_BROADCAST else gone
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those of which no word is left go."""
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ("doc_id", "lang", "source"), cut=True)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return _sized(found.where((n_hit == 0) | (n_hit < F.col("n_words"))))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, placed in sequences."""
    return pack_documents(docs, word_bpe())


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written to the shared folder and read again."""
    from candleforge.llm.shared import Spilled

    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        before, written = written, Spilled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            before.drop()
        docs = written.df
    return STAGES[-1][1](spark, docs, sf_dir)
