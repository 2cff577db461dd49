"""The corpus pipeline: language, quality, exact copies, near copies, packing.

Every stage reads what the one before it kept, as a written table, and its
decisions take effect: all but the last return the rows that stay, with the
columns of `documents`; the last returns where each document's bytes are packed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm import language, line_quality
from loanbook.llm.common import delete_tables, read, scratch_dropped, shared_folder
from loanbook.llm.packing import pack
from loanbook.llm.queries import crc_of_id
from loanbook.llm.radix_dedup import radix_dedup
from loanbook.llm.similarity import near_duplicates

LEAST_SHARE = 0.5  # of a text in its main language
LEAST_FIT = -10  # standard deviations of a text's fit from the mean of those learned from
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, without a main language, or that fit no language go; all stay if no row has a language to teach.

    The texts that taught a language are measured twice, for the distribution of
    fits and to be judged: a written copy of all texts would cost more disk than
    the stage may take. Null and empty texts have no letters and go, equal rows
    share their fate, an empty table stays empty.
    """
    learned = crc_of_id(3) != 1
    model = language.train(docs, where=learned)
    if not model.langs:
        return docs
    taught = docs.where(learned & F.col("lang").isNotNull())
    fit = language.learn_fit(language.measure(taught, model, columns=["lang"]), F.col("row.lang"))
    measured = language.measure(docs, model)
    named = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE)
    return measured.where(named & (fit.deviation() >= LEAST_FIT)).select("row.*")


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose lines are bad go; all stay if the labels can teach nothing.

    Null and empty texts are scored as texts without lines, equal rows share
    their fate, rows without an id teach nothing, an empty table stays empty.
    """
    model = line_quality.train(docs, read(spark, sf_dir, "labels"), where=crc_of_id(4) != 2)
    if model is None:
        return docs
    return line_quality.score_documents(docs, model).where(F.col("score") >= line_quality.THRESHOLD).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays, of equal ids one; null and empty texts are equal, null ids rank lowest."""
    return radix_dedup(docs, carry=docs.columns).where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id stays, of equal ids the first; null ids rank last.

    Null and empty texts, and texts without a word, are alike only if equal.
    """
    return near_duplicates(docs, carry=docs.columns).where("kept").select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, as bytes, in sequences of the permitted lengths; null and empty texts take no room but have a row."""
    return pack(docs, F.octet_length("text"))


STAGES = [
    ("language", identify_language),
    ("quality", classify_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`; what a stage kept is written to the shared folder and read by the next.

    The table of a stage goes when the next one has been written; that of the
    last is the result.
    """
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    last = None
    for name, stage in STAGES:
        with scratch_dropped(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last is not None:
            delete_tables(spark, [last])
        last = f"{folder}/{name}"
    return docs
