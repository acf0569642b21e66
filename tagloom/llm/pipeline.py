"""Corpus pipeline: language, near duplicates, secrets, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept.  All
but the last return the columns of ``documents``; other columns of their input
go, and an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import bpe, language_id, mixing, mixing_query, near_dup, secrets
from tagloom.llm.common import remove_folder, shared_folder, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Posterior below which a language is not believed.
LEAST_SCORE = 0.5
#: Share of the way from the usual likelihood of a language's documents to chance beyond which a text isn't in that language.
MOST_STRANGENESS = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language: no letter, no text, a doubtful answer or a language that wasn't learned go.

    lang is from here on the language found in the text, whatever it was given
    as, also where it was null.  Rows that repeat are judged alike.
    """
    train = language_id.fold_of("doc_id") != 0
    model = language_id.fit(docs, train=train)
    judged = language_id.predict(docs.select(*COLUMNS), model, against=language_id.usual(docs, model, train=train))
    sure = (F.col("score") >= LEAST_SCORE) & (F.col("strangeness") <= MOST_STRANGENESS)
    return judged.filter((F.col("lang_pred") != language_id.UNKNOWN) & sure).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one of the least id.

    A null text and one without a word stay; of rows that agree in id and text
    one does.
    """
    return near_dup.keep_one(docs.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with secrets replaced by their kind; n_chars follows the text.

    A null or empty text stays as it is, and so does n_chars where nothing was
    found. Every row is kept.
    """
    clean = secrets.scan_documents(docs.select(*COLUMNS), redacted="text")
    return clean.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the target weights; a document comes once for each epoch it is in.

    A null lang or source is the node with the empty name; texts without a word
    are in no epoch; rows that agree in id and text share their place.
    """
    mixed = mixing.mix(docs.select(*COLUMNS), mixing_query.WEIGHTS, mixing_query.domain_of(), mixing_query.half(F.col("__total")), mixing_query.EPOCHS, mixing_query.SEED)
    return mixing.repeat(mixed, COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their number: doc_id, lang, source, n_tokens, token_ids. A null or empty text has none."""
    encoded = bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"))
    return encoded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixture", mix_sources),
    ("tokens", encode_tokens),
]

#: Signatures, the language model and byte-pair merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; results are handed on as Parquet in the shared folder.

    What a stage has read is removed once its own result is written.  The input
    of the last stage stays, as its rows are made when they are asked for.
    """
    docs = table(spark, sf_dir, "documents")
    folder, done = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if done:
            remove_folder(spark, done)
        done = path
    return STAGES[-1][1](spark, docs, sf_dir)
