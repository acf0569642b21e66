"""The registered query of the quality classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import table
from tagloom.llm.language_id import fold_of
from tagloom.llm.quality_classifier import Trainer, predict


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of the quality of every whole text; a null or empty one gets the score of no indicators.

    Learned from the labelled ids whose CRC-32 modulo 5 isn't 0, about 20,000 of them.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    train = fold_of("doc_id") != 0
    model = Trainer().fit(docs.filter(train), labels.filter(train))
    scored = predict(docs, model)
    return scored.select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score", "predicted")
