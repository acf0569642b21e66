"""Columns of the input that bear a new column's name in another case."""

import pytest
from pyspark.sql import functions as F

from tagloom.llm import bpe, language_id, quality_rules, secrets, url_filter


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, "one two three", "en"), (2, None, "de")], "doc_id long, text string, lang string")


def old(df, *names):
    return df.withColumns({n: F.lit("old") for n in names})


def values(df, *names):
    return [tuple(r) for r in df.orderBy("doc_id").select(*names).collect()]


def test_tokens(docs):
    x = bpe.digest_documents(old(docs, "N_TOKENS", "Ids_Sha256", "DECODED_sha256"))
    assert x.columns == ["doc_id", "lang", "n_tokens", "ids_sha256", "decoded_sha256"] and [r[0] for r in values(x, "n_tokens")][1] == 0
    x = bpe.count_documents(old(docs, "N_Tokens"))
    assert x.columns == ["doc_id", "lang", "n_tokens"] and values(x, "n_tokens")[1] == (0,)


def test_language(docs):
    model = language_id.fit(docs)
    x = language_id.predict(old(docs, "LANG_PRED", "Score"), model)
    assert x.columns == ["doc_id", "text", "lang", "lang_pred", "score"] and values(x, "lang_pred") == [("en",), ("und",)]


def test_secrets(docs):
    x = secrets.scan_documents(old(docs, "SECRETS", "Clean"), redacted="clean")
    assert x.columns == ["doc_id", "text", "lang", "secrets", "clean"] and values(x, "secrets", "clean") == [([], "one two three"), ([], None)]


def test_urls(docs):
    x = url_filter.filter_urls(old(docs, "VERDICT", "Host", "PATH", "Rule").withColumn("url", F.lit("http://a.b/c")), [("b/", "block")])
    assert x.columns == ["doc_id", "text", "lang", "url", "host", "path", "rule", "verdict"] and values(x, "verdict", "host") == [("block", "a.b")] * 2


def test_quality(docs):
    x = quality_rules.judge(old(docs, "KEPT", "Rule", "N_Words"), quality_rules.DecisionList(()))
    assert x.columns[:3] == ["doc_id", "text", "lang"] and values(x, "n_words", "kept", "rule") == [(3, False, 0), (0, False, 0)]
