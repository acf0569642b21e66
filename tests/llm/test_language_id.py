import math
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tagloom.llm import language_id
from tagloom.llm.registry import op7_language_id

M32 = 0xFFFFFFFF


def plain_slots(text):
    """Hash slots of the character 1- to 3-grams, one at a time."""
    c = [ord(x) for x in " " + "".join("σ" if x == "Σ" else x.lower() for x in text) + " "]
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(c) - n + 1):
            h = n * 0x9E3779B1 & M32
            for k, m in zip(range(n), (2654435761, 2246822519, 3266489917)):
                h = (h ^ c[i + k]) * m & M32
                h ^= h >> 15
            out[(h * 0x85EBCA6B & M32) >> 17] += 1
    return out


def has_letter(text):
    return any(unicodedata.category(c)[0] == "L" for c in text or "")


class PlainBayes:
    """Counts in dictionaries; one text at a time."""

    def __init__(self, rows):
        self.counts, self.docs = defaultdict(Counter), Counter()
        for text, lang in rows:
            if lang is not None and has_letter(text):
                self.counts[lang] += plain_slots(text)
                self.docs[lang] += 1
        self.sizes = {g: sum(c.values()) + 0.5 * language_id.SLOTS for g, c in self.counts.items()}

    def predict(self, text):
        if not self.docs or not has_letter(text):
            return "und", 0.0
        grams = plain_slots(text)
        s = {g: math.log(self.docs[g] / sum(self.docs.values())) + sum(n * math.log((self.counts[g][k] + 0.5) / self.sizes[g]) for k, n in grams.items()) for g in sorted(self.docs)}
        best = max(s, key=s.get)
        return best, 1 / sum(math.exp(x - s[best]) for x in s.values())


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def test_query_against_plain_bayes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    plain = PlainBayes([(r.text, r.lang) for r in docs if fold(r.doc_id)])
    want = {r.doc_id: (fold(r.doc_id) == 0, *plain.predict(r.text)) for r in docs}
    got = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in op7_language_id(spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    for d, (held, lang, score) in want.items():
        assert got[d][:2] == (held, lang) and math.isclose(got[d][2], score, rel_tol=1e-6, abs_tol=1e-9)


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op7_language_id(spark, sf).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert 100 < len(held) < 300
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_model_against_counting_by_hand(spark):
    rows = [(1, "abab", "x"), (2, "bcbc", "y"), (3, None, "x"), (4, "zz", None), (5, "123", "y"), (6, "ab ab", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert model.languages == ("x", "y")
    assert np.allclose(np.exp(model.prior), [2 / 3, 1 / 3])
    n = np.full((language_id.SLOTS, 2), language_id.SMOOTHING)
    for _, t, g in rows:
        if g and has_letter(t):
            for s, k in plain_slots(t).items():
                n[s, "xy".index(g)] += k
    assert np.allclose(model.matrix, np.log(n / n.sum(axis=0)))


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1 << 16])
def test_pieces_change_nothing(size, monkeypatch):
    texts = ["", "a", "ab", "ΑΣ ΣΑΣ", "İstanbul", "x" * 50, "word and another word " * 5, "🙂é\n\t"]
    want = [plain_slots(t) for t in texts]
    got = [Counter() for _ in texts]
    for rows, grams in language_id.batches_of(texts, size):
        for slots, number in grams:
            for row, s in zip(np.repeat(rows, number).tolist(), slots.tolist()):
                got[row][s] += 1
    assert got == want
    monkeypatch.setattr(language_id.batches_of, "__defaults__", (size,))
    for t, w in zip(texts, want):
        assert dict(zip(*(x.tolist() for x in language_id.counts_of(t)))) == w


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "aaaa", "x", 3.0), (None, "bbbb", "y", 4.0), (2, None, "x", 5.0), (3, "", "y", 6.0), (4, "12 !", "y", 7.0), (1, "aaaa", "x", 3.0)], "doc_id long, text string, lang string, score double")
    docs = docs.selectExpr("*", "'other' AS __text", "1 AS lang_pred")
    out = language_id.predict(docs, language_id.fit(docs)).collect()
    assert sorted((r.lang_pred, r.score > 0) for r in out) == [("und", False)] * 3 + [("x", True)] * 2 + [("y", True)]
    assert {r["__text"] for r in out} == {"other"}
    none = language_id.fit(docs.limit(0))
    assert none.languages == () and {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), none).count() == 0


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGS", 2)
    docs = spark.createDataFrame([(f"text {g}", g) for g in "abc"], "text string, lang string").repartition(3)
    with pytest.raises(Exception, match="more than 2 languages"):
        language_id.fit(docs)


def test_very_long_text():
    """Piece by piece: the scores are those of the counts, and memory isn't a multiple of the text."""
    import tracemalloc

    text = "abcd efgh " * 300_000
    rng = np.random.default_rng(1)
    model = language_id.LanguageModel(("x", "y"), np.zeros(2), rng.random((language_id.SLOTS, 2)))
    slots, n = language_id.counts_of(text)
    assert n.sum() == 3 * len(text) + 3
    tracemalloc.start()
    scores, sizes = model.scores([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(scores[0], n @ model.matrix[slots]) and sizes.tolist() == [n.sum()]
    assert peak < 16 << 20
