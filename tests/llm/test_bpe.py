import hashlib
import random

import numpy as np
import pytest

from tagloom.llm import bpe, token_counts
from tagloom.llm.registry import op4_byte_bpe, op5_token_counts


def plain():
    return bpe.encoder(bpe.default_ranks(), bpe.default_pattern()).base


def samples():
    rng = random.Random(5)
    alphabets = ["ab", "abc ", "don't we're ", " \n\t", "aé中 \u00a0\u2003", "0123456789", "!?#*'s", "🙂é a"]
    out = ["", " ", "a", "\n\n a", "'s", "x" * 700, " " * 600 + "y", "ab" * 500]
    for _ in range(150):
        a = rng.choice(alphabets) + rng.choice(alphabets)
        out.append("".join(rng.choice(a) for _ in range(rng.randrange(400))))
    return out


@pytest.mark.parametrize("leaf_chars,leaf_bytes,window", [(1, 1, 1), (2, 3, 1), (7, 5, 4), (64, 16, 8)])
def test_tree_equals_one_go(leaf_chars, leaf_bytes, window):
    tree = bpe.TreeBpe(bpe.default_ranks(), bpe.default_pattern(), leaf_chars, leaf_bytes, window)
    for text in samples():
        assert tree.encode(text) == tree.base.encode_ordinary(text), text[:50]
        assert tree.decode(tree.encode(text)) == text.encode()


def test_borders_are_sure():
    """No pre-token of any text goes over a place that the rule calls a border."""
    import regex

    rng = random.Random(2)
    pattern = regex.compile(bpe.default_pattern())
    known = bpe.classes()
    for _ in range(3000):
        t = "".join(rng.choice("ab'slrevtdm1²  \t\n\u00a0\u3000é中。、ー!?'-_🙂") for _ in range(rng.randrange(30)))
        inside = {i for m in pattern.finditer(t) for i in range(m.start() + 1, m.end())}
        assert not any(known.border(t[i - 1], t[i]) for i in inside), t
    assert known.border("a", " ") and known.border("中", "。") and known.border("\t", "a") and not known.border(" ", "a") and not known.border("'", "s")


def long_texts():
    rng = random.Random(4)
    kana = "".join(chr(c) for c in range(0x3042, 0x3094)) + "日本語文字列処理東京都市場野菜"
    japanese = "".join("".join(rng.choice(kana) for _ in range(rng.randrange(4, 40))) + rng.choice("。、！？") for _ in range(6_000))
    return {
        "japanese": japanese,
        "one run": "".join(rng.choice(kana) for _ in range(100_000)),
        "letters": "".join(rng.choice("abcdefgh") for _ in range(150_000)),
        "spaces": " " * 50_000 + "x" + "\n" * 50_000 + " y",
        "marks": "'" * 40_000 + "s" * 3 + "!?" * 30_000,
        "prose": " ".join("".join(rng.choice("etaoin shrdlu") for _ in range(6)) for _ in range(30_000)),
    }


@pytest.mark.parametrize("kind", ["japanese", "one run", "letters", "spaces", "marks", "prose"])
def test_long_texts_at_production_sizes(kind):
    """Equal to one go; a bounded part is encoded again at each join, also where there are no spaces.

    Runs of one character have no such bound: their tokens are shifted from end to end by one more character.
    """
    text = long_texts()[kind]
    tree = bpe.TreeBpe(bpe.default_ranks(), bpe.default_pattern())
    want = tree.base.encode_ordinary(text)
    whole, single = tree.base.encode_ordinary, tree.base._encode_single_piece
    done = {"bytes": 0}

    def counted(f):
        def run(x):
            done["bytes"] += len(x.encode() if isinstance(x, str) else x)
            return f(x)

        return run

    tree.base.encode_ordinary, tree.base._encode_single_piece = counted(whole), counted(single)
    assert tree.encode(text) == want
    n = len(text.encode())
    joins = len(text) / (bpe.LEAF_CHARS / 2)
    assert kind in ("spaces", "marks") or done["bytes"] - n < 1000 * joins
    assert tree.decode(want) == text.encode()


def test_other_patterns_go_in_one_piece():
    tree = bpe.TreeBpe(bpe.default_ranks(), r"..|.", 1, 1, 1)
    assert tree.encode("hello world") == tree.base.encode_ordinary("hello world")


def test_columns_nulls_and_clashes(spark):
    rows = [(1, "hello world", 7), (None, None, 8), (1, "hello world", 7), (2, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids long")
    out = bpe.decode_tokens(bpe.encode_documents(docs))
    got = sorted(((r.doc_id or 0), list(r.token_ids), bytes(r.decoded)) for r in out.collect())
    ids = plain().encode_ordinary("hello world")
    assert got == sorted([(0, [], b""), (1, ids, b"hello world"), (1, ids, b"hello world"), (2, [], b"")])
    assert bpe.digest_documents(docs.limit(0)).count() == 0


def test_query_against_plain_encoding(spark, sf_dir):
    got = {r.doc_id: r for r in op4_byte_bpe(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = plain().encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_token_counts_against_brute_force(spark, sf_dir):
    lengths = [len(plain().encode_ordinary(r.text or "")) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = op5_token_counts(spark, sf_dir).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(lengths))
    for r in rows:
        upto = [n for n in lengths if n <= r.n_tokens]
        assert (r.n_docs, r.docs_upto, r.docs_over) == (lengths.count(r.n_tokens), len(upto), len(lengths) - len(upto))
        assert r.tokens_upto == sum(upto) and r.total_tokens == sum(lengths) and r.tokens_over == sum(lengths) - sum(upto)
        assert r.truncated_total == sum(min(n, r.n_tokens) for n in lengths)
        assert r.quantile == len(upto) / len(lengths)


def test_limits_and_quantiles(spark):
    lengths = [0, 3, 3, 5, 2000, 5000, None]
    h = token_counts.length_histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens long"))
    sums = token_counts.suffix_sums(h)
    known = [n or 0 for n in lengths]
    for r in token_counts.limit_report(sums, [0, 1, 4, 2500, 10**6]).collect():
        assert r.truncated_total == sum(min(n, r.context_limit) for n in known)
        assert r.docs_over == sum(n > r.context_limit for n in known)
    q = token_counts.quantile_lengths(sums, [0.5, 0.9]).first()
    assert (q.p50, q.p90) == (3, 5000)
    empty = token_counts.suffix_sums(token_counts.length_histogram(spark.createDataFrame([], "n_tokens long")))
    assert empty.count() == 0
    assert [r.truncated_total for r in token_counts.limit_report(empty, [8]).collect()] == [0]
