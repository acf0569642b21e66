import random

import duckdb
import pytest

from tagloom.llm import registry, url_filter


def brute(host, path, rules):
    fits = []
    for rule, verdict in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), h.count("."), rule, verdict))
    return max(fits)[2:] if fits else None


def test_trie_against_all_rules():
    rng = random.Random(3)
    hosts = ["a.b", "b", "x.a.b", "ab", "b.a", ""]
    paths = ["", "/", "/e", "/e/", "/e/f", "/e/fg/h", "/ef", "//e"]
    for _ in range(300):
        rules = list({(rng.choice(hosts[:5]) + rng.choice(paths[1:])): rng.choice(["allow", "block"]) for _ in range(rng.randrange(1, 9))}.items())
        trie = url_filter.UrlTrie(rules)
        for h in hosts:
            for p in paths:
                assert trie.find(h, p) == brute(h, p, rules), (rules, h, p)


@pytest.mark.parametrize(
    "url,expected",
    [
        (None, ("", "")),
        ("no scheme", ("", "")),
        ("HTTP://EXAMPLE.Org", ("example.org", "")),
        ("http://a.b?x=/y", ("a.b", "")),
        ("http://a.b/p/q?x#y", ("a.b", "/p/q")),
        ("a://b://c/d", ("b:", "//c/d")),
        ("x://É.org/#", ("É.org", "/")),
    ],
)
def test_split_url(url, expected):
    assert url_filter.split_url(url) == expected


def test_block_wins_over_the_same_allow_rule():
    assert url_filter.UrlTrie([("a/", "block"), ("a/", "allow")]).find("a", "/x") == ("a/", "block")


def test_rows_and_clashing_columns(spark):
    rows = [(1, "http://s.example.org/es/x", "old"), (None, None, "old"), (1, "http://s.example.org/es/x", "old")]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    out = url_filter.filter_urls(pages, registry.URL_RULES)
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in out.collect() if r.rule) == [(1, "example.org/es/", "block")] * 2
    assert [(r.host, r.path, r.verdict) for r in out.collect() if not r.rule] == [("", "", "allow")]
    assert url_filter.filter_urls(pages.limit(0), registry.URL_RULES).count() == 0


def test_query_against_sql(spark, sf_dir):
    got = sorted(map(tuple, registry.op6_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", "verdict").collect()))
    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    want = sorted(db.sql(registry.OP6_SQL).fetchall())
    assert got == want


def test_deep_rules_and_clashing_names(spark):
    """The trie is sent as it was built, however deep; input columns may bear any name."""
    host, path = ".".join("abc" * 900), "/".join("xyz" * 900)
    rules = [(f"{host}/{path}", "block"), ("c/", "allow")]
    pages = spark.createDataFrame([(1, f"http://{host}/{path}q", "no"), (2, f"http://{host}/x", None), (3, None, "no")], "page_id long, url string, __url string").selectExpr("*", "7 AS rule")
    got = {r.page_id: (r.rule, r.verdict, r["__url"]) for r in url_filter.filter_urls(pages, rules, default="block").collect()}
    assert got == {1: (f"{host}/{path}", "block", "no"), 2: ("c/", "allow", None), 3: (None, "block", "no")}


def test_the_broadcast_is_bounded(monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_CHARS", 20)
    with pytest.raises(ValueError, match="20 characters"):
        url_filter.UrlTrie([("a.b/c", "allow")] * 5)


def test_a_very_long_url():
    trie = url_filter.UrlTrie([("b/x/x/", "block"), ("a.b/", "allow")])
    host, path = url_filter.split_url("http://" + "l." * 200_000 + "a.b/" + "x/" * 500_000)
    assert trie.find(host, path) == ("b/x/x/", "block")
