"""URL rules: the cascade is exact for every key of its universe."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventide.llm import urls

RULES = [urls.Rule.parse(r, v) for r, v in (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
                                           ("net/es/", "block"), ("org", "block"))]


def brute(url, rules, default="allow"):
    at = (url or "").find("://")
    rest = url[at + 3:] if url and at >= 0 else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [r for r in rules if host and ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.key), len(r.host)), default=None)
    return host, path, best and best.key, best.verdict if best else default


def test_verdicts(spark):
    made = ["http://WWW.Example.com/en/x", "https://example.com/en/", "https://a.b.example.com/en/q?x#y", "https://example.com", "x", None, "",
            "://net/es/1", "ftp://xnet/es/", "http://a.net/es", "http://a.net/es/?", "http://org", "http://b.org?q", "http://a.com#/", "http://.com/",
            "http://com./", "a://b://c.com/", "http://x.com\n/en/", "http://É.com/", "http:///path"]
    made += [f"https://h{i % 37}.site{i % 11}.{['com', 'net', 'org', 'io'][i % 4]}/{['en', 'es', 'fr'][i % 3]}/{i}" for i in range(400)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(made + made[:5])], "page_id long, url string")
    df = df.withColumns({"key": F.lit("x"), "host": F.lit(1), "rule": F.lit(2)})
    for rules in (RULES, RULES[:1], []):
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.url_verdicts(df, rules).collect()}
        assert got == {i: brute(u, rules) for i, u in enumerate(made + made[:5])}


@pytest.mark.parametrize("listed", [0, 1, 40, 700, 1500])
def test_cascade_is_exact(spark, listed):
    universe = spark.range(1500).select(F.concat(F.lit("key-"), "id").alias("key"), (F.col("id") < listed).alias("listed"))
    cascade = urls.build_cascade(universe, "key", "listed")
    assert universe.where(cascade.has(F.col("key")) != F.col("listed")).count() == 0
    if listed == 40:
        assert len(cascade.levels) > 1 and sum(len(x.bits) for x in cascade.levels) < 1000


def test_limits(spark):
    with pytest.raises(ValueError):
        urls.level_of(spark.range(1).select(F.lit("a").alias("key")), "key", 1, 10**10, 0.01)
    with pytest.raises(ValueError):
        urls.url_verdicts(spark.createDataFrame([(1, "u")], "page_id long, url string"),
                          [urls.Rule("a", "/", "allow"), urls.Rule("a", "/", "block")])
    assert urls.url_verdicts(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0
