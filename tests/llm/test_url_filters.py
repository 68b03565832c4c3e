from __future__ import annotations

import random

from pyspark.sql import functions as F

from trailperks.llm import url_filters
from trailperks.llm.queries import URL_RULES, op6

SMALL = "/root/testdata/sf0.001"


def plain(url, rules, default="allow"):
    """Every rule tried on the URL."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    ends = [n for n in (rest.find(c) for c in "/?#") if n >= 0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[: min(ends, default=len(rest))])
    path = rest[len(host) :].split("?")[0].split("#")[0]
    fitting = [
        (len(h + p), len(h), v == "block", h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, max(fitting)[3], max(fitting)[4]) if fitting else (host, path, None, default)


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(n, u) for n, u in enumerate(urls)], "page_id long, url string")
    pages = pages.withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1)).withColumn("row", F.lit(2))
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    rows = url_filters.judge(pages, table).collect()
    return {r["row"]["page_id"]: (r.host, r.path, r.rule, r.verdict) for r in rows}


URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "https://Example.COM/en/1", "http://www.example.com/en/",
    "http://a.www.example.com/en/x?y#z", "http://notexample.com/en/", "http://x.net/es/", "http://x.net/fr", "http://x.net?/es/",
    "http://x.net#/es/", "ftp://net/es/a/b/c", "http://a://b.com/", "http://com:80/", "http://.com/", "http://com./", "http://É.com/É/",
    "http://x.com/" + "a/" * 3000, "http://" + "s." * 2000 + "net/es/", "http://x.com//en//", "HTTP://USER@X.COM/en/\nz",
]


def test_hard_urls(spark):
    expected = {n: plain(u, URL_RULES) for n, u in enumerate(URLS)}
    assert judged(spark, URLS, URL_RULES) == expected


def test_random_rules(spark):
    pick = random.Random(3)
    host = lambda: ".".join(pick.choice("ab") for _ in range(pick.randrange(1, 4)))
    path = lambda: "".join(pick.choice(["/", "/", "x", "y"]) for _ in range(pick.randrange(5)))
    rules = sorted({(host(), path()): (pick.choice(["allow", "block"]),) for _ in range(40)}.items())
    rules = [(v, h, p) for (h, p), (v,) in rules]
    rules += [("block", rules[0][1], rules[0][2]), rules[1], ("block", None, "/")]
    urls = [f"http://{host()}{'/' + path() if pick.random() < 0.8 else ''}" for _ in range(600)]
    usable = [r for r in rules if r[1] is not None]
    assert judged(spark, urls, rules) == {n: plain(u, usable) for n, u in enumerate(urls)}


def test_no_rules_no_pages_and_repeated_rows(spark):
    assert judged(spark, URLS, [("block", None, None)]) == {n: plain(u, []) for n, u in enumerate(URLS)}
    assert judged(spark, [], URL_RULES) == {}
    pages = spark.createDataFrame([(None, "http://x.net/es/")] * 3 + [(1, None)], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    assert sorted(r.verdict for r in url_filters.judge(pages, rules).collect()) == ["allow"] + ["block"] * 3


def test_equal_prefixes_are_told_apart_by_the_digest(spark, monkeypatch):
    """With a prefix of one digit most keys collide."""
    monkeypatch.setattr(url_filters, "PREFIX_DIGITS", 1)
    assert judged(spark, URLS, URL_RULES) == {n: plain(u, URL_RULES) for n, u in enumerate(URLS)}


def test_plan_has_no_python(spark):
    plan = op6(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
