"""Url filters against trying every rule on every url."""

import random

from pulse.llm import urls
from pulse.llm.queries import QUERIES, URL_RULES

from .conftest import SMALL

RULES = "host string, path string, verdict string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    stop = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:stop], rest[stop:]
    stop = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lowered, rest[:stop]


def verdict(url, rules, default="allow"):
    host, path = parts(url)
    fits = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (max(fits)[3:] if fits else (None, default)), host, path


def check(spark, found, rules, **options):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(found)], "page_id long, url string")
    judged = urls.filter_urls(pages, spark.createDataFrame(rules, RULES), **options).collect()
    assert len(judged) == len(found)
    for row in judged:
        (rule, expected), host, path = verdict(found[row["page_id"]], rules)
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, rule, expected)


ODD = [
    None, "", "no scheme", "http://", "://x", "http://A.Example.NET/en/x", "http://example.net", "a://b://c/",
    "http://example.net/en", "http://evilexample.com/de/", "http://b.example.com/de/?q#f", "http://x.org/fr/#?",
    "http://net/", "http://.net/", "http://a..net/", "http://user@x.net:80/p", "http://x.net\n/y", "http://É.net/ö",
    "http://" + "a." * 5000 + "net/" + "p/" * 5000, "http://x-y.net/", "http://x.net/", "http://x.net/",
]


def test_stated_rules(spark):
    check(spark, ODD, URL_RULES)


def test_many_nested_rules(spark):
    random.seed(2)
    labels, steps = ["a", "b", "c-d", "net", "co"], ["", "/", "/x", "/x/", "/x/y", "/é"]
    hosts = [".".join(random.choices(labels, k=random.randint(1, 5))) for _ in range(300)]
    rules = {(random.choice(hosts), random.choice(steps)) for _ in range(150)}
    rules = [(h, p, random.choice(["allow", "block"])) for h, p in sorted(rules)]
    found = [f"http://{random.choice(hosts)}{random.choice(steps)}{random.choice(['', 'z', '/q?'])}" for _ in range(800)]
    check(spark, found, rules)
    check(spark, found, rules, max_rules=40)


def test_no_rules_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], RULES)
    assert urls.filter_urls(pages, none).first()["verdict"] == "allow"
    assert urls.filter_urls(pages.limit(0), none).collect() == []


def test_block_wins_and_null_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", "x")], "page_id long, url string, host string")
    rules = [("a.net", "/", "allow"), ("A.net", "/", "block"), (None, "/", "allow"), ("net", None, "allow")]
    row = urls.filter_urls(pages, spark.createDataFrame(rules, RULES)).first()
    assert (row["host"], row["rule"], row["verdict"]) == ("a.net", "a.net/", "block")


def test_query(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for row in QUERIES["op2_url_filters"](spark, SMALL).collect():
        (rule, expected), host, path = verdict(pages[row["page_id"]], URL_RULES)
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, rule, expected)
