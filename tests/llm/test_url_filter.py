import random
import re

import pytest

from fieldgauge.llm import url_filter
from fieldgauge.llm.queries import RULES

RULE = "host string, path string, verdict string"


def judge(url, rules, default="allow"):
    """Brute force over all rules."""
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h + p), len(h), h + p, v) for h, p, v in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def check(spark, urls, rules, **options):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = url_filter.judge_urls(df, spark.createDataFrame(rules, RULE), **options).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judge(urls[r["page_id"]], rules), urls[r["page_id"]]


def test_contract_rules(spark):
    check(spark, [
        "http://a.example.net/en/x?q", "http://example.net/fr/", "HTTP://EXAMPLE.COM/de/1", "https://m.example.com/de/",
        "http://x.org/fr/2#t", "http://net", "http://net/", "http://notexample.net/en/", "http://a.net?x=/en/", None, "", "nothing",
        "http:///p", "x://y://example.net/en/", "http://example.com/DE/", "http://example.net./en/",
    ], list(RULES))


def test_nested_rules_against_brute_force(spark):
    r = random.Random(5)
    hosts = ["com", "b.com", "a.b.com", "c.com", "org", "x.org"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab", "/b"]
    rules = list({(h, p): (h, p, r.choice(["block", "allow"])) for h in hosts for p in paths if r.random() < 0.5}.values())
    urls = [
        "http://" + r.choice(["", "w.", "www.w.", "A."]) + r.choice([*hosts, "bb.com", "net"]) + r.choice([*paths, "/a/b/c", "/abc", "?q", "#f"])
        for _ in range(400)
    ]
    check(spark, urls, rules)
    check(spark, urls, rules, salts=3)


def test_edges(spark):
    check(spark, ["http://a.com/"] * 5, [])
    check(spark, [], list(RULES))
    check(spark, ["http://" + "a." * 60 + "net/" + "p" * 50_000, "http://net/x"], [*RULES, ("", "/", "block")])
    # The same rule twice: blocking wins.
    df = spark.createDataFrame([(1, "http://a.com/", "mine", "h")], "id long, url string, verdict string, HOST string")
    rules = spark.createDataFrame([("a.com", "/", "allow"), ("A.com", "/", "block")], RULE)
    (row,) = url_filter.judge_urls(df, rules).collect()
    assert row.asDict() == {"id": 1, "url": "http://a.com/", "host": "a.com", "path": "/", "rule": "a.com/", "verdict": "block"}


@pytest.mark.parametrize("salts", [1, 8])
def test_no_python_in_the_plan(spark, salts):
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = url_filter.judge_urls(df, spark.createDataFrame(list(RULES), RULE), salts=salts)
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())


def test_salts_grow_with_rows_and_rules_stay_fewer():
    assert url_filter.salts_for(0, 4) == url_filter.salts_for(10**6, 4) == 64
    assert url_filter.salts_for(10**9, 4) == 4_000
    assert url_filter.salts_for(10**9, 10**6) == 1_000


def test_shuffled_input_keeps_its_rows(spark):
    df = spark.range(500).selectExpr("id AS page_id", "concat('http://h', id % 7, '.net/', id) AS url").repartition(5)
    got = url_filter.judge_urls(df, spark.createDataFrame(list(RULES), RULE)).collect()
    assert sorted(r["page_id"] for r in got) == list(range(500))
    assert all(r["url"].endswith(r["host"] + r["path"]) and r["rule"] == "net/" for r in got)
