"""Hashed expressions against a plain reading of the rules."""

from __future__ import annotations

import random
import re

from tests.llm.helpers import with_clashes
from txrisk.llm import urls

RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
    ("a.b.c.net", "/es/x", "allow"), ("org", "/", "block"), ("org", "/", "allow"), ("EXAMPLE.org", "", "allow"), (None, "/", "block"), ("x.com", None, "block"),
]


def brute(url, rules):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = None
    for h, p, v in rules:
        if h is None or p is None:
            continue
        h = h.lower()
        if (host == h or host.endswith("." + h)) and path.startswith(p) and host:
            best = max(best or (), (len(h) + len(p), len(h), v, h + p))
    return host, path, best[3] if best else None, best[2] if best else "allow"


def random_urls():
    rnd = random.Random(8)
    hosts = ["com", "example.com", "www.EXAMPLE.com", "notexample.com", "a.b.c.net", "z.a.b.c.net", "net", "net.", ".org", "example.org", "É.com", "u@x.com:80", ""]
    paths = ["", "/", "/en/", "/en", "/es/x/y", "/es/", "/fr/a b", "//en/", "/EN/"]
    out = [f"{rnd.choice(['http', 'HTTPS', ''])}://{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', '?q=/en/', '#/en/', '?a#b'])}" for _ in range(300)]
    return out + [None, "", "no scheme/en/", "://", "a://b://c.com/en/", "x://com\n/en/", "http://" + "a." * 5000 + "com/" + "p/" * 5000]


def test_equals_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(random_urls() * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    out = urls.judge_urls(with_clashes(pages), rules, ["page_id", "url", "score"]).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url, RULES), r.url


def test_repeated_rows_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/"), (None, "http://a.com/")], "page_id long, url string")
    rules = urls.rules_table(spark)
    out = urls.judge_urls(pages, rules, ["page_id"]).collect()
    assert [(r.rule, r.verdict) for r in out] == [("com/", "allow")] * 3
    assert urls.judge_urls(pages.limit(0), rules, ["page_id"]).count() == 0
    out = urls.judge_urls(pages, rules.limit(0), ["page_id"]).collect()
    assert [(r.host, r.rule, r.verdict) for r in out] == [("a.com", None, "allow")] * 3


def test_main_path_has_no_python(spark):
    plan = urls.op5_urls(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
