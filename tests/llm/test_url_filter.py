"""URL filter: verdicts against plain Python, exactness of the cascade."""

import re

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from tools.compare import compare, duck

from terrace.llm import queries, url_filter

URLS = [None, "", "no scheme", "http://", "http://NET/", "http://net", "https://a.B.net/x", "http://xnet/", "http://notexample.net/en/",
        "http://m.example.net/en/1?x=/de/", "http://example.net/en", "http://example.com/de/#a", "http://example.com/DE/",
        "http://a.org/fr/x", "http://org?/fr/", "x://spam-farm.example.org/es/", "http://adult.example.org", "http://spammer.org/",
        "a://b://c/d", "http://\u00c9.net/\u00e9", "http://" + "a." * 5000 + "net/", "http://user:pw@host.net:80/p#f"]


def plain(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fit = [(len(h + p), v, h + p) for v, h, p in url_filter.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        _, verdict, rule = max(fit)
        return host, path, rule, verdict
    listed = any(set(label.split("-")) & set(url_filter.LISTED_WORDS) for label in host.split("."))
    return host, path, None, "block" if listed else "allow"


@pytest.mark.parametrize("limit", [url_filter.MAX_BYTES, 8])  # one cascade, several
def test_verdicts(spark, limit):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS * 2)], "page_id long, url string")
    pages = pages.selectExpr("*", "1 AS host", "2 AS verdict", "'k' AS `key`")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge(pages, max_bytes=limit).collect()}
    assert len(got) == 2 * len(URLS)
    for i, v in got.items():
        assert v == plain(URLS[i % len(URLS)]), URLS[i % len(URLS)]


def test_query_matches_sql(spark):
    r = compare(spark, "op6", queries.op6_url_filter, queries.oracle_sql()["op6_url_filter"], SF_SMALL, duck(SF_SMALL))
    assert r["status"] == "MATCH" and not r["types"], r


@pytest.mark.parametrize("listed", [0, 1, 400, 5000])
def test_cascade_is_exact_over_its_universe(spark, listed):
    rng = np.random.default_rng(listed)
    keys = rng.integers(-2 ** 62, 2 ** 62, (6000, 2))
    rows = spark.createDataFrame([(str(i), int(a), int(b)) for i, (a, b) in enumerate(keys)], "key string, h1 long, h2 long")
    # The last thousand keys are asked for by nobody; some of them are listed.
    number = F.col("key").cast("int")
    levels = url_filter.build(rows.where(number < 5000), rows.where((number < listed) | ((number > 5900) & F.lit(listed > 0))))
    got = url_filter.member(levels, np.ascontiguousarray(keys[:5000, 0]), np.ascontiguousarray(keys[:5000, 1]))
    assert (got == (np.arange(5000) < listed)).all()


def test_parts_keep_cascades_small():
    assert url_filter.parts_of(0, 10 ** 9, 64 << 20) == 1
    for listed, universe in ((10 ** 6, 10 ** 9), (10 ** 9, 10 ** 11), (10 ** 9, 10 ** 9)):
        parts = url_filter.parts_of(listed, universe, 64 << 20)
        bits = url_filter._shape(listed // parts, universe // parts, 0)[0] + 4 * listed // parts
        assert bits / 8 <= 64 << 20


def test_given_host_list(spark):
    pages = spark.createDataFrame([(1, "http://a.b/x"), (2, "http://b/x"), (3, "http://adult.c/"), (4, "http://x.net/")],
                                  "page_id long, url string")
    hosts = spark.createDataFrame([("a.b",), ("a.b",), (None,), ("never.seen",), ("x.net",)], "host string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, listed=hosts).collect()}
    assert got == {1: (None, "block"), 2: (None, "allow"), 3: (None, "allow"), 4: ("net/", "block")}


def test_empty_table(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
