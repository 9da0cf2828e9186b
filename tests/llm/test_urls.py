import re
from itertools import combinations

import pytest
from helpers import SMALL
from pyspark.sql import functions as F

from wayfare.llm import queries, urls


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def stated(host, path):
    fitting = []
    for verdict, rule in urls.RULES:
        domain, rest = rule.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest):
            fitting.append((len(rule), verdict, rule))
    return max(fitting)[1:] if fitting else (None, None)


ODD = [
    None, "", "no scheme", "http://", "https://A.Example.ORG/es/x", "http://example.org/en/1", "http://example.org/en/2", "http://notexample.org/en/1",
    "http://example.org?x=1", "http://example.org", "ftp://a.com/fr/q#f", "x://b.com/de/", "http://com/de/1", "http://u://v.com/de/", "http://É.com/fr/", "a\nb://c.com/de/\n?z",
    "http://org/", "http://org.com/", "http://x.org:80/", "HTTP://WWW.EXAMPLE.ORG/ES/", "://q.org/a",
]


def test_hosts_paths_and_stated_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*ODD, *ODD])], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = urls.judged(pages, labels).collect()
    assert len(rows) == 2 * len(ODD)
    for r in rows:
        host, path = parts(ODD[r["page_id"] % len(ODD)])
        verdict, rule = stated(host, path)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")
    assert urls.judged(pages.limit(0), labels).collect() == []


def brute_rules(transactions, support, confidence):
    """Token sets that go with bad pages, smallest first, by counting all combinations."""
    found = {}
    tokens = sorted({t for items, _ in transactions for t in items})
    for size in (1, 2, 3, 4):
        for combo in combinations(tokens, size):
            inside = [bad for items, bad in transactions if set(combo) <= items]
            if sum(inside) and sum(inside) / len(transactions) >= support and sum(inside) / len(inside) >= confidence:
                found[combo] = sum(inside) / len(inside)
    return {c: v for c, v in found.items() if not any(set(o) < set(c) for o in found)}


def planted():
    """Only the combination of a domain and a path is bad, and one domain by itself."""
    rows = []
    for i in range(240):
        host, path = ("a.net", "b.net", "bad.net")[i % 3], ("x", "y")[i // 3 % 2]
        rows.append((i, f"http://{host}/{path}/{i}", int(not (host == "bad.net" or (host == "b.net" and path == "y")))))
    return rows


def test_mined_rules_equal_brute_force_and_block(spark):
    rows = planted()
    pages = spark.createDataFrame([(i, u) for i, u, _ in rows] + [(1000, "http://b.net/y/777"), (1001, "http://b.net/x/1"), (1002, "http://sub.bad.net/z"), (1003, "http://b.com/y"), (None, "http://bad.net/")], "page_id long, url string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(5, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    tokens = {r["page_id"]: frozenset(r["t"]) for r in pages.select("page_id", urls.tokens_of(pages.url).alias("t")).collect()}
    expected = brute_rules([(tokens[i], not q) for i, _, q in rows], 0.05, 0.8)
    got = {tuple(r["items"]): round(r["confidence"], 9) for r in urls.mined_rules(pages, labels, 0.05, 0.8).collect()}
    assert got == {c: round(v, 9) for c, v in expected.items()} and got
    verdicts = {r["page_id"]: r["verdict"] for r in urls.judged(pages, labels, min_support=0.05).collect()}
    for page, items in tokens.items():
        if page is not None and page != 1003:
            assert verdicts[page] == ("block" if any(set(c) <= items for c in expected) else "allow")
    assert verdicts[1000] == "block" and verdicts[1001] == "allow" and verdicts[None] == "block"


def test_query(spark):
    rows = queries.op8_url_filters(spark, SMALL).collect()
    given = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(rows) == len(given)
    for r in rows:
        host, path = parts(given[r["page_id"]])
        verdict, rule = stated(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or ("allow" if r["confidence"] is None else "block"))


@pytest.mark.parametrize("url, expected", [(None, {"path="} - {"path="}), ("http://m.a.b.net/x/12/13?k=1&j#f", {"scheme=http", "domain=b.net", "domain=a.b.net", "domain=m.a.b.net", "label=host:m", "path=x", "path=0", "query=k", "query=j", "fragment"})])
def test_tokens(spark, url, expected):
    frame = spark.createDataFrame([(url,)], "url string")
    assert set(frame.select(urls.tokens_of(frame.url)).first()[0]) - {"label=host:"} == expected


def test_labels_are_those_of_the_document_in_the_path(spark):
    """A bad host whose page_ids are the doc_ids of good documents, and the other way round."""
    endings = ("", "/", ".html", "?page=2&ref=x", "#top")
    pages = [(k, f"http://{'bad' if k < 60 else 'fine'}.net/en/{1000 + k}{endings[k % 5]}") for k in range(120)]
    pages += [(1000 + k, f"http://other.org/{path}") for k, path in enumerate(("", "en/x", "9" * 30, "1000x", "en/7-1000"))]
    labels = [(1000 + k, int(k >= 60), 0) for k in range(120)] + [(k, int(k < 60), 0) for k in range(120)]
    pages = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = urls.judged(pages, labels).collect()
    assert {r["host"] for r in rows if r["verdict"] == "block"} == {"bad.net"} and len(rows) == 125
    assert all(r["confidence"] == 1.0 for r in rows if r["host"] == "bad.net")


def test_one_bad_host_among_very_many_pages(spark):
    """Support is a number of pages: numbered hosts and long ones are told apart, however few of the pages are theirs."""
    k = F.col("id")
    host = F.when(k < 12, "site7.a.pages.net").when(k < 23, "site8.a.pages.net").otherwise(F.concat(F.lit("site"), k % 500 + 10, F.lit(".a.pages.net")))
    pages = spark.range(20_000).select(k.alias("page_id"), F.concat(F.lit("http://"), host, F.lit("/p"), k % 700, F.lit("/"), k).alias("url"))
    labels = spark.range(20_000).select(k.alias("doc_id"), (k >= 23).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    rows = urls.judged(pages, labels).where("verdict = 'block'").collect()
    assert {r["host"] for r in rows} == {"site7.a.pages.net"} and len(rows) == 12


@pytest.mark.parametrize("url, doc_id", [(None, None), ("http://a.net/en/12", 12), ("http://a.net/en/12/?q=3", 12), ("http://a.net/3/12.html#4", 12), ("http://a.net/12/x", None), ("http://12", None), ("http://a.net/" + "9" * 30, None)])
def test_document_of(spark, url, doc_id):
    assert spark.createDataFrame([(url,)], "url string").select(urls.document_of(F.col("url"))).first()[0] == doc_id
