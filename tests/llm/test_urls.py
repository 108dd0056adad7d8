"""URL verdicts against rules and components worked out row by row."""

from __future__ import annotations

import random
from urllib.parse import urljoin

from pyspark.sql import functions as F

from clicklens.llm.queries import URL_RULES
from clicklens.llm.urls import judge_urls

PAGES = "page_id bigint, url string, html string"


def split(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1].split("#")[0]
    cut = min([i for i in (rest.find("/"), rest.find("?")) if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, rest[cut:].split("?")[0], (host + rest[cut:]) if host else None


def rule_for(host, path):
    fits = [
        r for r in URL_RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.text), default=None)


def plain(pages, links):
    parent: dict[str, str] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = split(a)[2], split(b)[2]
        if a and b and a != b:
            parent[find(a)] = find(b)
    met: dict[str, set] = {}
    for x in list(parent):
        host, _, rest = x.partition("/")
        host, path, _ = split("://" + x)
        rule = rule_for(host, path)
        if rule:
            met.setdefault(find(x), set()).add(rule.verdict)
    rows = []
    for page_id, url, _ in pages:
        host, path, address = split(url)
        rule = rule_for(host, path)
        if rule:
            rows.append((page_id, host, path, rule.text, rule.verdict, "rule"))
        elif address in parent and met.get(find(address)) == {"block"}:
            rows.append((page_id, host, path, None, "block", "alias"))
        else:
            rows.append((page_id, host, path, None, "allow", "default"))
    return rows


def judged(spark, pages, redirects=None):
    rows = judge_urls(spark.createDataFrame(pages, PAGES), URL_RULES, redirects).collect()
    return sorted(map(tuple, rows), key=repr)


def test_rules_and_links_against_plain_version(spark):
    rng = random.Random(1)
    hosts = ["a.org", "b.ORG", "com", "x.example.com", "www.example.com", "q.net", "c.info:80", "netcom"]
    places = ["", "/", "/en/1", "/EN/1", "/es/2?x=://y", "/fr/#t", "/de/3", "?q=1"]
    pages, links = [], []
    for i in range(150):
        url = f"http{'s' * (i % 2)}://{rng.choice(hosts)}{rng.choice(places)}{i % 40 if i % 3 else ''}"
        target, html = None, f"<p>page {i}</p>"
        kind = rng.randrange(5)
        if kind == 0:
            target = f"https://{rng.choice(hosts)}{rng.choice(places)}{rng.randrange(40)}"
            html = f"<head><LINK Rel=canonical href='{target}'></head>"
        elif kind == 1:
            target = f"http://{rng.choice(hosts)}{rng.choice(places)}{rng.randrange(40)}"
            html = f'<meta content="0; URL={target}" http-equiv="refresh">'
        elif kind == 2:
            html = '<!-- <link rel="canonical" href="http://q.net/es/"> --><script>"<link rel=canonical href=http://q.net/es/>"</script>'
        if target:
            links.append((url, target))
        pages.append((i, url, html))
    pages += [pages[3], pages[3], (None, None, None), (None, "no address", "x"), (7, "://", None), (8, "a.org/en/", "")]
    assert judged(spark, pages) == sorted(plain(pages, links), key=repr)


def test_relative_links_and_given_redirects(spark):
    pages, redirects = [], []
    for i, link in enumerate(("http://b.org/k", "//q.org/fr/1", "/es/2", "z/w?a=b&amp;c", "?page=2")):
        base = f"http://a{i}.org/x/y.html?z=1#t"
        to = urljoin(base, link.replace("&amp;", "&"))
        pages += [(i, base, f'<link href="{link}" rel="nofollow canonical">'), (i, to, "")]
        redirects.append((to, f"http://b.net/es/{i}"))
    pages.append((9, "http://a.org/other", "<link rel=canonical>"))
    given = spark.createDataFrame(redirects, "from_url string, to_url string")
    assert [row[4] for row in judged(spark, pages, given)] == ["block"] * 10 + ["allow"]


def test_an_allowed_address_keeps_its_resource_open(spark):
    redirects = spark.createDataFrame(
        [("http://a.org/", "http://b.net/es/1"), ("http://c.org/", "http://d.org/"), ("http://d.org/", "http://b.net/fr/"),
         ("http://a.org/", "http://k.com/")],
        "from_url string, to_url string",
    )
    pages = [(1, "http://a.org/", ""), (2, "http://c.org/", None), (3, "http://b.net/es/1", ""), (4, "http://e.org/", "")]
    got = {row[0]: row[4:] for row in judged(spark, pages, redirects)}
    assert got == {1: ("allow", "default"), 2: ("block", "alias"), 3: ("block", "rule"), 4: ("allow", "default")}


def test_clashing_columns_long_pages_and_no_pages(spark):
    long = "<link " * 50_000 + "<!--" * 50_000 + "canonical refresh"
    pages = spark.createDataFrame([(1, "http://a.com/", long)], PAGES).withColumns(
        {c: F.lit("clash") for c in ("host", "path", "rule", "verdict", "address", "alias_of", "node", "link", "tag")}
    )
    assert [tuple(r)[3:5] for r in judge_urls(pages, URL_RULES).collect()] == [("com/", "allow")]
    assert judge_urls(spark.createDataFrame([], PAGES), URL_RULES).count() == 0
