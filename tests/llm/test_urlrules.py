"""Verdicts of urls: rules, aliases over links and redirects, against a plain search and SQL."""

from __future__ import annotations

import random
from collections import defaultdict

import duckdb
import pyarrow as pa
import pytest

from refreshguard.llm import oracles, urlrules

SCHEMA = "page_id long, url string, html string, node string, rule string, salt long, host string"
PAGES = [
    (1, "http://a.net/x", '<link rel="canonical" href="https://www.example.com/de/7">'),
    (2, "HTTP://WWW.Example.COM/de/7#t", ""),
    (3, "http://b.net", None),
    (4, "https://c.org/q?z=1", '<meta http-equiv=refresh content="0; url=//a.net/x">'),
    (5, "nope", '<link rel=canonical href="http://example.com/de/">'),
    (6, None, '<link rel=canonical href="http://example.com/de/">'),
    (7, "http://d.net/p/q.html", "<LINK HREF='r.html' REL='shortlink canonical'>"),
    (8, "http://d.net/p/r.html#a", "<meta content='5;URL=/z' http-equiv='Refresh'>"),
    (9, "http://d.net/z", "<!-- <link rel=canonical href=http://e.com/de/1> -->"
                          "<script>'<link rel=canonical href=http://e.com/de/1>'</script>"),
    (10, "ftp://x.example.org/en/148.html", ""),
    (11, "http://d.net/z?p=1", "<link rel=canonical href='http://x.example.org/es/a&amp;b'>"),
    (12, "http://f.net", "<link rel=canonical href='http://f.net/'>"),
    (13, "http://g.net/i", "<link rel=stylesheet href='http://example.com/de/x'>"),
    (14, "http://h.net/i/", "<link rel=canonical href='mailto:a@example.com'>"),
    (15, "http://k.net/one", "<link rel=canonical href='http://d.net/z?p=1'>"),
    (16, "http://m.net/a", "<link rel=canonical href='?page=2'>"),
    (17, "http://m.net/a?page=2", "<link rel=canonical href='//example.com/de/q'>"),
    (18, "http://x.com/fr/1", "<link rel=canonical href='//example.com/de/q'>"),
    (1, "http://a.net/x", ""), (None, "http://a.net/x", "x" * 100_000)]


def make(spark, pages):
    return spark.createDataFrame([(*p, "n", "r", 1, "h") for p in pages], SCHEMA)


def found(frame):
    return sorted(map(str, map(tuple, frame.select(
        "page_id", "host", "path", "rule", "verdict").collect())))


def test_verdicts(spark):
    rows = urlrules.judged(make(spark, PAGES), urlrules.rule_table(spark)).collect()
    verdicts = defaultdict(set)
    for r in rows:
        verdicts[r["page_id"]].add((r["rule"], r["verdict"]))
    assert len(rows) == len(PAGES)
    blocked = {i for i, v in verdicts.items() if {x[1] for x in v} == {"block"}}
    # By rule 2 and 10; as aliases 1 (and its copies), 11, 15, 16 and 17.
    assert blocked == {1, 2, 10, 11, 15, 16, 17, None}
    assert verdicts[4] == {("org/", "allow")} and verdicts[18] == {("com/fr/", "allow")}
    assert verdicts[10] == {("example.org/en/1", "block")}
    assert {(r["host"], r["path"]) for r in rows if r["page_id"] in (5, 6)} == {("", "")}


def test_sql_of_planted_pages(spark):
    columns = dict(zip(("page_id", "url", "html"), zip(*PAGES)))
    pages = pa.table(columns)  # noqa: F841 - read by DuckDB
    rows = duckdb.sql(f"select page_id, host, path, rule, verdict from ({oracles.OP13})").fetchall()
    assert sorted(map(str, rows)) == found(
        urlrules.judged(make(spark, PAGES), urlrules.rule_table(spark)))


def test_no_pages(spark):
    nothing = make(spark, []).limit(0)
    assert urlrules.judged(nothing, urlrules.rule_table(spark)).count() == 0
    bare = urlrules.judged(make(spark, PAGES[:3]), urlrules.rule_table(spark, []))
    assert {r["verdict"] for r in bare.collect()} == {"allow"}


def test_joined_rules_decide_like_literals(spark):
    rules = [("block", "net", "/"), ("allow", "a.net", "/x"), ("block", "b.a.net", "/"),
             ("allow", "d.net", "/p/"), ("block", "d.net", "/p/q"), ("allow", "d.net", "/p/q"),
             ("block", "example.com", "/de/7/"), *urlrules.RULES]
    table = urlrules.rule_table(spark, rules)
    pages = make(spark, PAGES)
    urls = pages.select("page_id", urlrules.host_of(pages["url"]).alias("host"),
                        urlrules.path_of(pages["url"]).alias("path"))
    few = urlrules.with_rules(urls, table).select("page_id", "host", "path", "rule", "decided")
    many = urlrules.with_rules(urls, table, 2).select("page_id", "host", "path", "rule", "decided")
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))

    def plain(host, path):
        fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[3:] if fits else (None, None)

    for r in few.collect():
        assert (r["rule"], r["decided"]) == plain(r["host"], r["path"])


@pytest.mark.parametrize("seed", [1, 2])
def test_classes(spark, seed):
    choose = random.Random(seed)
    edges = [(f"n{choose.randrange(200)}", f"n{choose.randrange(200)}") for _ in range(110)]
    edges += [("hub", f"h{i}") for i in range(150)]  # half of all edges at one node
    edges += [(f"p{i:03}", f"p{i + 1:03}") for i in range(40)]
    edges = [e for e in edges if e[0] != e[1]]
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    least = {}
    for node in sorted(near):
        todo = [] if node in least else [node]
        while todo:
            at = todo.pop()
            if at not in least:
                least[at] = node
                todo += near[at]
    labels = urlrules.alias_classes(spark.createDataFrame(edges, "a string, b string"))
    assert {r["node"]: r["label"] for r in labels.collect()} == least


def test_given_edges_come_before_those_of_the_html(spark):
    edges = spark.createDataFrame([("b.net/", "deep.example.com/de/"), ("b.net/", "x.com/fr/1")],
                                  "a string, b string")
    rows = urlrules.judged(make(spark, PAGES), urlrules.rule_table(spark), edges).collect()
    by_id = {r["page_id"]: r["verdict"] for r in rows}
    assert by_id[3] == "block" and by_id[18] == "allow" and by_id[1] == "allow"
