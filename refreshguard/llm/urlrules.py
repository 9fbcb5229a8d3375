"""Allow and block rules for urls, carried over to aliases by redirects and canonical links.

A rule names a host and the beginning of a path; of the rules that fit the longest decides, and an
explicit rule always stands, allow as well as block.  A url without a rule is blocked if one of its
aliases is: the redirects (``meta`` refresh) and canonical links of the pages are edges between
urls, connected components over them are the alias classes, and a class with a blocked url is
blocked but for the members that a rule allows.  The other end of an edge need not be a page.

Everything is column functions and joins.  Keys that hold a thousandth of the edges are at most a
thousand, by arithmetic; the rows at such a key are salted, and so are rows that look up the class
of their alias.  Rounds are written to the shared folder.

Defined cases: a null url, and one without ``://``, has an empty host and path, fits no rule, is no
alias of anything and is allowed; a null or empty html has no edges; repeated rows and ids are rows
of their own; an empty table gives an empty result.  Of rules of one length the longer host wins, then
block.  Urls that differ in scheme, fragment, upper-case letters of the host, or in an
empty path and ``/``, are one url.  Of the input only ``page_id``, ``url`` and ``html`` are used, so
further columns may have any name.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import stored

#: The rules of the registered query as (verdict, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))

IN_PLAN = 500  # so many rules are literals of the plan; more are joined
HOT_SHARE = 1000  # a key with one such part of the edges is hot
SALTS = 16

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
LINK, META = r"(?i)<link\b[^>]*>", r"(?i)<meta\b[^>]*>"
CANONICAL = r"""(?i)\srel\s*=\s*(?:"[^"]*\bcanonical\b|'[^']*\bcanonical\b|canonical\b)"""
REFRESH = r"""(?i)\shttp-equiv\s*=\s*["']?refresh\b"""
HREF = r"""(?i)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
CONTENT = r"""(?i)\scontent\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
TARGET = r"""(?i)^[\s0-9.]*[;,]?\s*url\s*=\s*["']?([^"'\s]+)"""
UNSEEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>"
ABSOLUTE, SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://", r"^[A-Za-z][A-Za-z0-9+.-]*:"


# -- parts of urls ----------------------------------------------------------

def host_of(url: Column) -> Column:
    """From the first ``://`` up to a slash, question mark, hash or the end; A-Z as a-z."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")),
                       string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def alias_key(url: Column) -> Column:
    """What urls of the same page share; null without a host."""
    host, path = host_of(url), path_of(url)
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path),
                                       F.coalesce(F.regexp_extract(url, URL, 3), F.lit(""))))


def resolved(url: Column, target: Column) -> Column:
    """A link's target seen from a page; null for none, for the page itself and for other schemes.

    Dot segments stay as they are.
    """
    target = F.replace(F.trim(target), F.lit("&amp;"), F.lit("&"))
    base = F.concat(F.lit("http://"), host_of(url))
    folder = F.regexp_replace(path_of(url), "[^/]*$", "")
    return (F.when((target == "") | target.startswith("#") | (host_of(url) == ""), None)
            .when(target.rlike(ABSOLUTE), target)
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(target.rlike(SCHEME), None)
            .when(target.startswith("/"), F.concat(base, target))
            .when(target.startswith("?"), F.concat(base, path_of(url), target))
            .otherwise(F.concat(base, F.when(folder == "", "/").otherwise(folder), target)))


def _attribute(tag: Column, pattern: str) -> Column:
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): keys of two urls of one page, by a canonical link or a redirect in its html."""
    html = F.regexp_replace("html", UNSEEN, "")
    links = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(LINK), F.lit(0)), lambda t: t.rlike(CANONICAL)),
        lambda t: _attribute(t, HREF))
    redirects = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(META), F.lit(0)), lambda t: t.rlike(REFRESH)),
        lambda t: F.regexp_extract(_attribute(t, CONTENT), TARGET, 1))
    found = (pages.select("url", "html")
             .filter(F.col("url").isNotNull() & F.col("html").rlike(r"(?i)canonical|http-equiv"))
             .select("url", F.explode(F.concat(links, redirects)).alias("target")))
    keys = found.select(alias_key(F.col("url")).alias("a"),
                        alias_key(resolved(F.col("url"), F.col("target"))).alias("b"))
    return keys.filter("a is not null and b is not null and a <> b").distinct()


# -- rules ------------------------------------------------------------------

def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _fitting(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """All rules that could fit a url, as text, the longest first."""
    labels = F.split(host, r"\.")
    hosts = F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    sizes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    texts = F.flatten(F.transform(hosts, lambda h: F.transform(
        sizes, lambda n: F.struct(-(F.length(h) + n), -F.length(h),
                                  F.concat(h, F.substr(path, F.lit(1), n)).alias("rule")))))
    return F.transform(F.array_sort(texts), lambda x: x["rule"])


def with_rules(urls: DataFrame, rules: DataFrame, in_plan: int = IN_PLAN) -> DataFrame:
    """Rows with ``host`` and ``path``, with the ``rule`` that decides and its ``decided`` verdict.

    A few rules are literals, so the rows stay where they are; many are joined
    to the distinct hosts and paths by the text of each rule that could fit.
    """
    texts = rules.groupBy(F.concat("host", "path").alias("rule")).agg(
        F.max("verdict").alias("decided"))  # block after allow
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    fitting = _fitting(F.col("host"), F.col("path"), sorted(lengths))
    known = texts.limit(in_plan + 1).collect()
    if not known:
        none = F.lit(None).cast("string")
        return urls.withColumn("rule", none).withColumn("decided", none)
    if len(known) <= in_plan:
        names = F.array(*[F.lit(r["rule"]) for r in known])
        verdicts = F.map_from_arrays(names, F.array(*[F.lit(r["decided"]) for r in known]))
        rows = urls.withColumn("rule", F.try_element_at(
            F.filter(fitting, lambda x: F.array_contains(names, x)), F.lit(1)))
        return rows.withColumn("decided", F.try_element_at(verdicts, F.col("rule")))
    places = urls.select("host", "path").distinct()
    best = (places.select("host", "path", F.posexplode(fitting).alias("place", "rule"))
            .join(texts, "rule").groupBy("host", "path")
            .agg(F.min(F.struct("place", "rule", "decided")).alias("best"))
            .select("host", "path", "best.rule", "best.decided"))
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)) if "page_id" in urls.columns else F.lit(0)
    return (urls.withColumn("salt", salt)
            .join(_copies(best), ["host", "path", "salt"], "left").drop("salt"))


def _copies(rows: DataFrame) -> DataFrame:
    """Each row once for every salt."""
    first, last = F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")
    return rows.withColumn("salt", F.explode(F.sequence(first, last)))


# -- alias classes ------------------------------------------------------------

def alias_classes(edges: DataFrame) -> DataFrame:
    """(node, label): for each end of an edge (a, b) the least node that edges reach from it.

    A round gives every node the least label around it and then the label of
    that label, until none changes.
    """
    pairs = edges.select("a", "b")
    pairs = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .distinct(), "aliases")
    total = pairs.count()
    # The counts add up to the number of edges, so this list has at most HOT_SHARE rows.
    hot = stored(pairs.groupBy(F.col("b").alias("node")).count()
                 .filter((F.col("count") * HOT_SHARE >= total) & (F.col("count") > SALTS))
                 .select("node", F.lit(True).alias("hot")), "hot")
    around = stored(
        pairs.join(F.broadcast(hot.withColumnRenamed("node", "b")), "b", "left")
        .select("a", "b", F.when(F.col("hot"), F.pmod(F.xxhash64("a"), F.lit(SALTS)))
                .otherwise(F.lit(0).cast("long")).alias("salt")), "around")
    labels = stored(pairs.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        given = labels.join(F.broadcast(hot), "node", "left").select(
            F.col("node").alias("b"), F.col("label").alias("near"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("hot"), F.lit(SALTS - 1))
                                 .otherwise(0).cast("long"))).alias("salt"))
        near = (around.join(given, ["b", "salt"]).groupBy(F.col("a").alias("node"))
                .agg(F.min("near").alias("near")))
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"),
            F.pmod(F.xxhash64("node"), F.lit(SALTS)).alias("salt"))
        roots = _copies(lower.select("label").distinct().join(
            labels.select(F.col("node").alias("label"), F.col("label").alias("root")), "label"))
        labels = stored(lower.join(roots, ["label", "salt"], "left").select(
            "node", "old", F.least("label", "root").alias("label")), "labels")
        if labels.filter("label < old").isEmpty():
            return labels.select("node", "label")


def blocked_aliases(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """(node): the keys of all urls in an alias class with a blocked url."""
    labels = alias_classes(edges)
    url = F.concat(F.lit("x://"), F.col("node"))
    ruled = with_rules(labels.select("node", "label", host_of(url).alias("host"),
                                     path_of(url).alias("path")), rules)
    bad = _copies(ruled.filter(F.col("decided") == "block").select("label").distinct())
    salted = labels.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    return salted.join(bad, ["label", "salt"]).select("node")


# -- pages --------------------------------------------------------------------

def judged(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages``.

    ``edges`` (a, b) are pairs of ``alias_key``; by default those in the html.
    """
    url = F.col("url")
    rows = with_rules(pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"),
                                   alias_key(url).alias("node")), rules)
    edges = stored(alias_edges(pages) if edges is None else edges, "edges")
    result = ["page_id", "host", "path", "rule"]
    if edges.isEmpty():
        return rows.select(*result, F.coalesce("decided", F.lit("allow")).alias("verdict"))
    bad = _copies(blocked_aliases(edges, rules)).withColumn("bad", F.lit("block"))
    # Rows with a rule have no use for the join: they look up nothing.
    rows = rows.withColumn("node", F.when(F.col("rule").isNull(), F.col("node"))).withColumn(
        "salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)))
    return rows.join(bad, ["node", "salt"], "left").select(
        *result, F.coalesce("decided", "bad", F.lit("allow")).alias("verdict"))
