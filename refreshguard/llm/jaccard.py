"""Self-join of documents by the Jaccard similarity of their word shingles.

Adaptive multi-match prefixes.  Shingles have one global order, rare ones
first.  Two sets of similarity t or more share at least k of the first
``n - ceil(t n) + k`` shingles of each, for any k.  With k = 1 a document that
begins with frequent shingles would meet many others; such a document gets a
larger k, chosen to make the estimated cost of its candidates and its longer
prefix least, and a pair is verified only if it shares as many prefix shingles
as the smaller k of the two.

Steps, each a job over rows that Spark partitions:

1. a sketch of shingle frequencies, of bounded size, gives the order; it only
   steers the work, any order gives right results;
2. documents with equal sets form a class; classes post their prefix shingles;
   shingles that only one class posts are dropped in the same pass;
3. every class is verified against one hub, the most typical of the classes that
   share its shingles.  Groups of near copies fall together here, at one pair a
   member;
4. all remaining pairs of classes in different components that share enough
   prefix shingles are verified;
5. components of the links.

No pair is left out: pairs inside a component that is known already cannot
change it.  Sets are compared exactly (by their 64-bit hashes), from texts that
travel compressed, once for each pair.

Defined cases: a null text, or one without words, has the empty set, links with
nothing and is its own component (so its id may be null); a text of one to four
words is one shingle; rows with equal sets are linked, repeated rows too; a
component takes the least id that is not null; an empty table gives an empty
result; further columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import small_batches
from .components import components
from .shingles import set_key, shingle_sets

PERCENT = 75
LEAST_BITS, MOST_BITS = 16, 24  # of the sketch: buckets for 16 times the documents, within bounds
BLOCK = 1 << 12
MATCHES = np.array([1, 2, 3, 4, 6, 8, 12, 16])
POSTING_COST = 1.0  # of one more shingle in a prefix, in verified pairs' worth of estimated meetings
KEYS = 1_000_000  # documents to drop that are broadcast, by two numbers each; beyond it they are joined
SIGNATURE = 16  # words of 64 bits
HELD = 500_000  # shingles that verification keeps for the next pair
SEEN = 1 << 17  # classes that a task remembers having posted


# -- the order of shingles --------------------------------------------------

def survey(docs: DataFrame, bits: int) -> DataFrame:
    """One pass over the texts: a row for each document, and blocks of counts.

    A document has doc_id, text_hash, n_shingles and class.  The class is a hash of the set, null for the empty set.  Each task counts
    shingles in 2^bits buckets and adds the counts as compressed blocks at its
    end; in these rows ``block`` is not null.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, text_hash long, n_shingles long, class long, block int, "
              "counts binary")

    def scan(batches):
        counts = np.zeros(1 << bits, dtype=np.uint32)
        for batch in batches:
            sizes, keys = [], []
            for s in shingle_sets(batch["text"]):
                counts[s & ((1 << bits) - 1)] += 1
                sizes.append(len(s))
                keys.append(set_key(s) if len(s) else None)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_hash": batch["text_hash"],
                                "n_shingles": sizes, "class": pd.array(keys, "Int64"), "block": pd.array(
                [None] * len(sizes), "Int32"), "counts": None})
        part = counts.reshape(-1, BLOCK)
        used = np.flatnonzero(part.any(1))
        for k in range(0, len(used), 64):
            some = used[k:k + 64]
            none = pd.array([None] * len(some), "Int64")
            yield pd.DataFrame({"doc_id": none, "text_hash": none, "n_shingles": none,
                                "class": none, "block": some.astype("int32"),
                                "counts": [zlib.compress(part[i].tobytes(), 1) for i in some]})

    return docs.select("doc_id", "text", _text_hash().alias("text_hash")).mapInPandas(scan, schema)


def _text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def order_levels(blocks: DataFrame, bits: int) -> np.ndarray:
    """A level for each bucket of shingles: 0 for usual ones, then by the logarithm of the excess."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BLOCK, dtype=np.int64)
        for batch in batches:
            block = batch["block"].iloc[:1].tolist()
            for c in batch["counts"]:
                total += np.frombuffer(zlib.decompress(c), dtype=np.uint32)
        yield pd.DataFrame({"block": block, "counts": [total.tobytes()]})

    summed = blocks.groupBy("block").applyInPandas(add, "block int, counts binary")
    total = np.zeros(1 << bits, dtype=np.int64)
    for row in summed.collect():  # at most 2^bits / BLOCK rows
        total[row["block"] * BLOCK:(row["block"] + 1) * BLOCK] = np.frombuffer(
            row["counts"], dtype=np.int64)
    usual = float(np.median(total))
    excess = np.maximum(total - usual, 0)
    level = np.where(excess > 4 * np.sqrt(usual) + 4,
                     1 + np.floor(4 * np.log2(np.maximum(excess, 1))), 0)
    return level.astype(np.uint8)


def prefix(shingles: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, int, int]:
    """The prefix of a set in the global order, how many of it two similar sets must share, and its end.

    The end is the place of the last shingle in the global order.
    """
    n = len(shingles)
    need = -(-PERCENT * n // 100)
    level = levels[shingles & (len(levels) - 1)]
    order = np.lexsort((shingles, level))
    matches = MATCHES[MATCHES <= need]
    meets = np.cumsum(np.where(level[order] > 0, np.exp2((level[order] - 1.0) / 4), 0.0))
    lengths = n - need + matches
    cost = POSTING_COST * lengths + meets[lengths - 1] / matches
    best = int(cost.argmin())
    last = order[lengths[best] - 1]
    end = (int(level[last]) << 56) + (int(shingles[last]) >> 9)
    return shingles[order[:lengths[best]]], int(matches[best]), end


# -- postings ---------------------------------------------------------------

def postings(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(shingle, class, n, at, matches, end, met): prefix shingles that ``met`` > 1 classes post."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # at most 2^MOST_BITS bytes

    def post(batches):
        seen: set[int] = set()
        for batch in batches:
            parts = []
            for s in shingle_sets(batch["text"]):
                if not len(s) or (key := set_key(s)) in seen:
                    continue
                if len(seen) >= SEEN:  # only spares repeats, which are dropped later anyway
                    seen.clear()
                seen.add(key)
                first, matches, end = prefix(s, shared.value)
                parts.append((first, key, len(s), matches, end))
            if parts:
                size = [len(p[0]) for p in parts]
                yield pd.DataFrame({
                    "shingle": np.concatenate([p[0] for p in parts]),
                    "class": np.repeat([p[1] for p in parts], size),
                    "n": np.repeat([p[2] for p in parts], size).astype("int32"),
                    "at": np.concatenate([np.arange(k, dtype="int32") for k in size]),
                    "matches": np.repeat([p[3] for p in parts], size).astype("int32"),
                    "end": np.repeat(np.array([p[4] for p in parts], dtype=np.int64), size)})

    rows = docs.select("text").mapInPandas(
        post, "shingle long, class long, n int, at int, matches int, end long")
    own = Window.partitionBy("shingle")
    return (rows.withColumn("low", F.min("class").over(own))
            .withColumn("high", F.max("class").over(own))
            .withColumn("met", F.count("*").over(own)).filter("low < high")
            .drop("low", "high").dropDuplicates(["shingle", "class"]))


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, packed): one text of each wanted class, and of the few others that share its bit."""
    wanted = wanted.distinct()
    bits = min(27, max(12, (16 * wanted.count()).bit_length()))
    mask = (1 << bits) - 1
    words = (wanted.select(F.col("class").bitwiseAND(F.lit(mask)).alias("bit")).distinct()
             .groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("set")))
    found = words.toPandas()  # at most 2^bits / 64 rows
    bitmap = np.zeros((1 << bits) >> 6, dtype=np.int64)
    bitmap[found["word"].to_numpy(np.int64)] = found["set"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def pack(batches):
        bitmap = shared.value
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for text, s in zip(batch["text"], shingle_sets(batch["text"])):
                if not len(s) or (key := set_key(s)) in seen:
                    continue
                bit = key & mask
                if int(bitmap[bit >> 6]) >> (bit & 63) & 1:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(key)
                    rows.append((key, zlib.compress(text.encode("utf-8", "surrogatepass"), 1)))
            yield pd.DataFrame(rows, columns=["class", "packed"])

    return docs.select("text").mapInPandas(pack, "class long, packed binary").dropDuplicates(["class"])


# -- verification -----------------------------------------------------------

def similar(texts_a: Iterator, texts_b: Iterator) -> list[bool]:
    """Whether each pair of packed texts reaches the similarity."""
    kept: dict[bytes, np.ndarray] = {}
    room = HELD

    def shingles(packed: bytes) -> np.ndarray:
        nonlocal room
        if packed not in kept:
            text = zlib.decompress(packed).decode("utf-8", "surrogatepass")
            found = next(shingle_sets([text]))
            room -= len(found)
            if room < 0:
                kept.clear()
                room = HELD - len(found)
            kept[packed] = found
        return kept[packed]

    out = []
    for a, b in zip(texts_a, texts_b):
        x, y = shingles(a), shingles(b)
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(100 * both >= PERCENT * (len(x) + len(y) - both))
    return out


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that reach the similarity."""
    pairs = stored(pairs, "pairs")
    if pairs.isEmpty():
        return pairs
    texts = stored(texts_of(docs, pairs.select(F.col("a").alias("class")).unionByName(
        pairs.select(F.col("b").alias("class")))), "texts")

    @F.pandas_udf("boolean")
    def linked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series(similar(a, b))

    left = texts.select(F.col("class").alias("a"), F.col("packed").alias("text_a"))
    right = texts.select(F.col("class").alias("b"), F.col("packed").alias("text_b"))
    return (pairs.join(left, "a").join(right, "b").filter(linked("text_a", "text_b"))
            .select("a", "b"))


def _possible(shared, x: str, y: str):
    """Whether two sets can still be similar, by their sizes and where they last met in their prefixes.

    Behind its last common prefix shingle a set has ``n - at - 1`` shingles left.
    """
    most = shared + F.least(F.expr(f"{x}n - {x}at - 1"), F.expr(f"{y}n - {y}at - 1"))
    return most * (100 + PERCENT) >= PERCENT * F.expr(f"{x}n + {y}n")


def hub_pairs(posted: DataFrame) -> DataFrame:
    """For each class the hub it shares most posted shingles with, if they can be similar.

    The hub of a shingle is the poster whose own shingles are met most often: of
    a group of near copies the one that the others differ from least.
    """
    weight = posted.groupBy("class").agg(F.sum("met").alias("weight"))
    rows = posted.join(weight, "class")
    hubs = rows.groupBy("shingle").agg(F.max_by(
        F.struct("class", "n", "at"), F.struct("weight", "class")).alias("hub"))
    met = (posted.join(hubs, "shingle").filter(F.col("hub.class") != F.col("class"))
           .groupBy("class", F.col("hub.class").alias("hub")).agg(
               F.count("*").alias("shared"), F.first("n").alias("x_n"), F.max("at").alias("x_at"),
               F.first("hub.n").alias("y_n"), F.max("hub.at").alias("y_at"))
           .filter(_possible(F.col("shared"), "x_", "y_")))
    best = met.groupBy("class").agg(F.max_by("hub", F.struct("shared", "hub")).alias("b"))
    return best.select(F.col("class").alias("a"), "b")


def remaining_pairs(posted: DataFrame) -> DataFrame:
    """All pairs of classes in different components that share enough posted shingles, and can be similar.

    Three bounds on what two sets have in common hold where they meet, so that a
    large group of texts that are alike, but not enough, makes few rows: their
    sizes; what stands before and behind the common shingle in both; and, from a
    signature of the posted shingles (a bit each), how many of these they can
    share, with what stands behind the prefix that ends first.  ``crowded`` counts
    shingles beyond the first of a bit; they may all be common.
    """
    need = F.expr(f"ceil(n * {PERCENT} / 100.0)")
    code = F.pmod(F.shiftright("shingle", 13), F.lit(64 * SIGNATURE))
    bits = [F.bit_or(F.when(F.floor(code / 64) == k, F.expr(
        f"shiftleft(1L, cast(pmod(shiftright(shingle, 13), {64 * SIGNATURE}) % 64 as int))"))
        .otherwise(F.lit(0).cast("long"))).alias(f"s{k}") for k in range(SIGNATURE)]
    own = posted.groupBy("class").agg(
        *bits, F.count("*").alias("posts"), F.first(need - F.col("matches")).alias("behind"))
    held = " + ".join(f"bit_count(s{k})" for k in range(SIGNATURE))
    rows = posted.join(own.withColumn("crowded", F.expr(f"posts - ({held})")).drop("posts"), "class")
    a, b = rows.alias("x"), rows.alias("y")
    size = (100 * F.least("x.n", "y.n") >= PERCENT * F.greatest("x.n", "y.n"))
    both = F.expr("x.n + y.n") * PERCENT
    here = F.least("x.at", "y.at") + 1 + F.least(F.expr("x.n - x.at - 1"), F.expr("y.n - y.at - 1"))
    common = F.expr(" + ".join(f"bit_count(x.s{k} & y.s{k})" for k in range(SIGNATURE))
                    + " + least(x.crowded, y.crowded)")
    behind = F.expr("case when x.end < y.end then x.behind when y.end < x.end then y.behind "
                    "else greatest(x.behind, y.behind) end")
    met = a.join(b, (F.col("x.shingle") == F.col("y.shingle")) & size
                 & (F.col("x.component") < F.col("y.component"))
                 & (here * (100 + PERCENT) >= both)
                 & (common >= F.least("x.matches", "y.matches"))
                 & ((common + behind) * (100 + PERCENT) >= both))
    return (met.groupBy(F.col("x.class").alias("a"), F.col("y.class").alias("b"))
            .agg(F.count("*").alias("shared"),
                 F.first(F.least("x.matches", "y.matches")).alias("needed"),
                 F.first("x.n").alias("x_n"), F.max("x.at").alias("x_at"),
                 F.first("y.n").alias("y_n"), F.max("y.at").alias("y_at"))
            .filter((F.col("shared") >= F.col("needed")) & _possible(F.col("shared"), "x_", "y_"))
            .select("a", "b"))


def _still_open(posted: DataFrame, found: DataFrame) -> DataFrame:
    """The postings with their component, of shingles that lead to more than one component."""
    rows = posted.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        *posted.columns, F.coalesce("component", "class").alias("component"))
    own = Window.partitionBy("shingle")
    return (rows.withColumn("low", F.min("component").over(own))
            .withColumn("high", F.max("component").over(own)).filter("low < high")
            .drop("low", "high"))


def links(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(node, component) of the classes that are linked with another class."""
    posted = stored(postings(docs, levels), "postings")
    first = stored(verified(hub_pairs(posted), docs), "verified")
    rest = stored(_still_open(posted, components(first)), "open")
    more = stored(verified(remaining_pairs(rest), docs), "verified")
    return components(first.unionByName(more))


def grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, group, component_id, class_id) of each row.

    ``group`` names a component also where ids are null; the empty set has none.
    """
    small_batches(docs.sparkSession)
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * docs.count()).bit_length()))
    scanned = stored(survey(docs, bits), "survey")
    levels = order_levels(scanned.filter("block is not null").select("block", "counts"), bits)
    summary = scanned.filter("block is null").select("doc_id", "text_hash", "n_shingles", "class")
    found = links(docs, levels).withColumnRenamed("node", "class")
    least = summary.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("class_id"))
    parts = stored(least.join(found, "class", "left").select(
        "class", "class_id", F.coalesce("component", "class").alias("group")), "groups")
    roots = parts.groupBy("group").agg(F.min("class_id").alias("component_id"))
    named = parts.join(roots, "group").select("class", "class_id", "group", "component_id")
    own = F.col("class").isNull()
    return summary.join(named, "class", "left").select(
        "doc_id", "text_hash", "n_shingles", "group",
        F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id): the least ids of a document's component and class."""
    return grouped(docs).select("doc_id", "n_shingles", "component_id", "class_id")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The documents, with their own columns: one of each component (its least id) and all without words."""
    rows = stored(grouped(docs).filter("group is not null").select(
        "group", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
        .alias("key")), "members")
    kept = rows.groupBy("group").agg(F.min("key").alias("kept"))
    # One row a distinct key: whether it stays, and how many rows have it.
    keys = rows.join(kept, "group").groupBy("key").agg(
        F.count("*").alias("rows"), F.max(F.col("key") == F.col("kept")).alias("stays"))
    odd = stored(keys.filter("not stays or rows > 1").select(
        F.col("key.doc_id").alias("odd_id"), F.col("key.text_hash").alias("odd_hash"), "stays"),
        "dropped")
    if odd.count() <= KEYS:
        odd = F.broadcast(odd)
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
                        docs["doc_id"].alias("doc_id"),
                        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("text_hash"))
    met = whole.join(odd, F.col("doc_id").eqNullSafe(F.col("odd_id"))
                     & (F.col("text_hash") == F.col("odd_hash")), "left")
    single = met.filter(F.col("odd_hash").isNull())
    repeated = met.filter("stays").dropDuplicates(["doc_id", "text_hash"])
    return single.unionByName(repeated).select("doc.*")
