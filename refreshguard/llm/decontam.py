"""Benchmark passages in documents, found by spaced seeds.

A mask such as ``11011011`` picks some positions of a window of words and
ignores the others, so a window still meets its original when words at ignored
positions were replaced.  The hashes of all masked windows of the benchmark are
joined with those of the documents.  Around each hit, document and passage are
compared word by word along the same diagonal: a match counts +1, a mismatch
-1, and the best segment must reach ``LEAST`` (or 60 % of a shorter passage).

Everything is column functions.  The windows of a text are made and looked up
in one pass and only hits leave their row.  The benchmark side is broadcast in
slices of at most ``SLICE`` windows, each slice a pass over the documents, so
the broadcast has a bound at any size.

Words are runs of letters and digits, in lower case.

Defined cases: a null or empty text, or one shorter than the shortest mask,
contains nothing; a passage shorter than that is not searched for, nor is a
null one or one with a null id; equal rows get equal results; an empty benchmark leaves every document
clean; a null ``doc_id`` is kept; further columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored

MASKS = ["111111", "1110111", "11011011"]
SHORTEST = min(map(len, MASKS))
LEAST = 12
SLICE = 1_000_000
#: Up to so many documents with hits are broadcast (by id, hash and a few numbers), else shuffled.
KEYS = 500_000


def _offsets(mask: str) -> list[int]:
    return [k for k, bit in enumerate(mask) if bit == "1"]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seeds(tokens: Column, at: Column) -> Column:
    """(mask, seed) of the window of each mask that begins here."""
    return F.array(*[F.struct(F.lit(m).alias("mask"), F.xxhash64(
        F.lit(m), *[F.get(tokens, at + o) for o in _offsets(mask)]).alias("seed"))
        for m, mask in enumerate(MASKS)])


def _windows(rows: DataFrame, tokens: str, at: str) -> DataFrame:
    """A row for each place and mask."""
    last = F.size(tokens) - SHORTEST
    placed = rows.filter(last >= 0).select(
        "*", F.explode(F.sequence(F.lit(0), last)).alias(at))
    return placed.select("*", F.explode(_seeds(F.col(tokens), F.col(at))).alias("s")).select(
        *placed.columns, "s.mask", "s.seed")


def benchmark_seeds(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_id, item_words), and (seed, mask, item_id, j) of all windows that lie within a passage."""
    items = benchmark.filter("item_id is not null").select("item_id", words(F.col("text")).alias("item_words")).filter(
        F.size("item_words") >= SHORTEST).dropDuplicates()
    length = F.element_at(F.array(*[F.lit(len(m)) for m in MASKS]), F.col("mask") + 1)
    seeds = _windows(items, "item_words", "j").filter(
        F.col("j") + length <= F.size("item_words"))
    return items, seeds.select("seed", "mask", "item_id", "j")


def _best_segment(tokens: Column, item: Column, shift: Column) -> Column:
    """(score, start, end) in document words, of the best segment on a diagonal; end exclusive."""
    def step(acc, k):
        same = F.get(item, k) == F.get(tokens, k + shift)
        run = F.when(acc["run"] > 0, acc["run"]).otherwise(0) + F.when(same, 1).otherwise(-1)
        start = F.when(acc["run"] > 0, acc["at"]).otherwise(k)
        better = run > acc["score"]
        return F.struct(
            run.alias("run"), start.alias("at"),
            F.when(better, run).otherwise(acc["score"]).alias("score"),
            F.when(better, start).otherwise(acc["start"]).alias("start"),
            F.when(better, k + 1).otherwise(acc["end"]).alias("end"))

    zero = F.struct(*[F.lit(0).alias(c) for c in ("run", "at", "score", "start", "end")])
    first = F.greatest(F.lit(0), -shift)
    last = F.least(F.size(item), F.size(tokens) - shift) - 1
    return F.aggregate(F.sequence(first, last), zero, step)


def hits(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, shift): diagonals on which a masked window meets.

    Only numbers pass the join; the words stay behind in the scan's stage.
    """
    tokens = _keyed(docs).withColumn("tokens", words(F.col("text"))).drop("text")
    windows = _windows(tokens, "tokens", "i").select("doc_id", "text_hash", "i", "mask", "seed")
    slices = max(1, -(-seeds.count() // SLICE))
    found = []
    for k in range(slices):
        part = seeds if slices == 1 else seeds.filter(F.pmod("item_id", F.lit(slices)) == k)
        met = windows.join(F.broadcast(part), ["seed", "mask"])
        found.append(met.select("doc_id", "text_hash", "item_id",
                                (F.col("i") - F.col("j")).alias("shift")).distinct())
    return reduce(DataFrame.unionByName, found)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, start, end): verified passages, in words of the document."""
    items, seeds = benchmark_seeds(benchmark)
    found = stored(hits(docs, stored(seeds, "seeds")), "hits")
    per_doc = found.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")
                            ).agg(F.collect_list(F.struct("item_id", "shift")).alias("hits"))
    docs_hit = _matching(_keyed(docs), per_doc, "inner").dropDuplicates(["doc_id", "text_hash"])
    judged = docs_hit.select("doc_id", "text_hash", words(F.col("text")).alias("tokens"),
                             F.explode("hits").alias("h")).select(
        "doc_id", "text_hash", "tokens", "h.item_id", "h.shift").join(items, "item_id").select(
        "doc_id", "text_hash", "item_id", "shift", F.size("item_words").alias("n"),
        _best_segment(F.col("tokens"), F.col("item_words"), F.col("shift")).alias("best"))
    enough = F.least(F.lit(LEAST), F.ceil(F.col("n") * 0.6))
    return judged.filter(F.col("best.score") >= enough).select(
        "doc_id", "text_hash", "item_id", (F.col("best.start") + F.col("shift")).alias("start"),
        (F.col("best.end") + F.col("shift")).alias("end")).distinct()


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text): rows with the same id but other texts are different documents."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _matching(keyed: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """A join with the (hit_id, hit_hash) of documents with hits; they are broadcast up to ``KEYS``."""
    if keys.count() <= KEYS:
        keys = F.broadcast(keys)
    return keyed.join(keys, F.col("doc_id").eqNullSafe(F.col("hit_id"))
                      & (F.col("text_hash") == F.col("hit_hash")), how)


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: whether it holds a passage, the number of passages and their ids and places."""
    found = leaks(docs, benchmark).groupBy(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).agg(
        F.array_sort(F.collect_set(F.struct("item_id", "start", "end"))).alias("found"))
    rows = _matching(_keyed(docs).drop("text"), stored(found, "leaks"), "left")
    none = F.array().cast("array<struct<item_id:bigint,start:int,end:int>>")
    return rows.select("doc_id", F.coalesce("found", none).alias("found")).select(
        "doc_id", (F.size("found") > 0).alias("contaminated"),
        F.size(F.array_distinct(F.transform("found", lambda x: x["item_id"]))).cast("long")
        .alias("n_items"),
        F.concat_ws(",", F.transform("found", lambda x: F.concat_ws(
            ":", x["item_id"].cast("string"), x["start"].cast("string"),
            x["end"].cast("string")))).alias("passages"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark passage, with their own columns."""
    keys = stored(leaks(docs, benchmark).select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct(), "leaks")
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
                        docs["doc_id"].alias("doc_id"),
                        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("text_hash"))
    return _matching(whole, keys, "left_anti").select("doc.*")
