"""Language of a text by n-gram filters that hold bits per language.

Letters are lowered and everything else is one blank; n-grams are four
characters.  A Bloom filter whose cells are bit masks answers for an n-gram with
the set of all languages that have it: the masks of its cells, joined by *and*.
Each language has two bits: one for all n-grams of its texts, and one for those
that are common there (seen twice, and at least ``SHARE`` of the n-gram's greatest
relative frequency in any language).  A text is the counts of its n-grams per bit
(population counts), corrected for the share of chance hits that each bit has by
its load.  The language with the most common n-grams wins; all of its n-grams, at
the weight ``RARE``, decide where those say nothing.

The counts cover all labelled documents outside the held-out third; each task
adds up its own n-grams before they are shuffled, and the masks of the cells are
put together on the executors.  Every n-gram is in the filter.  Its cells are four
times the n-grams, up to ``MOST_CELLS``: beyond that more hits are chance, which the
correction takes out.

Defined cases: a null text, or one without a letter (numerals are none), is ``und``
with score 0; equal texts are equal; without labelled rows every text is ``und``;
among equal counts the first language by code point wins; a null ``doc_id`` counts
as held out; further columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import held_out, small_batches

N = 4
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 22
PROBES = 2
SHARE = 0.3
RARE = 0.05
CHARS_AT_ONCE = 500_000
LOT = 3_000_000  # n-grams held by a task
UNKNOWN = "und"
RESULT = "lang_pred string, score double"
def _numeral(c: str) -> bool:
    """A word character that is neither a letter nor a decimal digit."""
    return c.isnumeric() and not c.isalpha() and not c.isdecimal()


# A set of characters below 2^16 is looked up in a table; the few above are judged one by one.
_NUMERAL = re.compile("[" + re.escape("".join(filter(_numeral, map(chr, range(1 << 16))))) + "]")
_HIGH = re.compile("[\U00010000-\U0010ffff]")
_OTHER = re.compile(r"[\W\d_]+")
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)


def _gram_hashes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(codes) - N + 1
    h = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(N):
        h = (h ^ codes[k:k + len(h)]) * _P
    return (h ^ (h >> np.uint64(29))) * _Q


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of all n-grams of a text, in parts; words at a part's end keep their blank."""
    for at in range(0, len(text), CHARS_AT_ONCE):
        # N - 1 characters of overlap: every n-gram is in one part
        part = text[at:at + CHARS_AT_ONCE + N - 1]
        yield _gram_hashes(part)


def plain(text: str | None) -> str:
    """Letters in lower case with one blank between and around words; empty without a letter."""
    if text and not text.isascii():
        text = _HIGH.sub(lambda m: " " if _numeral(m[0]) else m[0], _NUMERAL.sub(" ", text))
    words = _OTHER.sub(" ", text.lower()).strip() if text else ""
    return f" {words} " if words else ""


@dataclass
class Model:
    """Bit k of a cell is language k's for all its n-grams, bit k + len(langs) for the common ones."""

    langs: list[str]
    cells: np.ndarray  # (words, cells) of uint64 masks
    chance: np.ndarray  # rate of false hits by bit


def _places(h: np.ndarray, cells: int) -> list[np.ndarray]:
    return [((h >> np.uint64(24 * k)) & np.uint64(cells - 1)).astype(np.int64)
            for k in range(PROBES)]


def _bit(cells: np.ndarray, k: int) -> np.ndarray:
    return (cells[k // 64] >> np.uint64(k % 64)) & np.uint64(1)


def model_of(langs: list[str], cells: np.ndarray) -> Model:
    load = np.array([_bit(cells, k).mean() for k in range(2 * len(langs))])
    return Model(langs, cells, load ** PROBES)


def languages_of(model: Model, gram: str) -> set[str]:
    """All languages whose texts have the n-gram (and, by chance, some others)."""
    places = _places(_gram_hashes(gram), model.cells.shape[1])
    found = set()
    for k, lang in enumerate(model.langs):
        bits = _bit(model.cells, k)
        if all(bits[p].all() for p in places):
            found.add(lang)
    return found


def hits(model: Model, text: str) -> tuple[np.ndarray, int]:
    """For each bit the n-grams of a text whose cells hold it, and the n-grams in all."""
    width = 2 * len(model.langs)
    found, total = np.zeros(width, dtype=np.int64), 0
    for h in grams(text):
        places = _places(h, model.cells.shape[1])
        total += len(h)
        for word, masks in enumerate(model.cells):
            mask = masks[places[0]]
            for place in places[1:]:
                mask = mask & masks[place]
            here = min(64, width - 64 * word)
            if here <= 12:
                values = np.bincount(mask.astype(np.int64), minlength=1 << here)
                for k in range(here):
                    found[64 * word + k] += values[(np.arange(len(values)) >> k) & 1 == 1].sum()
            else:
                for k in range(here):
                    found[64 * word + k] += int(((mask >> np.uint64(k)) & np.uint64(1)).sum())
    return found, total


def predict(model: Model, text: str | None) -> tuple[str, float]:
    text = plain(text)
    if not text or not model.langs:
        return UNKNOWN, 0.0
    found, total = hits(model, text)
    true = np.maximum(found - total * model.chance, 0) / np.maximum(1 - model.chance, 1e-9)
    n = len(model.langs)
    evidence = true[n:] + RARE * true[:n]
    best = int(evidence.argmax())
    weight = (evidence / max(total, 1)) ** 4
    return model.langs[best], float(weight[best] / weight.sum()) if weight.sum() else 0.0


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all texts; tasks count in memory-bound lots before anything is shuffled."""
    def count(batches):
        lots: dict[str, list[np.ndarray]] = {}

        def emptied(lang):
            values, n = np.unique(np.concatenate(lots.pop(lang)), return_counts=True)
            return pd.DataFrame({"lang": lang, "gram": values.view(np.int64), "n": n})

        held = 0
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                for h in grams(plain(text)):
                    lots.setdefault(lang, []).append(h)
                    held += len(h)
                    if held > LOT:
                        for one in list(lots):
                            yield emptied(one)
                        held = 0
        for one in list(lots):
            yield emptied(one)

    rows = docs.filter("lang is not null and text is not null").select("lang", "text")
    return rows.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


def train(docs: DataFrame) -> Model:
    """The filter from all labelled documents outside the held-out third."""
    small_batches(docs.sparkSession)
    counts = stored(count_grams(docs.filter(~held_out(F.col("doc_id")))), "grams")
    # One row a language.
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).toPandas()
    langs = sorted(totals["lang"])
    if not langs:
        return model_of([], np.zeros((1, LEAST_CELLS), dtype=np.uint64))
    spark = docs.sparkSession
    numbered = spark.createDataFrame(
        [(x, langs.index(x), t) for x, t in zip(totals["lang"], totals["total"].tolist())],
        "lang string, k int, total long")
    rates = counts.join(numbered, "lang").select(
        "k", "gram", "n", (F.col("n") / F.col("total")).alias("rate"))
    of_gram = rates.groupBy("gram").agg(
        F.max("rate").alias("top"), F.collect_list(F.struct("k", "n", "rate")).alias("langs"))
    distinct = counts.select("gram").distinct().count()
    cells = min(MOST_CELLS, max(LEAST_CELLS, 1 << (4 * distinct - 1).bit_length()))
    common = F.transform(
        F.filter("langs", lambda x: (x["n"] >= 2) & (x["rate"] >= SHARE * F.col("top"))),
        lambda x: x["k"] + len(langs))
    bits = of_gram.select("gram", F.explode(F.concat(
        F.transform("langs", lambda x: x["k"]), common)).alias("bit"))
    places = F.array(*[F.shiftrightunsigned("gram", 24 * k).bitwiseAND(F.lit(cells - 1))
                       for k in range(PROBES)])
    masks = (bits.select(F.explode(places).alias("place"), F.floor(F.col("bit") / 64).alias("word"),
                         F.expr("shiftleft(1L, bit % 64)").alias("mask"))
             .groupBy("word", "place").agg(F.bit_or("mask").alias("mask")))
    found = masks.toPandas()  # at most MOST_CELLS rows for 32 languages
    table = np.zeros((-(-2 * len(langs) // 64), cells), dtype=np.uint64)
    table[found["word"].to_numpy(np.int64), found["place"].to_numpy(np.int64)] = (
        found["mask"].to_numpy(np.int64).view(np.uint64))
    return model_of(langs, table)


def language_report(docs: DataFrame, model: Model) -> DataFrame:
    """Per document whether it is held out, its language and the language's share of the evidence."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # at most MOST_CELLS words per 32 languages

    @F.pandas_udf(RESULT)
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [predict(shared.value, t) for t in texts]
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    rows = docs.select("doc_id", language(F.col("text")).alias("p"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred",
                       "p.score")
