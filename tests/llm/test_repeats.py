"""Periodic runs against a search over all periods, in one tile and in many."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from refreshguard.llm import repeats

TINY = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, key string, period long, start long, runs string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words_of(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n or doc_id is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def all_runs(words):
    """(start, period, length) of every run, by trying each period on the whole text."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(i + 1, j)
    return sorted((s, q, n) for (s, n), q in found.items())


def expected(doc_id, text):
    words = words_of(doc_id, text)
    runs = all_runs(words)
    dropped = {i for s, q, n in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[2], r[1]), -r[0], -r[1]), default=None)
    start, period, length = best or (None, None, None)
    return (doc_id, len(runs), start, length, period,
            best and 1000 * length // period, sha("".join(f"{s},{n},{q}\n" for s, q, n in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def strange_texts():
    choose = random.Random(12)
    texts = ["", None, " \n\t ", "a", "a " * 5, "a " * 6, "a b " * 3, "a b " * 4 + "a",
             "x " * 300 + "y " * 300 + "x y " * 100, ("l m n " * 40 + "o ") * 6,
             "é\u00a0b\u2003c " * 9, "a\x0bb\x0c" * 10]
    fib = ["a", "a b"]
    while len(fib[-1].split()) < 400:
        fib.append(fib[-1] + " " + fib[-2])
    texts.append(fib[-1])
    for _ in range(120):
        size, letters = choose.choice([7, 20, 60, 200, 500]), choose.choice([1, 2, 3, 30])
        words = [str(choose.randrange(letters)) for _ in range(size)]
        for _ in range(choose.randrange(4)):
            p, s, n = choose.randrange(1, size // 4 + 1), choose.randrange(size), choose.randrange(size)
            for i in range(s, min(size, s + n)):
                words[i] = words[s + (i - s) % p]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("tile", [repeats.TILE, 64, 8])
def test_strange_texts(spark, tile):
    rows = [(i, t, "k", 1, 2, "r") for i, t in enumerate(strange_texts())]
    rows += [rows[8], rows[8], (None, "a b " * 9, "k", 1, 2, "r"), (8, "b a " * 40, "k", 1, 2, "r")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = [tuple(r) for r in repeats.repeat_report(docs, tile).collect()]
    wanted = [expected(i, t) for i, t, *_ in rows]
    assert sorted(map(str, found)) == sorted(map(str, wanted))


def test_given_documents(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    short = {r["doc_id"]: r["text"] for r in docs.filter(F.length("text") < 6000).collect()}
    found = {r["doc_id"]: tuple(r) for r in repeats.repeat_report(docs).collect()}
    assert len(found) == docs.count()
    assert {i: found[i] for i in short} == {i: expected(i, t) for i, t in short.items()}
    assert sum(r[1] > 0 for r in found.values()) > len(found) / 20


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    found = repeats.repeat_report(docs)
    assert found.count() == 0 and found.columns[:2] == ["doc_id", "n_runs"]


def test_a_long_text(spark):
    """Periods longer than a tile, across many tiles."""
    unit = " ".join(str(i * i % 1009) for i in range(3000))
    docs = spark.createDataFrame([(3, " ".join([unit] * 5) + " end", "", 0, 0, "")], SCHEMA)
    row = repeats.repeat_report(docs, 1024).first()
    whole = repeats.repeat_report(docs).first()
    assert tuple(row) == tuple(whole) and row["n_runs"] >= 1
