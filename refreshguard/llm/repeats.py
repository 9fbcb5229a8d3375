"""Periodic runs in texts: stretches of words that repeat themselves, found tile by tile.

Periods are taken an octave [B, 2B) at a time.  A run of such a period, four
periods long at least, holds a multiple of B (a boundary) after which 2B words
recur one period later.  So the tile compares the 2B words at each boundary with
those at each of the next B to 2B places, all as names made by doubling; of the
pairs that agree, the words themselves tell how far the agreement goes before and
behind the boundary (the Z-values at the boundary for that period).  Overlapping
agreements of a period are one fragment.

A document of at most ``TILE`` words is one tile and solved where it is read.  A
longer one is exploded into overlapping tiles, wider ones for longer periods; these
are dealt out by hash and solved like the others.  Fragments are shuffled by
document and period and stitched there.  A stretch that agrees at several periods
is a run of the least.  Only texts with fragments are carried along, for the words
that are left.

Defined cases: a null or empty text has no words, no runs, and the digest of the
empty string twice; a null ``doc_id`` plants nothing; of equally long runs in periods
the first, then the shortest period is reported; repeated rows and ids are rows of
their own; an empty table gives an empty result.  Of the input only ``doc_id`` and
``text`` are used, so further columns may have any name.  Names of word sequences
are 64-bit hashes: they decide where to look, words decide what is found.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from fractions import Fraction
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .shingles import mix

LEAST, TIMES = 6, 4  # words, and periods, that a run has at least
TILE = 1 << 16  # words of a document that is solved in one piece
GROUP = 300_000  # words of small documents that are worked on together
CELLS = 1 << 21  # comparisons made at once
OUT_BYTES = 4 << 20  # of an output batch

_FRAGMENT = pa.struct([("period", pa.int64()), ("first", pa.int64()), ("end", pa.int64())])
_PIECE = pa.struct([("low", pa.int32()), ("high", pa.int32()), ("base", pa.int64()),
                    ("size", pa.int64()), ("names", pa.binary())])
_FRAGMENTS = "array<struct<period:long,first:long,end:long>>"
_MARKED = (f"key string, n long, plain string, fragments {_FRAGMENTS}, pieces array<struct<low:int,"
           "high:int,base:long,size:long,names:binary>>, text binary")


# -- the words of a document ----------------------------------------------

def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(first word, period) of the repetition that the contract plants in a document."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def words_of(doc_id: int | None, raw: bytes) -> list[bytes]:
    """The words of a text, the planted repetition applied.  ``bytes.split`` splits at ASCII space."""
    words = raw.split()
    plan = planted(doc_id, len(words))
    if plan is None:
        return words
    a, p = plan
    unit = words[a:a + p]
    left = len(words) - a
    return words[:a] + (unit * (left // p + 1))[:left]


def names_of(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words, different for different ones."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


# -- one tile --------------------------------------------------------------

def _doubled(names: np.ndarray, width: int) -> np.ndarray:
    """Names of sequences of twice ``width`` words from those of ``width`` words."""
    return mix(names[:-width] * np.uint64(0x9E3779B97F4A7C15)
               + mix(names[width:] + np.uint64(0xD1B54A32D192ED03)))


def _primitive(grams: np.ndarray, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """False where the words at the boundary also recur after a proper part of the period."""
    good = np.ones(len(at), dtype=bool)
    rest = period.copy()

    def check(prime, where):
        part = period[where] // prime
        good[where] &= grams[at[where]] != grams[at[where] + part]

    prime = 2
    while len(rest) and prime * prime <= rest.max():
        where = np.flatnonzero(rest % prime == 0)
        if len(where):
            check(prime, where)
            while len(where):
                rest[where] //= prime
                where = where[rest[where] % prime == 0]
        prime += 1 + (prime > 2)
    where = np.flatnonzero(rest > 1)
    check(rest[where], where)
    return good


def _agreements(names: np.ndarray, at: np.ndarray, period: np.ndarray,
                b: int) -> tuple[np.ndarray, np.ndarray]:
    """[first, end) around each boundary, from one boundary before to three behind, in which the words recur."""
    first, end = np.empty_like(at), np.empty_like(at)
    steps = np.arange(-b, 3 * b)
    rows = max(1, CELLS // len(steps))
    for k in range(0, len(at), rows):
        c, q = at[k:k + rows, None], period[k:k + rows, None]
        here = c + steps
        there = here + q
        same = (here >= 0) & (there < len(names))
        same &= (names[np.maximum(here, 0)] == names[np.minimum(there, len(names) - 1)])
        behind = ~same[:, b:]
        before = ~same[:, b - 1::-1] if b else ~same[:, :0]
        first[k:k + rows] = at[k:k + rows] - np.where(
            before.any(axis=1), before.argmax(axis=1), b)
        end[k:k + rows] = at[k:k + rows] + np.where(
            behind.any(axis=1), behind.argmax(axis=1), 3 * b)
    return first, end


def _joined(period: np.ndarray, first: np.ndarray,
            end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of the same period that meet, made one."""
    order = np.lexsort((first, period))
    period, first, end = period[order], first[order], end[order]
    if not len(period):
        return period, first, end
    # Intervals of all periods on one line, apart from each other, make the running end a maximum.
    shift = (period - period[0]) * (int(end.max()) + 2)
    last = np.maximum.accumulate(end + shift)
    fresh = np.ones(len(period), dtype=bool)
    fresh[1:] = (first[1:] + shift[1:] > last[:-1]) | (period[1:] != period[:-1])
    starts = np.flatnonzero(fresh)
    stops = np.append(starts[1:], len(period)) - 1
    return period[starts], first[starts], last[stops] - shift[starts]


def solve(words: np.ndarray, reach: Iterable[int], low: int,
          high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, first, end) of the fragments in a line of words, periods 2^low to 2^(high+1) - 1.

    From ``first`` on, up to ``end``, each word equals the one a period later.
    ``reach[k]`` words from the start may hold a period of octave k.
    """
    names = mix(words.astype(np.uint64) + np.uint64(1))
    grams, found = names, []
    for k, limit in zip(range(high + 1), reach):
        b = 1 << k
        if limit < TIMES * b:
            break
        grams = _doubled(grams[:limit], b)
        if k < low:
            continue
        blocks = len(grams) // b
        table = grams[:blocks * b].reshape(blocks, b)
        tail = grams[blocks * b:]
        t, r = np.nonzero(table[1:] == table[:-1, :1])
        at, period = t * b, b + r
        if blocks and len(tail):
            r = np.flatnonzero(tail == table[-1, 0])
            at = np.concatenate([at, np.full(len(r), (blocks - 1) * b)])
            period = np.concatenate([period, b + r])
        if not len(at):
            continue
        good = _primitive(grams, at, period)
        at, period = at[good], period[good]
        first, end = _agreements(words, at, period, b)
        true = end - first >= 2 * b
        found.append((period[true], first[true], end[true]))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    return _joined(*[np.concatenate(parts) for parts in zip(*found)])


def _octaves(n: int) -> int:
    """The number of octaves with a period that fits ``TIMES`` times into n words."""
    return max(0, (n // TIMES).bit_length())


def _whole(docs: list[np.ndarray]) -> list[list[dict]]:
    """The fragments of runs in some documents, each of them one tile."""
    out: list[list[dict]] = [[] for _ in docs]
    if not docs:
        return out
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    parts, starts, at = [], [], 0
    for k, i in enumerate(order):
        starts.append(at)
        # A word of its own ends each document; words of different documents must not agree there.
        parts += [docs[i], np.array([-2 - k], dtype=np.int64)]
        at += len(docs[i]) + 1
    sizes = np.array([len(docs[i]) for i in order])
    begins = np.array(starts)
    octaves = _octaves(int(sizes.max(initial=0)))
    ends = begins + sizes
    reach = [int(ends[(sizes >= TIMES << k).nonzero()[0][-1]]) for k in range(octaves)]
    period, first, end = solve(np.concatenate(parts), reach, 0, octaves - 1)
    length = end - first + period
    runs = length >= np.maximum(LEAST, TIMES * period)
    for p, s, e in zip(period[runs].tolist(), first[runs].tolist(), end[runs].tolist()):
        k = int(np.searchsorted(begins, s, side="right")) - 1
        out[order[k]].append({"period": p, "first": s - starts[k], "end": e - starts[k]})
    return out


# -- tiles of long documents -----------------------------------------------

def pieces(words: np.ndarray, tile: int) -> Iterator[dict]:
    """Overlapping tiles: one width for the octaves up to an eighth of it, then twice the width for each."""
    n = len(words)
    low, last = 0, _octaves(n) - 1
    high = min(last, max(0, (tile // 8).bit_length() - 1))
    while low <= last:
        width, lap = max(tile, 8 << high), 8 << high
        for base in range(0, n, width):
            if base and base + lap >= n:
                break  # the tile before reaches the end
            part = words[base:base + width + lap]
            yield {"low": low, "high": high, "base": base, "size": n,
                   "names": part.astype("<i8").tobytes()}
        low = high = high + 1


def _solve_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.string()), *[(f.name, f.type) for f in _FRAGMENT]])
    for batch in batches:
        for i in range(batch.num_rows):
            p = batch.column("piece")[i].as_py()
            words = np.frombuffer(p["names"], dtype="<i8")
            period, first, end = solve(words, [len(words)] * (p["high"] + 1), p["low"], p["high"])
            # What ends inside the tile on both sides is known whole.
            cut = (((first == 0) & (p["base"] > 0))
                   | ((end + period >= len(words)) & (p["base"] + len(words) < p["size"])))
            keep = cut | (end - first + period >= np.maximum(LEAST, TIMES * period))
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("key")[i].as_py()] * int(keep.sum()), pa.string()),
                 *[pa.array(x[keep] + shift, pa.int64()) for x, shift in
                   ((period, 0), (first, p["base"]), (end, p["base"]))]], schema=schema)


# -- the table -------------------------------------------------------------

def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, bytes]]:
    for batch in batches:
        ids = batch.column("doc_id")
        texts = batch.column("text").cast(pa.binary())
        for k in range(batch.num_rows):
            yield ids[k].as_py(), texts[k].as_py() or b""


def _mark(tile: int, kind: pa.DataType):
    schema = pa.schema([("doc_id", kind), ("key", pa.string()), ("n", pa.int64()),
                        ("plain", pa.string()), ("fragments", pa.list_(_FRAGMENT)),
                        ("pieces", pa.list_(_PIECE)), ("text", pa.binary())])

    def solved(rows: list[dict], docs: list[np.ndarray]) -> None:
        for row, fragments in zip(rows, _whole(docs)):
            row["fragments"] = fragments
            row["text"] = row["text"] if fragments else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, small, docs, words_held, held = [], [], [], 0, 0
        for doc_id, raw in _texts(batches):
            words = words_of(doc_id, raw)
            name = f"{doc_id}\0".encode() + raw
            row = {"doc_id": doc_id, "key": hashlib.blake2b(name, digest_size=16).hexdigest(),
                   "n": len(words), "plain": _sha(b" ".join(words)), "fragments": [],
                   "pieces": [], "text": None}
            rows.append(row)
            if len(words) >= LEAST:
                names = names_of(words)
                row["text"] = raw
                held += len(raw)
                if len(words) > tile:
                    row["pieces"] = list(pieces(names, tile))
                    held += sum(len(p["names"]) for p in row["pieces"])
                else:
                    small.append(row)
                    docs.append(names)
                    words_held += len(names)
            if words_held > GROUP or held > OUT_BYTES or len(rows) >= 10_000:
                solved(small, docs)
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, small, docs, words_held, held = [], [], [], 0, 0
        solved(small, docs)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def stitched(fragments: DataFrame) -> DataFrame:
    """(key, runs): the fragments (key, period, first, end) of each document joined to whole runs.

    Fragments of a period that overlap or meet are one stretch; one too short is
    none; of the periods of a stretch the least counts.
    """
    line = Window.partitionBy("key", "period").orderBy("first", "end")
    before = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("first") > F.col("before"), F.lit(True))
    stretches = (fragments.withColumn("before", before)
                 .withColumn("island", F.sum(fresh.cast("long")).over(line))
                 .groupBy("key", "period", "island")
                 .agg(F.min("first").alias("start"), F.max("end").alias("end")))
    length = F.col("end") - F.col("start") + F.col("period")
    runs = (stretches.select("key", "period", "start", length.alias("length"))
            .filter(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
            .groupBy("key", "start", "length").agg(F.min("period").alias("period")))
    return runs.groupBy("key").agg(F.array_sort(F.collect_list(
        F.struct("start", "period", "length"))).alias("runs"))


_REPORT = ("n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")


def _finish(kind: pa.DataType):
    whole = [pa.int64()] * 5
    schema = pa.schema([("doc_id", kind), *zip(
        ("n_runs", "start", "length", "period", "exponent_milli"), whole),
        ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])

    def report(doc_id, plain: str, raw: bytes | None, runs: list[dict] | None) -> dict:
        row = {"doc_id": doc_id, "n_runs": 0, "start": None, "length": None, "period": None,
               "exponent_milli": None, "runs_sha256": _sha(b""), "collapsed_sha256": plain}
        if not runs:
            return row
        words = words_of(doc_id, raw)
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        for r in runs:
            edge[r["start"] + r["period"]] += 1
            edge[r["start"] + r["length"]] -= 1
        kept = np.cumsum(edge[:-1]) == 0
        best = max(runs, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"],
                                        -r["period"]))
        lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs)
        return row | {"n_runs": len(runs), "start": best["start"], "length": best["length"],
                      "period": best["period"],
                      "exponent_milli": 1000 * best["length"] // best["period"],
                      "runs_sha256": _sha(lines.encode()),
                      "collapsed_sha256": _sha(b" ".join(compress(words, kept)))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "plain", "text", "runs")]
            rows = [report(*(c[i].as_py() for c in columns)) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def repeat_report(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """Per document its runs: their number, the strongest, digests of all and of the words left."""
    texts = docs.select("doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    arrow = pa.from_numpy_dtype("int64") if kind in ("bigint", "int") else pa.string()
    if kind == "int":
        arrow = pa.int32()
    marked = stored(texts.mapInArrow(_mark(tile, arrow), f"doc_id {kind}, {_MARKED}"), "runs")
    inside = marked.select("key", F.inline("fragments"))
    tiles = (marked.filter(F.size("pieces") > 0).select("key", F.explode("pieces").alias("piece"))
             .repartition("key", "piece.low", "piece.base"))
    across = tiles.mapInArrow(_solve_pieces, "key string, period long, first long, end long")
    runs = stitched(inside.unionByName(across))
    rows = marked.select("doc_id", "key", "plain", "text").join(runs, "key", "left")
    return rows.select("doc_id", "plain", "text", "runs").mapInArrow(
        _finish(arrow), f"doc_id {kind}, {_REPORT}")
