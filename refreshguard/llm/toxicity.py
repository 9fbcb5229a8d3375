"""Toxic spans by a linear-chain conditional random field, and a score per text.

Labels mark whole documents.  Token labels are derived from them: prefixes and
words that (nearly) only toxic documents have, found by greedy set cover, mark
the tokens that make a document toxic.  A two-state CRF over hashed word and
affix features learns these marks.  Forward-backward marginals give the
probability of each token, spans of tokens above one half, and a document
score through a logistic curve fitted to labelled documents.

A text is one chain, worked on in windows of 64 tokens: a matrix per window
carries the state on to the next ones and back, so the marginals are those of
the whole text wherever a window ends, and the work grows with the text.

The fit runs on a bounded sample of labelled documents (``TOXIC_ROWS`` and
``CLEAN_ROWS``) and of their windows (``WINDOWS`` with a mark and as many
without), in which every document has its share; the model is a weight vector of fixed size.  Scoring needs no
shuffle and keeps one batch in memory.

Defined cases: a null or empty text, or one without a letter, has no token and
gets the score of a text with nothing suspicious; equal texts get equal scores;
without labelled toxic and clean rows the score is the share of toxic labels
(0 without labels); a null ``doc_id`` counts as held out; labels that are null
are skipped and of several labels of a document the highest counts; further
columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, held_out, small_batches

#: Bounds of the sample that the model is fitted on.
TOXIC_ROWS, CLEAN_ROWS = 1500, 3000
WINDOWS = 6000
BUCKETS = 1 << 18
CHAIN = 64
CUT = 0.7
STEPS, RIDGE, START = 40, 0.02, 3.0
CHARS_AT_ONCE = 500_000
WORDS_KEPT = 150_000
PREFIXES = (3, 4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")
RESULT = "score double, n_spans int, spans string"


def affixes(word: str) -> list[str]:
    return ["w" + word] + [f"p{word[:k]}" for k in PREFIXES if len(word) > k]


def features(word: str) -> list[int]:
    """Buckets of a word, its prefixes and its suffix; always as many."""
    names = ["w" + word, *[f"p{word[:k]}" for k in PREFIXES], "s" + word[-3:],
             f"n{min(len(word), 12)}"]
    return [zlib.crc32(n.encode()) % BUCKETS for n in names]


@dataclass
class Model:
    """Weights of the features for the toxic state, log transitions, and the curve of the score."""

    weights: np.ndarray
    moves: np.ndarray
    curve: np.ndarray
    prior: float


def carried(toxic: np.ndarray, step: np.ndarray, windows: np.ndarray) -> tuple:
    """What comes into each window (row) from those before and after it, for texts of so many windows."""
    rows, length = toxic.shape
    before, after = np.tile([1.0, 0.0], (rows, 1)), np.ones((rows, 2))
    most = int(windows.max(initial=0))
    if most < 2:
        return before, after
    through = np.tile(np.eye(2), (rows, 1, 1))
    for t in range(length):
        through = (through.reshape(-1, 2) @ step).reshape(rows, 2, 2)
        through[:, :, 1] *= toxic[:, t, None]
        through /= through.sum((1, 2), keepdims=True)
    first = np.cumsum(windows) - windows
    for k in range(1, most):
        at = first[windows > k] + k
        state = (before[at - 1][:, :, None] * through[at - 1]).sum(1)
        before[at] = state / state.sum(1, keepdims=True)
    for k in range(most - 2, -1, -1):
        at = first[windows > k + 1] + k
        state = (through[at + 1] * after[at + 1][:, None, :]).sum(2)
        after[at] = state / state.sum(1, keepdims=True)
    return before, after


def marginals(odds: np.ndarray, moves: np.ndarray, windows: np.ndarray | None = None) -> np.ndarray:
    """P(toxic) of each token of each window (row), from its log odds, by forward-backward.

    ``windows`` are the windows of each text; without it, each is a text."""
    rows, length = odds.shape
    toxic = np.exp(np.clip(odds, -30, 30))
    step = np.exp(moves)
    ahead = np.empty((length, rows, 2))
    state, back = carried(toxic, step, np.ones(rows, dtype=np.int64) if windows is None else windows)
    for t in range(length):
        state = state @ step
        state[:, 1] *= toxic[:, t]
        state /= state.sum(1, keepdims=True)
        ahead[t] = state
    out = np.empty((rows, length))
    for t in range(length - 1, -1, -1):
        both = ahead[t] * back
        out[:, t] = both[:, 1] / both.sum(1)
        back = back * np.stack([np.ones(rows), toxic[:, t]], 1) @ step.T
        back /= back.sum(1, keepdims=True)
    return out


def chains(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """For texts of so many tokens: the cell of each token in rows of ``CHAIN`` cells, and the rows."""
    rows = -(-counts // CHAIN)
    first = np.repeat((np.cumsum(rows) - rows) * CHAIN, counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first + within, int(rows.sum())


# -- fitting --------------------------------------------------------------

def shares(of: np.ndarray, hashes: np.ndarray, most: int) -> np.ndarray:
    """Places of at most ``most`` windows: of each document one by hash, then of each a second one, ..."""
    if len(of) <= most:
        return np.arange(len(of))
    order = np.lexsort((hashes, of))
    own = of[order]
    turn = np.empty(len(of), dtype=np.int64)
    turn[order] = np.arange(len(of)) - np.searchsorted(own, own)
    return np.sort(np.lexsort((hashes, turn))[:most])


def offending(words: list[set[str]], toxic: np.ndarray) -> set[str]:
    """Words and prefixes that mark toxic documents.

    The first ones cover the toxic documents greedily, so what merely repeats
    in copies of a document that is covered already gains nothing.  Then come
    all that are as exclusive and common enough by themselves.
    """
    n_toxic, n_clean = toxic.sum(), (~toxic).sum()
    clean, where = Counter(), defaultdict(list)
    for i, doc in enumerate(words):
        seen = {a for w in doc for a in affixes(w)}
        if toxic[i]:
            for a in seen:
                where[a].append(i)
        else:
            clean.update(seen)

    def exclusive(a):
        share = len(where[a]) / n_toxic
        return share / (share + (clean[a] + 1) / n_clean)

    common = {a: set(d) for a, d in where.items() if len(d) >= 2 and exclusive(a) >= 0.95}
    chosen = {a for a, d in common.items() if len(d) >= 0.03 * n_toxic and exclusive(a) >= 0.99}
    covered = set().union(*[common[a] for a in chosen])
    least = max(2, 0.005 * n_toxic)
    # What a candidate adds can only shrink, so the first of the heap whose figure is fresh is the best.
    # Of candidates that add as much the longer one, then the last by alphabet, comes first.
    heap = [(-len(common[a]), k, a) for k, a in enumerate(
        sorted(common, key=lambda a: (len(a), a), reverse=True))]
    heapify(heap)
    while heap:
        stale, place, best = heap[0]
        adds = len(common[best] - covered)
        if adds != -stale:
            heapreplace(heap, (-adds, place, best))
        elif adds < least:
            break
        else:
            heappop(heap)
            chosen.add(best)
            covered |= common[best]
    return chosen


def fit_chain(words: list[list[str]], toxic: np.ndarray, seed: int = 7) -> tuple:
    """Weights and transitions from documents, by Adam steps on the likelihood of the derived marks."""
    marks = offending([set(w) for w in words], toxic)
    ids: dict[str, int] = {}
    coded = [np.array([ids.setdefault(w, len(ids)) for w in doc], dtype=np.int64) for doc in words]
    names = list(ids)
    bad = np.array([any(a in marks for a in affixes(w)) for w in names] + [False])
    counts = np.array([len(c) for c in coded])
    cell, rows = chains(counts)
    token = np.full(rows * CHAIN, len(names))
    token[cell] = np.concatenate(coded)
    token = token.reshape(rows, CHAIN)
    row_toxic = np.repeat(toxic, -(-counts // CHAIN))
    truth = bad[token] & row_toxic[:, None]
    # A chain without a mark in a toxic document says nothing certain.
    useful = truth.any(1) | ~row_toxic
    rng = np.random.default_rng(seed)
    plain = np.flatnonzero(useful & ~truth.any(1))
    marked = np.flatnonzero(truth.any(1))
    hashes = np.array([zlib.crc32(" ".join(names[t] for t in row if t < len(names)).encode())
                       for row in token[marked]])
    of = np.repeat(np.arange(len(counts)), -(-counts // CHAIN))[marked]
    kept = np.concatenate([marked[shares(of, hashes, WINDOWS)], rng.permutation(plain)[:WINDOWS]])
    token, truth = token[kept], truth[kept].astype(float)
    used, token = np.unique(token, return_inverse=True)
    token = token.reshape(truth.shape)
    pad = used == len(names)
    feats = np.array([features(names[u]) if u < len(names) else features("") for u in used])
    pairs = np.zeros((2, 2))
    before, after = truth[:, :-1].ravel().astype(int), truth[:, 1:].ravel().astype(int)
    np.add.at(pairs, (before, after), 1)
    moves = np.log((pairs + 1) / (pairs + 1).sum(1, keepdims=True))
    moves = moves - moves[:, :1]  # the odds of a token carry the rest
    weights, mean, square = np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(BUCKETS)
    for k in range(1, STEPS + 1):
        odds = weights[feats].sum(1) - START
        odds[pad] = -30.0
        wrong = marginals(odds[token], moves) - truth
        per_word = np.bincount(token.ravel(), wrong.ravel(), len(used))
        per_word[pad] = 0.0
        grad = np.bincount(feats.ravel(), np.repeat(per_word, feats.shape[1]), BUCKETS)
        grad += RIDGE * weights
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        weights -= 0.25 * (mean / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.99 ** k)) + 1e-6)
    return weights, moves


def fit_curve(traits: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a little ridge."""
    x = np.column_stack([traits, np.ones(len(traits))])
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        ridge = np.diag([0.01] * (x.shape[1] - 1) + [1e-4])
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge
        beta += np.linalg.solve(hess, x.T @ (toxic - p) - ridge @ beta)
    return beta


def tokens(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def fit(texts: list[str | None], toxic: list[int]) -> Model:
    """A model from labelled texts; two thirds fit the chain, one third the curve of the score."""
    y = np.array(toxic, dtype=bool)
    prior = float(y.mean()) if len(y) else 0.0
    words = [tokens(t) for t in texts]
    turn = np.array([zlib.crc32((t or "").encode()) % 3 > 0 for t in texts], dtype=bool)
    if not len(y) or min(y.sum(), (~y).sum(), y[turn].sum(), (~y[turn]).sum()) < 2:
        return Model(np.zeros(BUCKETS, np.float32), np.zeros((2, 2)), np.zeros(3), prior)
    weights, moves = fit_chain([w for w, t in zip(words, turn) if t], y[turn])
    model = Model(weights.astype(np.float32), moves, np.array([1.0, 0.0, 0.0]), prior)
    own = ~turn if min(y[~turn].sum(), (~y[~turn]).sum()) >= 2 else np.ones_like(turn)
    traits = np.concatenate([t for t, _ in judged(
        model, [x for x, o in zip(texts, own) if o])])
    model.curve = fit_curve(traits, y[own])
    return model


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labels outside the held-out third; the text is read once, for the sampled ids."""
    known = (labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    toxic, clean = known.filter("toxic = 1"), known.filter("toxic = 0")
    picked = (bounded_sample(toxic, F.col("doc_id"), TOXIC_ROWS)
              .unionByName(bounded_sample(clean, F.col("doc_id"), CLEAN_ROWS)))
    # Broadcast: at most about TOXIC_ROWS + CLEAN_ROWS pairs of numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    found = rows.select("doc_id", "text", "toxic").toPandas().sort_values(["doc_id", "text"])
    return fit(found["text"].tolist(), found["toxic"].tolist())


# -- scoring --------------------------------------------------------------

class Odds(dict):
    """Log odds by word; at most ``WORDS_KEPT`` are remembered."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = out = float(self.weights[features(word)].sum()) - START
        return out


def judged(model: Model, texts: Iterable[str | None],
           odds: Odds | None = None) -> Iterator[tuple[np.ndarray, list]]:
    """Per group of texts: their traits (two columns), and the P(toxic) of the tokens of each."""
    odds = Odds(model.weights) if odds is None else odds
    group: list = []
    size = 0
    for text in texts:
        words = tokens(text)
        group.append(np.fromiter(map(odds.__getitem__, words), float, len(words)))
        size += len(text or "")
        if size >= CHARS_AT_ONCE:
            yield _judged(model, group)
            group, size = [], 0
    yield _judged(model, group)


def _judged(model: Model, group: list[np.ndarray]) -> tuple[np.ndarray, list]:
    counts = np.array([len(g) for g in group], dtype=np.int64)
    traits = np.zeros((len(group), 2))
    traits[:, 0] = -12.0
    if not counts.sum():
        return traits, group
    cell, rows = chains(counts)
    padded = np.full(rows * CHAIN, -30.0)
    padded[cell] = np.concatenate(group)
    p = marginals(padded.reshape(rows, CHAIN), model.moves, -(-counts // CHAIN)).ravel()[cell]
    some = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[some]
    top = np.clip(np.maximum.reduceat(p, starts), 6e-6, 1 - 6e-6)
    traits[some, 0] = np.log(top / (1 - top))
    traits[some, 1] = np.log1p(np.add.reduceat(np.where(p > 0.05, p, 0.0), starts))
    return traits, np.split(p, np.cumsum(counts)[:-1])


def score(model: Model, texts: list[str | None], odds: Odds | None = None) -> pd.DataFrame:
    """Score, number of spans and spans (``start:end``, comma-joined) of each text."""
    scores, counts, spans = [], [], []
    at = 0
    for traits, marks in judged(model, texts, odds):
        if model.curve.any():
            z = traits @ model.curve[:2] + model.curve[2]
            scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        else:
            scores.append(np.full(len(traits), model.prior))
        for p in marks:
            found = []
            if len(p) and p.max() >= 0.5:
                where = [(m.start(), m.end()) for m in WORD.finditer(texts[at].lower())]
                for k in np.flatnonzero(p >= 0.5):
                    if found and k and p[k - 1] >= 0.5:
                        found[-1][1] = where[k][1]
                    else:
                        found.append(list(where[k]))
            counts.append(len(found))
            spans.append(",".join(f"{a}:{b}" for a, b in found))
            at += 1
    return pd.DataFrame({"score": np.concatenate(scores) if scores else [],
                         "n_spans": np.array(counts, dtype="int32"), "spans": spans})


def scorer(model: Model):
    """The model as a column function of a text."""
    @F.pandas_udf(RESULT)
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        odds = Odds(model.weights)
        for texts in batches:
            yield score(model, texts.where(texts.notna(), None).tolist(), odds)

    return toxicity


def toxicity_report(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: whether it is held out, its score, the decision and the offending spans."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", scorer(model)(F.col("text")).alias("t"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "t.score",
                       (F.col("t.score") >= CUT).cast("int").alias("predicted"), "t.n_spans",
                       "t.spans")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents below the cut, with their own columns."""
    small_batches(docs.sparkSession)
    return docs.filter(scorer(model)(F.col("text"))["score"] < CUT)
