"""Secrets in texts: fixed formats, and strings that look random to two Markov models.

A first-order Markov model over characters is fitted to random strings and
another to ordinary identifiers.  The log-likelihood ratio of a string under
the two says how much more it looks like a key than like a name; strings above
a threshold are reported beside the fixed formats.

Random strings are the values in the fixed formats that have a letter, and the
digest of each as base64 and as upper-case digits.  Ordinary ones are the words of the texts, and what people
make of several words: names with dates, versions, numbers and times,
paths and slugs, so that a digit by itself is no evidence.  The words of all texts are
counted once; names are made of each different word and weigh as much as it.  Two thirds of them,
by hash, fit the models; the last third gives the threshold, above which one of
``1 / RARELY`` ordinary strings would be.  All documents are read for both.

Everything is column functions.  Texts never leave their row and nothing is
shuffled but the transition counts, at most two values per pair of characters
and task, and counts of the words that occur and of log ratios.

Defined cases: a null text is an empty one; an empty text has no span; equal
rows give equal results; an empty table gives an empty result; only ``doc_id``
and ``text`` of the input are used, so further columns may have any name.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import join_spans

# The formats, in the order of the report, and the least length of each.
KINDS = ["assign", "access", "hex", "markov"]
KEYWORD = r"""(?i:password|passwd|secret|token|api_?key)"""
ASSIGN = "(" + KEYWORD + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a shorter run has no longer one within it,
HEX = r"[0-9a-f]{16,}"  # so the bound may stand in the pattern
ASSIGN_VALUE = 12

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
GROUPS = ["\0", ALPHABET[:26], ALPHABET[26:52], ALPHABET[52:62], ALPHABET[62:]]
LETTERS = 0.5  # the weight of the characters themselves against their kinds
STATES = len(ALPHABET) + 1  # state 0: the start of a string, or a foreign character
#: A whole run of 20 or more such characters with a digit in it.
CANDIDATE = (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]{20})"
             r"[A-Za-z+/_=-]*+[0-9][A-Za-z0-9+/_=-]*+")
WORD, PART = r"[A-Za-z][A-Za-z_-]+", r"[A-Za-z]{2,}"
IDENTIFIER = 4  # the least length of a word that is an identifier by itself
NAMES, TOGETHER = 2, 2_000  # names made of each word; words among which it finds its partners
UNIT = 1000  # log ratios are kept as thousandths

#: Log odds that a candidate has to overcome at least: one secret in about 20,000 long strings.
THRESHOLD = 10.0
#: The share of ordinary strings kept out of the fit that may pass the threshold; a margin comes on top.
RARELY, MARGIN = 0.001, 2.0


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost matches as (start, end, value), in code points, end exclusive.

    The parts between the matches, and the matches, alternate; their lengths
    add up to the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("found"),
                         value.alias("value"))
    kind = "array<struct<start:int,end:int,value:string>>"

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["found"])
        span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.when(x["found"].isNull(), acc).otherwise(F.struct(
            end.alias("at"), F.array_append(acc["spans"], span).alias("spans")))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))
    return F.aggregate(parts, first, step, lambda acc: acc["spans"])


def _where(gate: Column, spans: Column) -> Column:
    return F.when(gate, spans).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string>>"))


def base_spans(docs: DataFrame) -> DataFrame:
    """The rows with an array of spans for each fixed format; texts without a trace of it are passed over."""
    text = F.col("text")
    return docs.select(
        "*",
        F.filter(_where((text.contains(":") | text.contains("="))
                        & text.rlike(KEYWORD + r"""["']?\x20*[:=]"""), matches(text, ASSIGN, 2)),
                 lambda x: F.length(x["value"]) >= ASSIGN_VALUE).alias("assign"),
        _where(text.contains("AKIA"), matches(text, ACCESS)).alias("access"),
        _where(text.rlike(HEX), matches(text, HEX)).alias("hex"))


def _state(char: Column) -> Column:
    return F.instr(F.lit(ALPHABET), char)


def composed(a: Column, b: Column, c: Column, h: Column) -> Column:
    """An identifier made of three words, with dates, versions and numbers in it.

    The form and the numbers are chosen by a hash of the words.
    """
    def number(most, place):
        return F.pmod(F.shiftright(h, place), F.lit(most))

    def digits(most, place, width):
        return F.lpad(number(most, place).cast("string"), width, "0")

    year = (1990 + number(40, 4)).cast("string")
    month = F.lpad((1 + number(12, 10)).cast("string"), 2, "0")
    day = F.lpad((1 + number(28, 16)).cast("string"), 2, "0")
    n, m = number(100, 22).cast("string"), number(1000, 30).cast("string")
    time = F.concat_ws("-", digits(24, 36, 2), digits(60, 42, 2), digits(60, 48, 2))
    date = F.concat_ws("-", year, month, day)
    forms = [
        F.concat_ws("_", a, b, c, F.concat(year, month, day)),
        F.concat_ws("-", a, b, date, c),
        F.concat_ws("-", F.concat(a, n), F.concat(b, m), c),
        F.concat_ws("_", F.lit("com"), a, b, F.concat(F.lit("v"), n), c),
        F.concat_ws("_", F.concat(date, F.lit("T"), time), a, b),
        F.concat_ws("/", F.lit(""), a, b, F.concat(F.lit("v"), n), F.concat(c, m)),
        F.concat(a, F.initcap(b), F.initcap(c), n),
        F.concat(F.upper(F.concat_ws("_", a, b, c)), F.lit("_"), m),
        F.concat_ws("_", F.concat(year, month, day), a, b, digits(10_000, 40, 4)),
        F.concat_ws("=", F.concat_ws("-", a, b), digits(10_000_000, 24, 7)),
    ]
    form, picked = F.pmod(h, F.lit(len(forms))), F.when(F.lit(False), "")
    for k, value in enumerate(forms):  # only the chosen one is made
        picked = picked.when(form == k, value)
    return picked


def vocabulary(texts: DataFrame) -> DataFrame:
    """(value, n): the runs of letters and joining signs of all texts and how often each stands, counted once."""
    words = texts.select(F.explode(F.regexp_extract_all(
        F.col("text"), F.lit(WORD), F.lit(0))).alias("value"))
    return stored(words.groupBy("value").agg(F.count("*").alias("n")), "words")


def composed_names(words: DataFrame) -> DataFrame:
    """(value, n): identifiers of each word with others that are about as frequent, as often as the word.

    Words are dealt out by hash, so that frequencies are compared among ``TOGETHER`` words at most or so.
    """
    parts = words.select("n", F.explode(F.regexp_extract_all("value", F.lit(PART), F.lit(0))).alias("a"))
    parts = parts.groupBy("a").agg(F.sum("n").alias("n"))
    groups = math.ceil(max(parts.count(), 1) / TOGETHER)
    near = Window.partitionBy("at").orderBy("n", "a")

    def partner(k):
        return F.coalesce(F.lead("a", k).over(near), F.lag("a", k).over(near))

    rows = parts.withColumn("at", F.pmod(F.xxhash64("a"), F.lit(groups))).select(
        "a", "n", *[partner(k).alias(f"p{k}") for k in range(1, 2 * NAMES + 1)])
    three = rows.select("a", "n", F.inline(F.array(*[F.struct(
        F.col(f"p{k}").alias("b"), F.col(f"p{k + NAMES}").alias("c")) for k in range(1, NAMES + 1)])))
    hashed = three.filter("b is not null and c is not null").withColumn("h", F.xxhash64("a", "b", "c"))
    # Made as a row of its own, or each filter on it would make it again.
    return hashed.select(F.explode(F.array(composed(*map(F.col, "abch")))).alias("value"), "n").filter(
        ~_keyed(F.col("value")))


def labelled_strings(docs: DataFrame) -> DataFrame:
    """(value, random, n): the secrets and the ordinary strings of all documents, and how often each stands."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    found = base_spans(texts).select(F.explode(F.array_distinct(F.transform(
        F.concat("assign", "access", "hex"), lambda x: x["value"]))).alias("value"))
    # Numbers in the hexadecimal format say nothing about letters.
    secret = found.filter(F.col("value").rlike("[A-Za-z]")).select(F.explode(F.array(
        "value", F.rtrim(F.base64(F.unhex(F.sha2("value", 256))), F.lit("=")),
        F.upper(F.left(F.sha2("value", 256), F.lit(40))))).alias("value"))
    words = vocabulary(texts)
    ordinary = words.filter(F.length("value") >= IDENTIFIER).unionByName(composed_names(words))
    return secret.select("value", F.lit(1).alias("random"), F.lit(1).cast("long").alias("n")).unionByName(
        ordinary.select("value", F.lit(0).alias("random"), "n"))


def _keyed(value: Column) -> Column:
    """Whether a string holds one of the fixed formats."""
    return value.rlike(ACCESS) | value.rlike(HEX)


def fold(value: Column) -> Column:
    """0, 1 or 2 by hash: the first two fit the models, the last the threshold."""
    return F.pmod(F.xxhash64(value), F.lit(3))


def fitted(docs: DataFrame) -> tuple[list[int], float]:
    """The model and the threshold from the labelled strings of all documents."""
    samples = stored(labelled_strings(docs), "strings")
    model = train(samples.filter(fold(F.col("value")) < 2))
    return model, threshold(samples.filter(fold(F.col("value")) == 2), model)


def _pairs(samples: DataFrame) -> DataFrame:
    """A row for each place ``i`` of ``v``, a string behind a character that stands for its start."""
    return samples.filter(F.length("value") > 0).select(
        "*", F.concat(F.lit(GROUPS[0]), "value").alias("v"),
        F.explode(F.sequence(F.lit(1), F.length("value"))).alias("i"))


def threshold(samples: DataFrame, model: list[int]) -> float:
    """Above it are no more than ``RARELY`` of the ordinary strings that could be candidates."""
    ordinary = samples.filter((F.col("random") == 0) & (F.length("value") >= 20)
                              & F.col("value").rlike("[0-9]"))
    # The sum of log_ratio() by rows, as long as there are many strings; then one row for each thousandth.
    weights = F.from_json(F.lit(json.dumps(model)), "array<int>")
    pair = [_state(F.substr("v", F.col("i") + k, F.lit(1))) for k in (0, 1)]
    summed = _pairs(ordinary).groupBy("value", "n").agg(
        F.sum(F.get(weights, pair[0] * STATES + pair[1])).alias("ratio"))
    ratios = summed.groupBy("ratio").agg(F.sum("n").alias("n"))
    top = ratios.agg(F.percentile("ratio", 1 - RARELY, F.col("n"))).first()[0]
    return THRESHOLD if top is None else max(THRESHOLD, top / UNIT + MARGIN)


def train(samples: DataFrame) -> list[int]:
    """Log ratios of the transition probabilities of random strings and identifiers, in thousandths.

    Half of a probability is that of the two characters, half that of their kinds
    (lower case, upper case, digits, signs), shared out evenly: letters that the
    texts' own words never put together are no evidence by themselves.  Without
    samples both models are equal.  The result has one entry per pair of states,
    whatever the size of the input.
    """
    counts = _pairs(samples).groupBy("random", F.substr("v", F.col("i"), F.lit(2)).alias("pair")).agg(
        F.sum("n").alias("n")).groupBy(
        "random", *[_state(F.substr("pair", F.lit(k), F.lit(1))).alias(c) for k, c in ((1, "a"), (2, "b"))]).agg(
        F.sum("n").alias("count")).collect()
    n = [[[0] * STATES for _ in range(STATES)] for _ in range(2)]
    kinds = [[[1.0] * len(GROUPS) for _ in GROUPS] for _ in range(2)]
    of = [next(k for k, g in enumerate(GROUPS) if c in g) for c in "\0" + ALPHABET]
    for row in counts:
        n[row["random"]][row["a"]][row["b"]] += row["count"]
        kinds[row["random"]][of[row["a"]]][of[row["b"]]] += row["count"]
    out = []
    for a in range(STATES):
        rows = []
        for side in range(2):
            total, around = sum(n[side][a]), kinds[side][of[a]]
            own = LETTERS if total else 0.0
            rows.append([own * n[side][a][b] / max(total, 1) + (1 - own) * around[of[b]] / (
                sum(around) * len(GROUPS[of[b]])) for b in range(STATES)])
        out += [round(UNIT * math.log(q / p)) for p, q in zip(*rows)]
    return out


def log_ratio(value: Column, model: list[int]) -> Column:
    """Sum of the log ratios along a string, in thousandths."""
    weights = F.from_json(F.lit(json.dumps(model)), "array<int>")

    def step(acc, i):
        at = _state(F.substr(value, i, F.lit(1)))
        return F.struct(at.alias("state"), (acc["sum"] + F.element_at(
            weights, acc["state"] * STATES + at + 1)).alias("sum"))

    return F.aggregate(F.sequence(F.lit(1), F.length(value)),
                       F.struct(F.lit(0).alias("state"), F.lit(0).alias("sum")), step,
                       lambda acc: acc["sum"])


def markov_spans(text: Column, base: Column, model: list[int], threshold: float) -> Column:
    """Long strings of letters and digits, outside the base spans, whose log ratio passes the threshold."""
    found = _where(text.rlike(CANDIDATE), matches(text, CANDIDATE))
    mixed = F.filter(found, lambda x: x["value"].rlike("[A-Za-z]"))
    free = F.filter(mixed, lambda x: ~F.exists(
        base, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))
    return F.filter(free, lambda x: log_ratio(x["value"], model) > int(threshold * UNIT))


def find_secrets(docs: DataFrame, model: list[int], threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text, assign, access, hex, markov): an array of (start, end, value) for each kind."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = base_spans(texts)
    base = F.concat("assign", "access", "hex")
    return rows.withColumn("markov", markov_spans(F.col("text"), base, model, threshold))


def secret_report(docs: DataFrame, model: list[int], threshold: float = THRESHOLD) -> DataFrame:
    """Per document the counts of the fixed formats, a digest of their spans, and all spans as text."""
    rows = find_secrets(docs, model, threshold)

    def keyed(kind):
        return F.transform(kind, lambda x: F.struct(
            x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
            x["end"].alias("end")))

    rows = rows.select("doc_id", *[keyed(k).alias(k) for k in KINDS])
    base = join_spans(F.concat("assign", "access", "hex"), KINDS)
    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        join_spans(F.concat(*KINDS), KINDS).alias("spans"))
