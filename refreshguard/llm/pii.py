"""Personal data: wide candidate generators, boosted trees, calibrated thresholds.

The fixed formats (mail address, IP address, card number, phone number) are
always reported.  Beside them, high-recall generators propose spans that may
overlap each other: numbers in any usual grouping and addresses in the forms
people write to hide them.  Boosted trees judge each by its format and its
context; Platt's curve makes their margin a probability, and a threshold per
kind, set where the precision on rows kept out of the fit reaches 0.98, selects
what is reported and redacted.

The trees, the curve and the thresholds are fitted to the candidates of all documents, each value once
in each form; a kind of more than ``SHARE`` candidates weighs as much as so many.  They are labelled where a rule decides:
numbers of digits, and for phone numbers the spans of the fixed format, with and
without their country code.  IP addresses and card numbers of the fixed format are
written in other ways, with spaced, bracketed or spelt dots and with other signs
between the groups, beside the same numbers as a version, score or order number.
Check digits and octets are no traits: they refuse candidates, the trees judge the rest.  Each of these is also
rewritten as a national number beside a word such as 'phone', so that the trees
see numbers without a plus in their context even if the texts have none, and
once as groups of digits without such a word, as a counter-example.  Mail
addresses are rewritten in the forms that hide them, with a host that a text
speaks of as counter-example, and ' at ' without a dotted host is none.  What no
rule decides is not used for the fit, and candidates that a rule refuses are not judged.  Texts are judged in their row: no shuffle, one batch in memory, and
every search is linear in the length of the text.

Defined cases: a null text is an empty one and, when redacting, stays null; an
empty text has no span; equal texts have equal spans; a table without candidates adds
nothing to the fixed formats; further columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored
from .boosting import BLOCK, Boosted, boost_blocks, calibrate, quantiles, valued
from .common import small_batches

#: A kind of more candidates than this has the weight of so many, as ' at ' in prose outnumbers all others.
SHARE = 2_500
FINE = 100  # margins are multiples of 1 / FINE
LARGEST = 1_000.0  # larger traits are one value to the cuts
PRECISION, LEAST = 0.98, 0.95

# The kinds in the order of the report, and their formats.
KINDS = ["email", "ip", "card", "phone"]
# Each format is tried where a match can begin only, so a long run costs its length once.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

NUMBER = re.compile(r"(?<![\w.+])\+?\(?[0-9]++(?:[\x20().,/:-]{1,2}[0-9]++)*(?!\w)")
#: Four numbers with dots that are spaced out, in brackets or spelt.
SPREAD = re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?:\x20?[\[({]\x20?(?:\.|dot)\x20?[\])}]\x20?"
                    r"|\x20?\.\x20?|\x20dot\x20)[0-9]{1,3}){3}(?!\w|\.[0-9])", re.I)
NEXT = re.compile(r"\+[0-9]++[\x20().-]{0,2}?(?=\(?[0-9])")  # a country code
#: Numbers that are dates, amounts or ranges of years, not phones.
DATED = re.compile(r"(?:(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}"
                   r"|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2})(?:[\x20,:./-].*)?"
                   r"|[0-9]{1,3}(?:[.,][0-9]{3})+(?:[.,][0-9]+)?|[0-9]+[.,][0-9]+"
                   r"|(?:19|20)[0-9]{2}\x20?[-/]\x20?(?:19|20)[0-9]{2}")
CALLED = re.compile(r"\b(?:tele)?(?:phone|fono|fon)s?\b|\b(?:tel|tél|call|dial|mobile|mobil|cell|fax|"
                    r"sms|whatsapp|hotline|móvil)\b")
AT = re.compile(r"(?:\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20|@)", re.I)
HOST = re.compile(r"[A-Za-z0-9-]++(?:(?:\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20|\.)"
                  r"[A-Za-z0-9-]++)*", re.I)
DOT = re.compile(r"\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20", re.I)
HINTS = [("mail", "e-mail", "contact"), ("ip", "host", "addr", "server"),
         ("card", "visa", "credit", "pay")]
RESULT = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "redacted string")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_card(text: str) -> bool:
    digits = _digits(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def is_ip(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(re.fullmatch("0*[0-9]{1,3}", p) and int(p[-3:]) <= 255
                                   for p in parts)


def local_start(text: str, at: int, least: int) -> int:
    """Where the local part of an address begins that ends at a place."""
    while at > least and text[at - 1].isascii() and (
            text[at - 1].isalnum() or text[at - 1] in "._%+-"):
        at -= 1
    return at


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from each ``@`` outwards, leftmost first."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = local_start(text, at, end)
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        # what stands before this sign is of no use to the next
        end = max(end, at + 1)
        at = text.find("@", end)


def base(text: str) -> list[Span]:
    """Spans of the fixed formats, by start and kind."""
    out: list[Span] = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if is_ip(m[0])]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text)
            if m.end() - m.start() >= 14 and is_card(m[0])]
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def phones(at: int, number: str) -> Iterator[Span]:
    """The number as a whole, without its country code, and its parts between commas and colons."""
    ends = [(0, len(number))]
    if code := NEXT.match(number):
        ends.append((code.end(), len(number)))
    if "," in number or ":" in number:
        ends += [m.span() for m in re.finditer(r"[+(]*[0-9](?:[^,:]*[0-9])?", number)]
    for a, b in dict.fromkeys(ends):
        if 7 <= len(_digits(number[a:b])) <= 15:
            yield at + a, 3, at + b


def candidates(text: str) -> list[Span]:
    """Spans that may be personal data; the fixed formats are among them."""
    out: list[Span] = []
    for m in NUMBER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        parts, code = m[0].split("."), NEXT.match(m[0])
        at = m.start() + (code.end() if code else 0)
        if 14 <= len(_digits(text[at:m.end()])) <= 19 and not (
                len(parts) == 4 and all(p.isdigit() and len(p) < 4 for p in parts)):
            out.append((at, 2, m.end()))
        out += phones(m.start(), m[0])
    out += [(m.start(), 1, m.end()) for m in SPREAD.finditer(text)]
    last = 0
    for m in AT.finditer(text):
        start = local_start(text, m.start(), last)
        host = HOST.match(text, m.end()) if start < m.start() else None
        if host:
            out.append((start, 0, host.end()))
        last = m.end()  # what stands before this sign is of no use to the next
    return out


def traits(text: str, span: Span) -> list[float]:
    """Format and context of a span.

    The signs that the fixed formats begin with are left out, and so are check digits and the size
    of octets, which are rules (``refused``) and no evidence.
    """
    start, kind, end = span
    value = text[start:end].removeprefix("+")
    plain = hidden = 0.0
    if kind == 0:  # an address as it is meant, and how it was hidden
        plain, hidden = float(AT.search(value)[0].lower() == " at "), float(bool(DOT.search(value)))
        value = DOT.sub(".", AT.sub("@", value, count=1))
    digits = _digits(value)
    groups = [len(g) for g in re.findall(r"[0-9]+", value)] or [0]
    parts = re.split(r"[^A-Za-z0-9-]+", value)
    around = text[max(0, start - 30):start].lower()
    before, after = text[start - 1:start] or " ", text[end:end + 1] or " "
    return [
        kind, len(value), len(digits), len(groups), max(groups), min(groups), groups[0], groups[-1],
        float(all(g == 4 for g in groups[:-1])), float("[" in value or "{" in value),
        value.lower().count("dot") if kind == 1 else 0,
        value.count("-"), value.count("."), value.count(" "), value.count("("),
        value.count("/") + value.count(":") + value.count(","),
        len(parts), len(parts[-1]), float(parts[-1].isalpha()), float(len(set(digits)) <= 2),
        float(before.isalnum()), float(after.isalnum()), float(before in ".,;:#$€"),
        float(bool(CALLED.search(around)) if kind == 3 else any(h in around for h in HINTS[kind])),
        plain, hidden, value.partition("@")[2].count("."),
    ]


class Fixed:
    """The spans of the fixed formats of a text, to compare candidates with."""

    def __init__(self, spans: list[Span]):
        self.phones = {b: a for a, kind, b in spans if kind == 3}
        self.others = {(a, b) for a, kind, b in spans if kind != 3}
        self.starts = sorted(a for a, _, _ in spans)
        self.ends = list(accumulate((b for _, _, b in sorted((a, 0, b) for a, _, b in spans)), max))

    def touches(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start


def known(text: str, span: Span, fixed: Fixed) -> int:
    """1 or 0 where a rule decides, else -1; addresses and cards are learnt from ``respelled`` ones only."""
    start, kind, end = span
    value = text[start:end]
    if kind == 0:
        at = AT.search(value)
        dotted = "." in value[at.end():] or DOT.search(value, at.end())
        if at[0] == "@" and not DOT.search(value):
            return int("." in value[at.end():])
        return 0 if at[0].lower() == " at " and not dotted else -1
    if kind in (1, 2):
        return -1
    first = fixed.phones.get(end)
    if first is not None and (first == start or (code := NEXT.match(text, first))
                              and code.end() == start):
        return 1
    if (start, end) in fixed.others:
        return 0
    if fixed.touches(start, end):
        return -1
    n, before = len(_digits(value)), text[max(0, start - 30):start]
    if value[0] == "+":
        return 0 if not 10 <= n <= 15 else 1 if value[1] == "(" else -1
    if DATED.fullmatch(value):
        return 0
    if CALLED.search(before.lower()):
        return -1
    return 0 if n < 10 or value.isdigit() or before.rstrip("\x20")[-1:] in ("$", "€", "£") else -1


def refused(text: str, span: Span) -> bool:
    """Whether a rule says that a candidate is no personal data."""
    start, kind, end = span
    if kind == 1:
        return any(int(g) > 255 for g in re.findall(r"[0-9]+", text[start:end]))
    if kind == 2:
        return not is_card(text[start:end])
    return known(text, span, NOTHING) == 0


def respelled(value: str, kind: int, turn: int) -> list[tuple[str, Span, int]]:
    """An IP address or a card number of the fixed format written in other ways, beside a word for it or
    none (1), and its numbers as those of a version, an order or a list (0)."""
    d = _digits(value)
    if kind == 1:
        a, b, c, e = (g[-3:] for g in value.split("."))
        forms = [x.join((a, b, c, e)) for x in ("[.]", "(.)", " . ", "[dot]", " dot ", " (dot) ", ". ")]
        picked = [(w, forms[(turn + k) % 7], 1) for k, w in enumerate(("ip ", "server ", "host at "))]
        picked += [(w, forms[(2, 6)[turn // 7 % 2]], 0) for w in ("version ", "scores ")]
    else:
        fours = [d[k:k + 4] for k in range(0, len(d), 4)]
        uneven = [d[:turn % 3 + 2], d[turn % 3 + 2:turn % 3 + 8], d[turn % 3 + 8:]]
        forms = [x.join(fours) for x in (".", "/", "  ", " -", ". ", ", ")]
        picked = [(w, forms[(turn + k) % 6], 1) for k, w in enumerate(("card ", "visa ", "credit card: "))]
        picked += [(w, "./:"[turn // 6 % 3].join(uneven), 0) for w in ("order ", "serial no ")]
    return [(w + x, (len(w), kind, len(w) + len(x)), y) for w, x, y in picked]


def disguised(value: str, turn: int) -> list[tuple[str, Span, int]]:
    """A mail address in three forms that hide it (1), and its host where a text speaks of it (0)."""
    local, _, host = value.partition("@")
    short = ".".join(host.split(".")[-2:])
    word = re.sub("[^A-Za-z]+", "", local) or "jo"
    dots = [short.replace(".", d) for d in (" dot ", "(dot)", " [dot] ")]
    forms = [("", f"{word}{{at}}{short}"), ("", f"{word} (at) {short}"), ("", f"{local} [at] {host}"),
             ("", f"{word} at {dots[0]}"), ("", f"{word}(at){dots[1]}"), ("", f"{word} [at] {dots[2]}"),
             ("mail: ", f"{word} at {short}"), ("", f"{word}@{short}")]
    picked = [(*forms[(turn + k) % 8], 1) for k in (0, 3, 6)]
    picked.append(("the ", f"{word} at {short if turn // 8 % 2 else host}", 0))
    return [(before + x, (len(before), 0, len(before) + len(x)), y) for before, x, y in picked]


def rewritten(value: str, turn: int) -> list[tuple[str, Span, int]]:
    """A phone number of the fixed format as a national one, twice beside a word that names it (1) and
    once in groups of any number without such a word (0); ``turn`` picks the forms."""
    code = NEXT.match(value)
    d = _digits(value[code.end():] if code else value)
    if not 7 <= len(d) <= 14:
        return []
    a, b, c = d[:3], d[3:-4], d[-4:]
    home = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a} {b} {c}", f"{a} {b}{c}", f"0{a} {b}{c}",
            f"0{d[:2]} {d[2:]}", f"0{a}/{b}{c}", f"{b}-{c}", f"{a}.{b}.{c}", d]
    any_ = [f"{a} {b} {c}", f"0{a}/{b}{c}", f"{a}.{b}.{c}", f"{d[:4]}-{d[4:8]}-{d[8:]}0",
            f"{d[:2]}-{d[2:6]}-{d[6:]}", f"{a}-{d[3]}-{d[4:6]}-{d[6:]}"]
    picked = [("phone ", home[turn % 10], 1), ("Tel. ", home[(turn + 5) % 10], 1),
              ("the ", any_[turn // 10 % 6], 0)]
    return [(word + x, (len(word), 3, len(word) + len(x)), y) for word, x, y in picked
            if 7 <= len(_digits(x)) <= 15]


NOTHING = Fixed([])  # candidates that are judged touch no span of the fixed formats


def stepped(margin: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(margin, -30, 30) * FINE) / FINE


def probability(margin: np.ndarray, slope: float, offset: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))


@dataclass
class Model:
    trees: Boosted
    slope: float
    offset: float
    thresholds: list[float]

    def chosen(self, text: str, taken: list[Span]) -> list[Span]:
        """Candidates above their threshold that touch no span of the fixed formats."""
        busy = Fixed(taken)
        free = [c for c in candidates(text) if not busy.touches(c[0], c[2])]
        free = [c for c in free if self.thresholds[c[1]] <= 1 and not refused(text, c)]
        if not free:
            return []
        margin = self.trees.margin(np.array([traits(text, c) for c in free]))
        p = probability(stepped(margin), self.slope, self.offset)
        good = sorted(((q, c) for q, c in zip(p, free) if q >= self.thresholds[c[1]]),
                      key=lambda x: (-x[0], x[1]))
        out: list[tuple[int, int, int]] = []  # apart from each other, by start: (start, end, kind)
        for _, (start, kind, end) in good:  # overlapping proposals: the likeliest one stays
            place = bisect_left(out, (start,))
            if (place == len(out) or out[place][0] >= end) and (
                    not place or out[place - 1][1] <= start):
                out.insert(place, (start, end, kind))
        return [(start, kind, end) for start, end, kind in out]


def thresholds(found: pd.DataFrame, slope: float, offset: float) -> list[float]:
    """Per kind the middle between the last margin of (kind, margin, y, n) down to which the precision is
    ``PRECISION`` and the next one; 2, that none has, if there is no such margin."""
    out = []
    for kind in range(len(KINDS)):
        mine = found[found["kind"] == kind].sort_values("margin", ascending=False)
        steps = mine.assign(right=mine["n"] * mine["y"]).groupby("margin", sort=False)[["n", "right"]].sum().cumsum()
        enough = np.flatnonzero(steps["right"] >= PRECISION * steps["n"])
        if not len(enough):
            out.append(2.0)
            continue
        between = steps.index.to_numpy(float)[enough[-1]:][:2].mean()
        out.append(max(LEAST, float(probability(between, slope, offset))))
    return out


def fit(found: DataFrame) -> Model:
    """Trees from folds 0 and 1 of (fold, x, y), the curve and the thresholds from fold 2."""
    kind = F.col("x")[0].cast("int")
    sizes = found.groupBy("fold", kind.alias("kind"), "y").count().toPandas()
    of = sizes.groupby("kind")["count"].sum()
    weights = [min(1.0, SHARE / of.get(k, 1)) for k in range(len(KINDS))]
    sizes["w"] = sizes["count"] * sizes["kind"].map(dict(enumerate(weights)))
    own = sizes[sizes["fold"] < 2]
    if own["y"].nunique() < 2 or not (sizes["fold"] == 2).any():
        return Model(Boosted(), 1.0, 0.0, [2.0] * len(KINDS))
    values = found.filter("fold < 2").select(kind.alias("kind"), F.posexplode("x").alias("f", "v")).groupBy(
        "kind", "f", F.least("v", F.lit(LARGEST)).alias("v")).count().toPandas()
    values["w"] = values["count"] * values["kind"].map(dict(enumerate(weights)))
    totals = values.groupby(["f", "v"])["w"].sum().reset_index()
    cuts = [quantiles(t["v"].to_numpy(), t["w"].to_numpy()) for _, t in totals.groupby("f")]

    def packed(batches):
        held: list[tuple] = []

        def block():
            x = np.array([r[0] for r in held])
            codes = np.column_stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)])
            return pd.DataFrame([(codes.astype(np.uint8).tobytes(),
                                  np.array([r[1] for r in held], np.uint8).tobytes(),
                                  x[:, 0].astype(np.uint8).tobytes())], columns=["codes", "y", "kind"])

        for batch in batches:
            held += zip(batch["x"], batch["y"])
            if len(held) >= BLOCK:
                yield block()
                held = []
        if held:
            yield block()

    blocks = stored(found.filter("fold < 2").select("x", "y").mapInPandas(
        packed, "codes binary, y binary, kind binary"), "blocks")
    few = own["count"].sum() <= BLOCK
    share = (own["w"] * own["y"]).sum() / own["w"].sum()
    trees = valued(boost_blocks([tuple(map(bytes, r)) for r in blocks.collect()] if few else blocks, share, weights,
                         [len(c) for c in cuts]), cuts)

    def judged(batches):
        for batch in batches:
            if len(batch):
                x = np.array(batch["x"].tolist())
                yield pd.DataFrame({"kind": x[:, 0].astype(int), "margin": stepped(trees.margin(x)),
                                    "y": batch["y"]})

    rest = found.filter("fold = 2").select("x", "y").mapInPandas(judged, "kind int, margin double, y int")
    rest = rest.groupBy("kind", "margin", "y").agg(F.count("*").alias("n")).toPandas().sort_values(
        ["kind", "margin", "y"])
    slope, offset = calibrate(rest["margin"].to_numpy(), rest["y"].to_numpy(float), (
        rest["n"] * rest["kind"].map(dict(enumerate(weights)))).to_numpy(float))
    return Model(trees, slope, offset, thresholds(rest, slope, offset))


def labelled_candidates(docs: DataFrame) -> DataFrame:
    """(fold, x, y): the traits and labels of the candidates of all documents, each value once in each form."""
    small_batches(docs.sparkSession)

    def labelled(batches):
        for batch in batches:
            rows = []
            for text in batch["text"]:
                fixed = base(text) if text else []
                spans = Fixed(fixed)
                for c in candidates(text) if text else ():
                    y = known(text, c, spans)
                    if y >= 0:
                        # A value is another one for each kind, but in the same fold.
                        rows.append((c[1], text[c[0]:c[2]], traits(text, c), y))
                for a, kind, b in fixed:
                    crc = zlib.crc32(text[a:b].encode())
                    new = (disguised(text[a:b], crc) if kind == 0 else rewritten(text[a:b], crc)
                           if kind == 3 else respelled(text[a:b], kind, crc))
                    rows += [(k, text[a:b], traits(*of), y)
                             for k, (*of, y) in enumerate(new, len(KINDS))]
            yield pd.DataFrame(rows, columns=["form", "value", "x", "y"])

    found = docs.select("text").mapInPandas(labelled, "form int, value string, x array<double>, y int")
    # A value counts once in each form, however many copies of a document there are.
    found = found.groupBy("form", "value").agg(F.min(F.struct("x", "y")).alias("r"))
    return found.select((F.crc32("value") % 3).cast("int").alias("fold"), "r.x", "r.y")


def train(docs: DataFrame) -> Model:
    """A model from the candidates of all documents, found and summed up on the executors."""
    return fit(stored(labelled_candidates(docs), "candidates"))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the name of its first kind."""
    parts, at = [], 0
    merged: list[list[int]] = []
    for start, kind, end in sorted(spans):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([start, kind, end])
    for start, kind, end in merged:
        parts += [text[at:start], f"[{KINDS[kind]}]"]
        at = end
    return "".join([*parts, text[at:]])


def finder(model: Model, redact: bool):
    """The model as a column function of a text; without ``redact`` no text is sent back."""
    def name(spans):
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)

    @F.pandas_udf(RESULT)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                whole = text or ""
                fixed = base(whole)
                spans = sorted(fixed + model.chosen(whole, fixed))
                counts = [sum(k == kind for _, k, _ in fixed) for kind in range(len(KINDS))]
                new = redacted(text, spans) if redact and spans else None
                rows.append((*counts, hashlib.sha256(name(fixed).encode()).hexdigest(),
                             name(spans), new))
            yield pd.DataFrame(rows, columns=[p.split()[0] for p in RESULT.split(", ")])

    return find


def pii_report(docs: DataFrame, model: Model) -> DataFrame:
    """Per document the counts of the fixed formats, a digest of their spans, and all spans."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", finder(model, False)(F.col("text")).alias("p"))
    return rows.select("doc_id", *[f"p.n_{k}" for k in KINDS], "p.base_sha256", "p.spans")


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with their spans replaced; ``n_chars`` follows the text, the rest is as it was."""
    small_batches(docs.sparkSession)
    own = [F.col(f"doc.{c}") for c in docs.columns if c not in ("text", "n_chars")]
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
                       finder(model, True)(docs["text"])["redacted"].alias("new"))
    text = F.coalesce("new", "doc.text")
    changed = rows.select(
        *own, text.alias("text"), *([F.when(F.col("new").isNull(), F.col("doc.n_chars")).otherwise(
            F.length("new")).cast(docs.schema["n_chars"].dataType).alias("n_chars")]
            if "n_chars" in docs.columns else []))
    return changed.select(*docs.columns)
