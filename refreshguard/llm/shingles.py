"""Sets of hashed word shingles of whole texts, with array operations only.

Words are runs of bytes other than space, tab to carriage return; A-Z are
lowered first.  A word, and a sequence of five words, is a 64-bit hash; two
different ones meet with probability 2^-64.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np

WORDS = 5
GROUP, PIECE = 300_000, 4_000_000  # bytes worked on together
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[[32, 9, 10, 11, 12, 13]] = 0
_BYTE[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xBF58476D1CE4E5B9)
_PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_power = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _power
    if len(_power) < n:
        _power = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(
            np.full(2 * n, _BASE, dtype=np.uint64))])
    return _power


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _STEP
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in some bytes, and where they start."""
    value = _BYTE[raw]
    inside = np.zeros(len(raw) + 1, dtype=np.int8)
    inside[1:] = value != 0
    starts = np.flatnonzero(np.diff(inside) == 1)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    value = value[starts[0]:]
    begin = starts - starts[0]
    spans = np.diff(begin, append=len(value))
    place = np.arange(len(value)) - np.repeat(begin, spans)
    return mix(np.add.reduceat(value * _powers(int(spans.max()) + 1)[place], begin)), starts


def _pieces(raw: bytes) -> list[bytes]:
    """The bytes in parts of about ``PIECE``, cut at white space."""
    out, at = [], 0
    while len(raw) - at > PIECE:
        space = _SPACE.search(raw, at + PIECE)
        end = space.start() if space else len(raw)
        out.append(raw[at:end])
        at = end
    return [*out, raw[at:]]


def _group_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The shingle sets of some texts, computed side by side."""
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    hashes, starts, offset = [], [], 0
    for piece in _pieces(b"\n".join(texts)):
        h, at = _word_hashes(np.frombuffer(piece, dtype=np.uint8))
        hashes.append(h)
        starts.append(at + offset)
        offset += len(piece)
    h = np.concatenate(hashes)
    doc = np.searchsorted(begins, np.concatenate(starts), side="right") - 1
    words = np.bincount(doc, minlength=len(texts))
    n = max(0, len(h) - WORDS + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(WORDS):
        total += h[k:n + k] * _PLACE[k]
    within = doc[:n] == doc[WORDS - 1:] if n else np.zeros(0, dtype=bool)
    s, of = mix(total[within]).view(np.int64), doc[:n][within]
    ends = np.cumsum(np.bincount(of, minlength=len(texts)))
    first = 0
    for end in ends:
        s[first:end].sort()
        first = end
    fresh = np.ones(len(s), dtype=bool)
    fresh[1:] = (s[1:] != s[:-1]) | (of[1:] != of[:-1])
    sizes = np.cumsum(np.bincount(of[fresh], minlength=len(texts)))
    out = np.split(s[fresh], sizes[:-1])
    first_word = np.cumsum(words) - words
    for i in np.flatnonzero((words > 0) & (words < WORDS)):
        few = h[first_word[i]:first_word[i] + words[i]]
        out[i] = mix((few * _PLACE[:len(few)]).sum(keepdims=True)
                     + np.uint64(len(few))).view(np.int64)
    return out


def shingle_sets(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, ascending.

    A text of fewer words than a shingle has is one shingle; one without words
    has none.
    """
    group: list[bytes] = []
    size = 0
    for text in texts:
        group.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(group[-1])
        if size > GROUP:
            yield from _group_sets(group)
            group, size = [], 0
    if group:
        yield from _group_sets(group)


def set_key(shingles: np.ndarray) -> int:
    """One number for equal sets."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)
