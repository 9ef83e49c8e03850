"""Word shingles of whole texts as 64-bit hashes, in vectorised form.

Words are runs of bytes other than ASCII white space, with A-Z in lower case.
A word's hash is a polynomial over random values of its bytes; a shingle's is a
polynomial over its words' hashes, both modulo 2**64 and then mixed. Equal
words always get equal hashes; for different ones, equality is as unlikely as
for any 64-bit hash.
"""

from __future__ import annotations

import re

import numpy as np

from stratum.llm import worker

_RNG = np.random.default_rng(20240607)
_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_EXACT = _VALUE.copy()
for _c in range(ord("A"), ord("Z") + 1):
    _VALUE[_c] = _VALUE[_c + 32]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


_CACHE: dict[int, np.ndarray] = {}
worker.remembers(_CACHE.clear)


def _power_table(base: int, n: int) -> np.ndarray:
    if len(_CACHE.get(base, ())) < n:
        _CACHE[base] = _powers(base, 1 << max(16, (n - 1).bit_length()))
    return _CACHE[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split(texts: list[bytes], fold: bool = True) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(all texts in one, start and end of each word there, its hash, first word
    of each text and the end) of UTF-8 texts; ``fold``: A-Z count as a-z."""
    joined = b"\n".join(texts) + b"\n"
    blob = np.frombuffer(joined, np.uint8)
    edge = np.diff(_SPACE[blob].view(np.int8), prepend=np.int8(1))
    cuts = np.flatnonzero(edge)
    start, end = cuts[0::2], cuts[1::2]  # the last byte is white space
    value = (_VALUE if fold else _EXACT)[blob]
    value *= _power_table(_BASE, len(blob))
    sums = np.cumsum(value, dtype=np.uint64)
    before = np.where(start > 0, sums[start - 1], np.uint64(0))
    h = mix((sums[end - 1] - before) * _power_table(_INVERSE, len(blob))[start] + (end - start).astype(np.uint64))
    heads = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    return joined, start, end, h, np.searchsorted(start, heads)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and the end) of UTF-8 texts."""
    return split(texts)[3:]


LONG = 1 << 18  # bytes of a text that is cut into pieces, so that arrays stay small
_BREAK = re.compile(rb"[\t-\r ]")


def shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, end to end, and their bounds.

    A text with fewer than ``size`` words has its whole word sequence as its
    only shingle; one without words has none. A long text is read in pieces that
    end between words; only its distinct hashes (8 bytes each) are held whole.
    """
    if all(len(t) <= LONG for t in texts):
        return _shingles(texts, size)
    sets, run = [], []
    for t in texts:
        if len(t) <= LONG:
            run.append(t)
            continue
        if run:
            sets.append(_shingles(run, size))
            run = []
        own = _long_set(t, size)
        sets.append((own, np.array([0, len(own)], np.int64)))
    if run:
        sets.append(_shingles(run, size))
    counts = np.concatenate([np.diff(b) for _, b in sets])
    return np.concatenate([v for v, _ in sets]), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _long_set(text: bytes, size: int) -> np.ndarray:
    """Distinct shingle hashes of one text, sorted."""
    more = re.compile(rb"(?:[\t-\r ]+[^\t-\r ]+){0,%d}" % (size - 1))
    found, at = [], 0
    while at < len(text):
        gap = _BREAK.search(text, min(at + LONG // 2, len(text)))
        cut = gap.start() if gap else len(text)
        piece = text[at:more.match(text, cut).end()]  # with the words that its last shingles need
        h = word_hashes([piece])[0]
        if len(h) >= size:
            found.append(_distinct(_hashed(h, size)))
        at = max(cut, at + 1)
    if not found:  # too few words: all of them are one
        return _shingles([b" ".join(text.split())], size)[0]
    return _distinct(np.concatenate(found))


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _hashed(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    value = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        value = value * _STEP + h[k:len(h) - size + 1 + k]
    return mix(value + np.uint64(size))


def _shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    h, first = word_hashes(texts)
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(texts)), count)
    bounds = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(first[:-1], count) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], count)
    width = np.minimum(n, size)[owner]
    value = np.zeros(len(at), np.uint64)
    for k in range(size):
        part = h[np.minimum(at + k, len(h) - 1)] if len(h) else h
        value = np.where(k < width, value * _STEP + part, value)
    value = mix(value + width.astype(np.uint64))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[keep], owner[keep]
    return value, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int64)
