"""Token ids from tokenizer files of the ``tokenizers`` library.

The file's path is a parameter; encoders are kept per worker process.
"""

from __future__ import annotations

import json
import os
from array import array
from functools import lru_cache

import numpy as np

from stratum.llm import words, worker

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs one task a core

_TAILS = ".,;:!?"
# Bounds of what a worker remembers: places of the word table (20 bytes each),
# ids of words, and letters-only words (about 200 bytes each).
_PLACES, _POOL, _STEMS = 1 << 20, 1 << 22, 200_000
_MASK = np.uint64(_PLACES - 1)
# Tokenizers whose letters-only words go straight to the merge table: lower
# case, then bytes as printable characters.
_LOWER = (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"])


def _printable_bytes() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(0x100 + i) for i, b in enumerate(rest)}}


class Encoder:
    """Ids of many texts at once.

    A tokenizer whose tokens never span white space gives each word the same
    ids wherever it stands, so words - as 64-bit hashes - are looked up in a
    bounded table, and only new ones are encoded. Whether the file is of that
    kind is probed; any other file is applied to whole texts. Words that find
    no place in the table are encoded whenever they come up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.vocab = self.tok.get_vocab_size(with_added_tokens=True)
        probe = ["Ab,", "cd", "'s", "éx-7", "<|x", " y"]
        self.by_word = self._ids(" \n".join(probe)) == [i for w in probe for i in self._ids(w)]
        spec = json.loads(self.tok.to_str())
        kinds = [[x["type"] for x in (spec[part] or {}).get(key, [])]
                 for part, key in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        self.lower = tuple(kinds) == _LOWER
        self.printable = _printable_bytes()
        self.stems: dict[str, bytes] = {}
        self.tails = {t: self._each([t])[0] for t in _TAILS}
        # Each word has two places; a free place has count -1.
        self.key = np.zeros(_PLACES, np.uint64)
        self.at = np.zeros(_PLACES, np.int64)
        self.count = np.full(_PLACES, -1, np.int32)
        self.pool, self.used = np.zeros(1 << 20, np.uint32), 0

    def _ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _merge(self, stem: str) -> bytes:
        if not stem.isascii():
            stem = stem.encode().decode("latin-1").translate(self.printable)
        return array("I", [t.id for t in self.tok.model.tokenize(stem)]).tobytes()

    def _words(self, new: list[str]) -> list[bytes]:
        """Ids of single words."""
        stems, tails, merge, out, other = self.stems, self.tails, self._merge, [], []
        for w in new:
            tail = tails.get(w[-1], b"")
            stem = w[:-1] if tail else w
            low = stem.lower()
            # Below U+0250 lower case needs no context and no composition.
            if self.lower and low.isalpha() and (stem.isascii() or max(stem) < "ɐ"):
                ids = stems.get(low)
                if ids is None:
                    ids = merge(low)
                    if len(stems) < _STEMS:
                        stems[low] = ids
                out.append(ids + tail)
            else:
                other.append(len(out))
                out.append(b"")
        for i, ids in zip(other, self._each([new[i] for i in other]) if other else []):
            out[i] = ids
        return out

    def _store(self, key: np.ndarray, ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Put new words into the pool, and into the table where a place is free."""
        fresh = np.frombuffer(b"".join(ids), np.uint32)
        if self.used + len(fresh) > _POOL:  # only words in the table are looked up again
            held = np.flatnonzero(self.count >= 0)
            n = self.count[held].astype(np.int64)
            self.pool, self.used = _gather(self.pool, self.at[held], n), int(n.sum())
            self.at[held] = np.cumsum(n) - n
        if self.used + len(fresh) > len(self.pool):
            self.pool = np.concatenate([self.pool[:self.used], np.zeros(max(len(fresh), self.used), np.uint32)])
        count = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        at = self.used + np.cumsum(count) - count
        self.pool[self.used:self.used + len(fresh)] = fresh
        self.used += len(fresh)
        todo = np.arange(len(key))
        for place in (key & _MASK, key >> np.uint64(32) & _MASK):
            own = todo[self.count[place[todo]] < 0]
            own = own[np.unique(place[own], return_index=True)[1]]
            self.key[place[own]], self.at[place[own]], self.count[place[own]] = key[own], at[own], count[own]
            todo = np.setdiff1d(todo, own, assume_unique=True)
        return at, count

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, their bounds)."""
        if not self.by_word:
            raw = self._each(texts)
            return np.frombuffer(b"".join(raw), np.uint32), np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw], dtype=np.int64)])
        joined, start, end, h, first = words.split([t.encode() for t in texts], fold=self.lower)
        at, count = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        todo = np.arange(len(h))
        for place in ((h & _MASK).astype(np.int64), (h >> np.uint64(32) & _MASK).astype(np.int64)):
            p = place[todo]
            hit = (self.key[p] == h[todo]) & (self.count[p] >= 0)
            got, p = todo[hit], p[hit]
            at[got], count[got] = self.at[p], self.count[p]
            todo = todo[~hit]
        if len(todo):
            new, one, back = np.unique(h[todo], return_index=True, return_inverse=True)
            one = todo[one]
            ids = self._words([joined[s:e].decode() for s, e in zip(start[one].tolist(), end[one].tolist())])
            found = self.pool
            if self.used + sum(map(len, ids)) // 4 > _POOL:
                # The pool is about to be compacted: take what is known out of it first.
                found = _gather(self.pool, at, count)
                at = np.cumsum(count) - count
                size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                extra = len(found) + np.cumsum(size) - size
                found = np.concatenate([found, np.frombuffer(b"".join(ids), np.uint32)])
                self._store(new, ids)
                at[todo], count[todo] = extra[back], size[back]
            else:
                new_at, new_count = self._store(new, ids)
                found = self.pool
                at[todo], count[todo] = new_at[back], new_count[back]
        else:
            found = self.pool
        sums = np.concatenate([[0], np.cumsum(count)])
        return _gather(found, at, count), sums[first]


def _gather(pool: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """pool[at : at + count] of every row, end to end."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(at - (ends - count), count) + np.arange(total)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


worker.remembers(encoder.cache_clear)


def batches(texts: list[str | None], chars: int = 1 << 19):
    """(first index, texts) in runs of about ``chars`` characters; null is empty."""
    at, run, size = 0, [], 0
    for i, t in enumerate(texts):
        run.append(t or "")
        size += len(t or "")
        if size >= chars:
            yield at, run
            at, run, size = i + 1, [], 0
    if run:
        yield at, run


def narrow(vocab: int) -> str:
    """The smallest stored type for ids."""
    return "<u2" if vocab <= 1 << 16 else "<u4"
