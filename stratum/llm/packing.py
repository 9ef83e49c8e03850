"""Packing documents into fixed windows by non-negative least squares.

1. ``cut`` tokenizes documents and cuts them at multiples of the window; the
   pieces are stored once.
2. The histogram of piece lengths (at most ``window`` rows) goes to the driver.
   ``plan`` rounds lengths up to ``classes`` classes, enumerates all
   combinations of at most ``depth`` classes that fill the window, and solves
   for the repeat count of each by non-negative least squares against the
   histogram. Rounded counts are filled with exact lengths (longest of one
   class with shortest of the next); what is left over is packed greedily,
   longest first, into the tightest gap.
3. Pieces are numbered within their length, and the number selects the row of
   the plan. A plan's size depends on the window, not on the number of pieces.

Defined results: null text is the empty text, which still has its end id;
repeated rows are separate documents; null ids are kept; an empty table gives
an empty result; a very long text is encoded whole, in the memory of one task
(about 30 bytes for each of its own), and cut into pieces there. Ties (pieces of one length) are numbered by id and start.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import tokens, worker
from stratum.llm.numbering import number_within
from stratum.session import scratch_path

WINDOW, END_ID = 2048, 1
PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"


def cut(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of the token ids of ``docs`` (doc_id, text), the end id included.

    ``ids`` holds little-endian ids in ``tokens.narrow`` of the vocabulary,
    ``ids_crc32`` is taken over them as 32-bit integers.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        kind = tokens.narrow(enc.vocab)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, texts in tokens.batches(batch.column(1).to_pylist()):
                rows = []
                flat, bounds = enc.encode(texts)
                for i, doc_id in enumerate(ids[at:at + len(texts)]):
                    raw = flat[bounds[i]:bounds[i + 1]].tobytes() + end
                    n = len(raw) // 4
                    for s in range(0, n, window):
                        part = raw[4 * s:4 * (s + window)]
                        rows.append((doc_id, s, len(part) // 4, n, zlib.crc32(part),
                                     np.frombuffer(part, "<u4").astype(kind).tobytes()))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(cols[5], pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(worker.task("tokens", pieces), PIECE_SCHEMA)


def nnls(a: np.ndarray, b: np.ndarray, steps: int = 2000) -> np.ndarray:
    """argmin |a x - b| with x >= 0, by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    slope = a.T @ b
    tol = 1e-10 * max(1.0, float(np.abs(slope).max(initial=0.0)))
    for _ in range(steps):
        if passive.all() or not (slope[~passive] > tol).any():
            break
        passive[np.argmax(np.where(passive, -np.inf, slope))] = True
        while True:
            z = np.zeros(n)
            z[passive] = np.linalg.lstsq(a[:, passive], b, rcond=None)[0]
            low = passive & (z <= 0)
            if not low.any():
                break
            x += np.min(x[low] / np.maximum(x[low] - z[low], 1e-300)) * (z - x)
            passive &= x > 1e-12
            x[~passive] = 0
        x = z
        slope = a.T @ (b - a @ x)
    return x


def combinations(total: int, depth: int, largest: int | None = None) -> list[tuple[int, ...]]:
    """Multisets of at most ``depth`` positive integers with sum ``total``, largest first."""
    if depth == 0 or total == 0:
        return [()] if total == 0 else []
    top = min(total, largest or total)
    return [(c, *rest) for c in range(top, -(-total // depth) - 1, -1) for rest in combinations(total - c, depth - 1, c)]


class _Stock:
    """Pieces not yet placed, by length; numbers are given out in order."""

    def __init__(self, histogram: dict[int, int]):
        self.left, self.next = dict(histogram), dict.fromkeys(histogram, 0)

    def take(self, length: int, n: int) -> int:
        at = self.next[length]
        self.next[length] += n
        self.left[length] -= n
        return at

    def runs(self, lengths: list[int], n: int) -> list[tuple[int, int]]:
        """(length, how many): n pieces in the order of ``lengths``; not yet taken."""
        out = []
        for length in lengths:
            k = min(n, self.left.get(length, 0))
            if k:
                out.append((length, k))
                n -= k
        return out


def plan(histogram: dict[int, int], window: int = WINDOW, classes: int = 64, depth: int = 3) -> np.ndarray:
    """Rows (length, first number, count, first sequence, offset): piece number
    ``first + i`` of that length goes to sequence ``first sequence + i``."""
    stock = _Stock({k: v for k, v in sorted(histogram.items()) if v})
    if stock.left and not 1 <= min(stock.left) <= max(stock.left) <= window:
        raise ValueError("lengths must be between 1 and the window")
    unit = -(-window // classes)
    member: dict[int, list[int]] = {}
    for length in sorted(stock.left):
        member.setdefault(-(-length // unit), []).append(length)
    units = window // unit
    target = np.zeros(units + 2)
    for c, lengths in member.items():
        target[min(c, units + 1)] += sum(stock.left[x] for x in lengths)
    rows: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, count)
    sizes: list[int] = []  # the keys of gaps, sorted
    made = 0

    def leave(gap: int, seq: int, n: int) -> None:
        if gap not in gaps:
            gaps[gap] = []
            insort(sizes, gap)
        gaps[gap].append((seq, n))

    def place(lengths: list[int], n: int) -> None:
        nonlocal made
        at = 0
        for length in lengths:
            rows.append((length, stock.take(length, n), n, made, at))
            at += length
        if at < window:
            leave(window - at, made, n)
        made += n

    if stock.left.get(window):
        place([window], stock.left[window])
    target[units] -= histogram.get(window, 0)
    combos = [c for c in combinations(units, depth) if all(x in member for x in c)]
    if combos and target.sum() > 0:
        a = np.zeros((units + 2, len(combos)))
        for j, c in enumerate(combos):
            for x in c:
                a[x, j] += 1
        repeats = np.rint(nnls(a, target / target.sum()) * target.sum()).astype(int)
        for j in np.argsort(-repeats, kind="stable"):
            combo = combos[j]
            n = int(repeats[j])
            for c in set(combo):
                n = min(n, sum(stock.left[x] for x in member[c]) // combo.count(c))
            while n > 0:
                # The longest of the first class meets the shortest of the
                # second, so the exact sums stay close to the window.
                heads, seen = [], {}
                for i, c in enumerate(combo):
                    lengths = member[c] if i % 2 else member[c][::-1]
                    run = next((x, stock.left[x] - seen.get(x, 0)) for x in lengths if stock.left[x] > seen.get(x, 0))
                    seen[run[0]] = seen.get(run[0], 0) + 1
                    heads.append(run[0])
                k = min([n, *(stock.left[x] // heads.count(x) for x in set(heads))])
                place(heads, max(1, k))
                n -= max(1, k)
    for length in sorted(stock.left, reverse=True):
        while (n := stock.left[length]) > 0:
            i = bisect_left(sizes, length)
            if i < len(sizes):
                fit = sizes[i]
                seq, count = gaps[fit].pop()
                k = min(n, count)
                rows.append((length, stock.take(length, k), k, seq, window - fit))
                if k < count:
                    gaps[fit].append((seq + k, count - k))
                if not gaps[fit]:
                    del gaps[fit], sizes[i]
                if fit > length:
                    leave(fit - length, seq, k)
            else:
                m = window // length
                place([length] * min(m, n), max(1, n // m))
    return np.array(rows, np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, window: int = WINDOW, classes: int = 64, depth: int = 3) -> DataFrame:
    """``pieces`` (doc_id, start, length, ...) with sequence_id and offset."""
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    rows = plan(histogram, window, classes, depth)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    key = rows[:, 0] << 44 | rows[:, 1]
    numbered = number_within(pieces.drop("sequence_id", "offset"), "length", ["doc_id", "start"], "__number")
    shared = pieces.sparkSession.sparkContext.broadcast((key, rows[:, 1], rows[:, 3], rows[:, 4]))
    kept = [c for c in numbered.columns if c != "__number"]
    schema = numbered.select(*kept).withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, sequence, offset = shared.value
        for batch in batches:
            number = batch.column("__number").to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False)
            at = np.searchsorted(key, length << 44 | number, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence[at] + number - first[at], pa.int64()),
                 pa.array(offset[at], pa.int64())], names=[*kept, "sequence_id", "offset"])

    return numbered.mapInArrow(worker.task("tokens", look_up), schema)


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID,
                   with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place; ``with_ids`` keeps their ids."""
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    cut(docs, tokenizer, window, end_id).write.parquet(path)
    pieces = spark.read.parquet(path)
    return pack(pieces if with_ids else pieces.drop("ids"), window)


def padding(histogram: dict[int, int], window: int = WINDOW) -> float:
    """Share of the packed sequences that is padding."""
    rows = plan(histogram, window)
    return 1 - sum(k * v for k, v in histogram.items()) / max(1, window * int((rows[:, 3] + rows[:, 2]).max(initial=0)))
