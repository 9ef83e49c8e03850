"""Token ids in Huffman-coded files.

``write_coded`` tokenizes documents once, counts every id over all of them,
builds a canonical Huffman code whose lengths are limited (package-merge), and
writes two Parquet tables below a folder:

* ``codebook`` - (symbol, length), at most one row per vocabulary entry. The
  lengths determine the canonical code.
* ``blocks`` - one row per independent block of whole documents, in ascending
  doc_id order over (part, block): document ids and token counts, the coded
  bits, and the bit offset of every ``every``-th token, so that any stretch can
  be decoded without what precedes it.

``read_coded`` decodes blocks by table, all checkpoints of a block side by
side, and returns the documents with their global start.

Defined results: null text is the empty text, which still has its end id;
repeated doc_ids are separate documents (their order is arbitrary but fixed in
the files), null ids come first; an empty table gives empty files and an empty
result; a code of a single symbol has one bit; a very long text is encoded whole,
in the memory of one task, and its ids are spread over several blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm import tokens
from stratum.session import free, scratch_path

END_ID, LIMIT, BLOCK_TOKENS, EVERY = 1, 16, 1 << 18, 256
IDS_SCHEMA = "doc_id long, ids binary"
BLOCK_SCHEMA = ("part int, block int, part_start long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
                "checkpoints binary, bits binary")
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"


# -- the code ---------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for unused symbols."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    leaf, row = [np.ones(len(order), bool)], weights
    for _ in range(limit - 1):
        even = len(row) & ~1
        both = np.concatenate([weights, row[0:even:2] + row[1:even:2]])
        at = np.argsort(both, kind="stable")
        row = both[at]
        leaf.append(at < len(weights))
    take = 2 * len(order) - 2
    for is_leaf in reversed(leaf):
        leaves = int(is_leaf[:take].sum())
        lengths[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Code words, in the order of (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for n in range(1, int(lengths.max(initial=0)) + 1):
        own = np.flatnonzero(lengths == n)
        code <<= n - before
        codes[own] = np.arange(code, code + len(own), dtype=np.uint64)
        code += len(own)
        before = n
    return codes


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, every: int = EVERY) -> tuple[bytes, bytes]:
    """(bits, checkpoints): code words from the highest bit on; little-endian 64-bit offsets."""
    if not len(ids):
        return b"", b""
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    at = ends - n
    word, over = at >> 6, (at & 63) + n - 64
    code = codes[ids]
    out = np.zeros((int(ends[-1]) >> 6) + 1, np.uint64)
    inside = np.where(over > 0, code >> np.maximum(over, 0).astype(np.uint64), code << np.maximum(-over, 0).astype(np.uint64))
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[first]] = np.bitwise_or.reduceat(inside, first)
    spill = np.flatnonzero(over > 0)
    out[word[spill] + 1] |= code[spill] << (64 - over[spill]).astype(np.uint64)
    return out.astype(">u8").tobytes()[:(int(ends[-1]) + 7) // 8], at[::every].astype("<u8").tobytes()


def decode_table(lengths: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(bits to look at, symbol, length) for every value of that many bits."""
    width = max(1, int(lengths.max(initial=0)))
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = 1 << (width - lengths[order].astype(np.int64))
    symbols, sizes = np.zeros(1 << width, np.uint32), np.ones(1 << width, np.uint8)
    filled = int(spans.sum())
    symbols[:filled], sizes[:filled] = np.repeat(order, spans), np.repeat(lengths[order], spans)
    return width, symbols, sizes


def decode(bits: bytes, checkpoints: bytes, count: int, table: tuple[int, np.ndarray, np.ndarray], every: int = EVERY) -> np.ndarray:
    """``count`` ids; every checkpoint's stretch advances by one id a step."""
    width, symbols, sizes = table
    at = np.frombuffer(checkpoints, "<u8").astype(np.int64)
    raw = np.frombuffer(bits + bytes(every * width // 8 + 8), np.uint8).astype(np.uint32)
    ahead = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    mask = np.uint32((1 << width) - 1)
    out = np.empty((every, len(at)), np.uint32)
    for step in range(min(every, count)):
        key = ahead[at >> 3] >> (32 - width - (at & 7)).astype(np.uint32) & mask
        out[step] = symbols[key]
        at += sizes[key]
    return out.T.reshape(-1)[:count]


# -- the files --------------------------------------------------------------

def token_table(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids) of ``docs`` (doc_id, text); ids in ``tokens.narrow`` of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        kind = tokens.narrow(enc.vocab)
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            for at, texts in tokens.batches(batch.column(1).to_pylist()):
                flat, bounds = enc.encode(texts)
                flat = flat.astype(kind)
                ids = [flat[s:e].tobytes() + end for s, e in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(ids, pa.binary())],
                                                 names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, IDS_SCHEMA)


def _count(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                found = np.bincount(np.frombuffer(b"".join(batch.column("ids").slice(i, 500).to_pylist()), kind))
                if len(found) > len(total):
                    total = np.pad(total, (0, len(found) - len(total)))
                total[:len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["symbol", "n"])

    return run


def write_coded(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, limit: int = LIMIT) -> None:
    """Write ``docs`` (doc_id, text) below ``folder``, which must not exist."""
    spark = docs.sparkSession
    enc = tokens.encoder(tokenizer)
    vocab, kind = max(enc.vocab, end_id + 1), tokens.narrow(enc.vocab)
    path = scratch_path(spark, "token-ids")
    token_table(docs, tokenizer, end_id).write.parquet(path)
    ids = spark.read.parquet(path)

    counts = np.zeros(vocab, np.int64)
    for r in ids.select("ids").mapInArrow(_count(kind), "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        counts[r["symbol"]] = r["n"]
    lengths = code_lengths(counts, max(limit, int(np.count_nonzero(counts) - 1).bit_length()))
    spark.createDataFrame([(int(s), int(lengths[s])) for s in np.flatnonzero(lengths)], "symbol int, length int") \
        .coalesce(1).write.parquet(f"{folder}/codebook")
    shared = spark.sparkContext.broadcast((lengths, canonical(lengths)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, start = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def close() -> pa.RecordBatch:
            stream = np.frombuffer(b"".join(raw for _, raw in held), kind)
            bits, marks = encode(stream, *shared.value)
            width = np.dtype(kind).itemsize
            row = {"part": part, "block": block, "part_start": start, "n_tokens": len(stream),
                   "doc_ids": [d for d, _ in held], "doc_tokens": [len(raw) // width for _, raw in held],
                   "checkpoints": marks, "bits": bits}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("part", pa.int32()), ("block", pa.int32()), ("part_start", pa.int64()), ("n_tokens", pa.int64()),
                ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
                ("checkpoints", pa.binary()), ("bits", pa.binary())]))

        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                held.append((doc_id, raw))
                size += len(raw) // np.dtype(kind).itemsize
                if size >= BLOCK_TOKENS:
                    yield close()
                    block, start, held, size = block + 1, start + size, [], 0
        if held:
            yield close()

    # The scratch table fixes the order of its rows, so the tie-break is the
    # same for a re-run task; it lets one doc_id span several ranges.
    ranged = (ids.withColumn("__tie", F.monotonically_increasing_id())
              .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id", "__tie")
              .sortWithinPartitions("doc_id", "__tie").select("doc_id", "ids"))
    ranged.mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(f"{folder}/blocks")
    free(spark, path)


def read_coded(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) of the files below ``folder``."""
    book = spark.read.parquet(f"{folder}/codebook").collect()  # at most the vocabulary
    lengths = np.zeros(max((r["symbol"] for r in book), default=-1) + 1, np.uint8)
    for r in book:
        lengths[r["symbol"]] = r["length"]
    shared = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{folder}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per written partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(shared.value)
        for batch in batches:
            for r in batch.to_pylist():
                ids = decode(r["bits"], r["checkpoints"], r["n_tokens"], table)
                ends = np.cumsum(r["doc_tokens"])
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(r["before"] + r["part_start"] + ends - r["doc_tokens"], pa.int64()),
                     pa.array(r["doc_tokens"], pa.int64()),
                     pa.array([raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), r["doc_tokens"])], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    return blocks.join(F.broadcast(starts), "part").drop("block").mapInArrow(documents, DOC_SCHEMA)


def coded_documents(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write ``docs`` and read them back (see ``read_coded``)."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "coded-ids")
    write_coded(docs, tokenizer, folder)
    return read_coded(spark, folder)
