"""Merkle manifest of a table by time-forward processing.

Every row is a leaf: SHA-256 over its columns, each written as ``-`` for null and
otherwise as UTF-8 byte count, ``:`` and value. The leaves of a group stand in
ascending id order; runs of ``arity`` nodes are hashed (digests as hex text)
until one node is left, the group's subroot. The subroots, in bytewise order of
their group (null first), are hashed likewise into the root.

Nodes are labelled (group, level, place), so children come before their parent.
A node's digest is a message to its parent: Spark's external sort brings the
messages of one block of ``arity ** height`` neighbours together in label order,
and inside a block a heap ordered by label delivers each digest to its parent
(time-forward processing). A round lifts every block to its top node; the tops
are the next round's messages, so a table of n leaves takes about
log(n) / log(arity ** height) rounds. The sweep back runs the rounds in reverse:
the suffix of a block's top (all siblings from there to the root) comes as one
more message, and reversed label order hands every child its parent's suffix
with the child's own siblings in front.

No task holds more than one block, and a group that has a third of the rows is
cut into blocks like any other. Only the number of levels left to climb reaches
the driver.

Defined results: a null id is written as ``-``, comes first and is never
tampered with; rows that share an id are ordered by their leaf, equal rows stand
beside each other and are leaves of their own; null and empty texts differ
(``-`` and ``0:``); a text of any length is hashed whole, in the scan, and only
its digest moves on; a table without rows has no rows in the result; further
columns, whatever their names, are neither read nor hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.numbering import number_within
from stratum.llm.ship import ship
from stratum.session import scratch_path

ARITY = 2
HEIGHT = 11  # levels a block spans: 2048 nodes of 64 bytes
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(columns: tuple[Column, ...]) -> Column:
    """SHA-256 of the columns, self-delimiting."""
    written = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*written).cast("binary"), 256)


def lift(digests: list[str], first: bool, arity: int, height: int) -> list[list[str]]:
    """Levels of one block, its nodes first, its top last.

    ``first``: the block starts its group, so one that is not full is all there
    is of the group and is only lifted until one node is left.
    """
    whole = first and len(digests) < arity ** height
    levels = [digests]
    queue: list[tuple[tuple[int, int], int, str]] = []  # (parent's label, child, digest)

    def send(level: int, place: int, value: str) -> None:
        if level < height and not (whole and len(levels[level]) == 1):
            heappush(queue, ((level + 1, place // arity), place, value))

    for place, value in enumerate(digests):
        send(0, place, value)
    while queue:
        label = queue[0][0]
        parts = []
        while queue and queue[0][0] == label:
            parts.append(heappop(queue)[2])
        level, place = label
        if level == len(levels):
            levels.append([""] * -(-len(levels[-1]) // arity))
        levels[level][place] = digest(parts)
        send(level, place, levels[level][place])
    return levels


def suffixes(levels: list[list[str]], top: str, arity: int) -> list[str]:
    """Suffix of each of the block's nodes, by the sweep in reversed label order.

    One step of a suffix is the number of siblings on the left, a comma, the
    siblings' digests and ``/`` (without siblings ``0,/``); the root's is empty.
    """
    queue = [((-(len(levels) - 1), 0), top)]
    below = [""] * len(levels[0])
    while queue:
        (level, place), suffix = heappop(queue)
        level, place = -level, -place
        if level == 0:
            below[place] = suffix
            continue
        run = levels[level - 1][place * arity:(place + 1) * arity]
        for k in range(len(run)):
            step = f"{k},{''.join(run[:k] + run[k + 1:])}/"
            heappush(queue, ((-(level - 1), -(place * arity + k)), step + suffix))
    return below


def fold(node: str, suffix: str) -> tuple[str, str]:
    """(digest at the top, all siblings in order) of a node and its suffix."""
    siblings = []
    for step in suffix.split("/")[:-1]:
        left, run = step.split(",")
        cut = 64 * int(left)
        siblings.append(run)
        node = digest([run[:cut], node, run[cut:]])
    return node, "".join(siblings)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of each block in turn; they arrive sorted by (grp, block)."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["grp"], row["block"]) != key and rows:
                yield key, rows
                rows = []
            key = (row["grp"], row["block"])
            rows.append(row)
    if rows:
        yield key, rows


def _batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == 4096:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_NODE = pa.schema([("grp", pa.string()), ("place", pa.int64()), ("digest", pa.string())])
_SUFFIX = pa.schema([("grp", pa.string()), ("place", pa.int64()), ("suffix", pa.string()), ("subroot", pa.string())])
_PROOF = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string())])
_SUFFIX_DDL = "grp string, place long, suffix string, subroot string"


def _lifted(arity: int, height: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = ({"grp": grp, "place": block, "digest": lift([r["digest"] for r in rows], block == 0, arity, height)[-1][0]}
                for (grp, block), rows in _blocks(batches))
        return _batched(tops, _NODE)
    return run


def _lowered(arity: int, height: int, schema: pa.Schema, make: Callable) -> Callable:
    """What ``make`` says of each node of a block, its suffix and the message from
    above, which sorts before the nodes."""
    def block(rows: list[dict], at: int) -> Iterator[dict]:
        message, nodes = rows[0], rows[1:]
        levels = lift([r["digest"] for r in nodes], at == 0, arity, height)
        for r, suffix in zip(nodes, suffixes(levels, message["suffix"], arity)):
            yield make(r, suffix, message)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched((out for (_, at), rows in _blocks(batches) for out in block(rows, at)), schema)
    return run


def _passed_on(node: dict, suffix: str, message: dict) -> dict:
    return {"grp": node["grp"], "place": node["place"], "suffix": suffix, "subroot": message["subroot"]}


def _proved(node: dict, suffix: str, message: dict) -> dict:
    folded, siblings = fold(node["forged"] or node["digest"], suffix)
    return {"doc_id": node["doc_id"], "leaf": node["digest"], "subroot": message["subroot"],
            "proof_sha256": digest([siblings]), "folded_root": folded}


def _in_blocks(nodes: DataFrame, size: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"place div {size}"))


def _sorted(df: DataFrame) -> DataFrame:
    return df.repartition("grp", "block").sortWithinPartitions("grp", "block", "place")


def _with_messages(nodes: DataFrame, above: DataFrame, size: int) -> DataFrame:
    """Nodes in label order, each block after the message to its top."""
    messages = above.select("grp", F.lit(-1).cast("long").alias("place"), F.col("place").alias("block"), "suffix", "subroot")
    return _sorted(_in_blocks(nodes, size).unionByName(messages, allowMissingColumns=True))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def climb(leaves: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> list[DataFrame]:
    """Stored nodes (grp, place, digest) of every round, one per group in the last one."""
    ship(leaves.sparkSession)
    rounds = [leaves.select("grp", "place", "digest")]
    while (rounds[-1].agg(F.max("place")).first()[0] or 0) > 0:
        todo = _sorted(_in_blocks(rounds[-1], arity ** height))
        rounds.append(_stored(todo.mapInArrow(_lifted(arity, height), "grp string, place long, digest string"), "merkle-up"))
    return rounds


def descend(rounds: list[DataFrame], top: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """Suffixes of the first round's nodes (grp, place, suffix, subroot) from
    ``top``, those of each group's last node (grp, suffix, subroot)."""
    above = top.withColumn("place", F.lit(0).cast("long"))
    for nodes in reversed(rounds[:-1]):
        swept = _with_messages(nodes, above, arity ** height).mapInArrow(_lowered(arity, height, _SUFFIX, _passed_on), _SUFFIX_DDL)
        above = _stored(swept, "merkle-down")
    return above


def manifest(docs: DataFrame, tampered: Column | None = None, arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    ``tampered`` marks rows whose ``n_chars`` is one larger when the proof is
    checked (a null ``n_chars`` stays): their ``folded_root`` misses the root.
    """
    spark = docs.sparkSession
    hit = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    columns = tuple(F.col(c) for c in LEAF_COLUMNS)
    forged = tuple(F.try_add(c, F.lit(1)) if name == "n_chars" else c for name, c in zip(LEAF_COLUMNS, columns))
    leaves = docs.select("doc_id", F.col("lang").alias("grp"), leaf_digest(columns).alias("digest"),
                         F.when(hit & F.col("n_chars").isNotNull(), leaf_digest(forged)).alias("forged"))
    leaves = _stored(number_within(leaves, "grp", ["doc_id", "digest"], "place"), "merkle-leaves")
    rounds = climb(leaves, arity, height)
    # The subroots are the leaves of the upper tree, one for each group.
    subroots = rounds[-1].select(F.lit("").alias("grp"), F.col("grp").alias("sub"), "digest")
    subroots = _stored(number_within(subroots, "grp", ["sub"], "place"), "merkle-subroots")
    upper = climb(subroots, arity, height)
    last = upper[-1].first()  # the root, one row
    top = spark.createDataFrame([("", "", None)], "grp string, suffix string, subroot string")
    ends = descend(upper, top, arity, height).select("place", "suffix")
    above = subroots.join(ends, "place").select(F.col("sub").alias("grp"), "suffix", F.col("digest").alias("subroot"))
    above = descend(rounds[1:] or rounds, _stored(above, "merkle-above"), arity, height)
    proofs = _with_messages(leaves, above, arity ** height).mapInArrow(
        _lowered(arity, height, _PROOF, _proved), "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
    root = F.lit(last["digest"] if last else None).cast("string")
    return proofs.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def document_manifest(docs: DataFrame) -> DataFrame:
    """The manifest with every document tampered with whose id has a CRC-32 that 7 divides."""
    return manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
