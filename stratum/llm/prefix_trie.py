"""Prefix trie of conversations by fixed-length block hashing.

A turn is a digest of role and text; ``BLOCK`` turns make a block, whose digest
is that of its turns. A prefix of whole blocks has an identifier that depends on
its turns alone: blocks are taken ``FAN`` at a time into the digest of a larger
block, those again, and a prefix is named by the larger blocks it holds and the
few blocks after them. So conversations are grouped by (prefix before the block,
block digest) first: one shuffle, whatever their length. Only where siblings
diverge - a prefix that several different blocks follow - the turns inside are
refined into nodes of their own by grouping on in-block prefixes; a block
without siblings has one chain of nodes, which is written out as it is.

Sums over subtrees: inside a block every node adds to its at most ``BLOCK`` - 1
ancestors there; from block to block the sums are carried up by doubling, where
a block adds what it has to the block 1, 2, 4 ... above it, so a trie d blocks
deep takes about log2(d) rounds.

A conversation with a third of all turns is spread over many tasks (turns are
numbered by ranges, blocks are groups of bounded size), and so is a prefix that
a third of all conversations share (counts are aggregated before the shuffle).
The ids of the conversations that end in one node are joined range by range;
only the final SHA-256 of one node's list, which has no parallel form, is a pass
of one task over finished pieces of text. The driver sees counts only.

Defined results: turns are ordered by turn number, null first, then by digest,
so repeated rows stand beside each other and are turns of their own; null role
or text is the empty text; empty texts are turns without words; a text of any
length is hashed and counted in the scan and only its digest moves on; rows with
a null conv_id belong to no conversation and are left out; a table without
conversations gives no node, not even a root; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.numbering import number_within
from stratum.llm.ship import ship
from stratum.session import scratch_path, scratch_scope

BLOCK = 4
FAN = 16
WORD = r"[^\x20\x09-\x0D]+"
HEAD_OF, HEAD_TURNS = 20, 4  # a conversation borrows fewer than 4 turns from the first of its 20
PIECE = 1 << 16  # characters of an id list that are handed on at a time
ROOT = b""


def _hash(data: Column) -> Column:
    return F.unhex(F.sha2(data, 256))


def _glued(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(ROOT), lambda a, x: F.concat(a, x))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, idx, digest, words): turns of each conversation from 0, texts reduced to digest and word count."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turns = (conversations.where(F.col("conv_id").isNotNull())
             .select(F.col("conv_id").cast("long").alias("conv"), "turn", _hash(whole).alias("digest"), words.alias("words")))
    # Numbering reads its rows twice: texts are read once.
    turns = _stored(turns, "trie-digests")
    return _stored(number_within(turns, "conv", ["turn", "digest"], "idx"), "trie-turns").select("conv", "idx", "digest", "words")


def borrowed(conv: Column) -> Column:
    """How many turns a conversation borrows."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEAD_TURNS).cast("int")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos, digest, words, length) of the conversations that start with
    the first turns of another one, and the conversations (conv, length)."""
    heads = (turns.where((F.col("idx") < HEAD_TURNS - 1) & (F.col("conv") % HEAD_OF == 0))
             .groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("idx", "digest", "words"))).alias("head")))
    own = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).withColumn("h", borrowed(F.col("conv")))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.expr("cast(array() as array<struct<idx:bigint,digest:binary,words:bigint>>)"))
    convs = (own.withColumn("base", F.col("conv") - F.col("conv") % HEAD_OF).join(heads, "base", "left")
             .select("conv", "h", "n", head.alias("head")).withColumn("length", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    convs = _stored(convs, "trie-conversations")
    lead = convs.select("conv", "length", F.posexplode("head").alias("pos", "turn")).select(
        "conv", F.col("pos").cast("long").alias("pos"), "turn.digest", "turn.words", "length")
    rest = turns.where(F.col("idx") >= borrowed(F.col("conv"))).join(convs.select("conv", "h", F.size("head").alias("got"), "length"), "conv")
    rest = rest.select("conv", (F.col("idx") - F.col("h") + F.col("got")).alias("pos"), "digest", "words", "length")
    return lead.unionByName(rest), convs.select("conv", "length")


def _prefixes(above: Column, digests: Column) -> Column:
    """Identifier of ``above`` followed by the first 1, 2, ... digests."""
    steps = F.sequence(F.lit(1), F.size(digests))
    return F.transform(steps, lambda i: _hash(F.concat(above, _glued(F.slice(digests, F.lit(1), i)))))


def _above(runs: DataFrame) -> DataFrame:
    """(conv, k, before, after): identifiers of the prefix before and after each
    run (conv, k, digest) of a conversation, ``FAN`` runs at a time."""
    grouped = runs.groupBy("conv", F.expr(f"k div {FAN}").alias("q")).agg(F.sort_array(F.collect_list(F.struct("k", "digest"))).alias("runs"))
    return _named(_stored(grouped.select("conv", "q", F.col("runs.digest").alias("digests")), "trie-runs"))


def _named(grouped: DataFrame) -> DataFrame:
    """(conv, k, before, after) of every run in the groups (conv, q, digests)."""
    larger = grouped.where((F.size("digests") == FAN) | (F.col("q") > 0))
    larger = larger.select("conv", F.col("q").alias("k"), _hash(_glued(F.col("digests"))).alias("digest"))
    if larger.isEmpty():
        named = grouped.select("conv", "q", "digests", F.lit(ROOT).alias("above"), F.lit(None).cast("binary").alias("top"))
    else:
        over = _above(larger).select("conv", F.col("k").alias("q"), "before", "after")
        named = grouped.join(over, ["conv", "q"], "left").select(
            "conv", "q", "digests", F.coalesce("before", F.lit(ROOT)).alias("above"), F.col("after").alias("top"))
    ids = named.select("conv", "q", "above", "top", _prefixes(F.col("above"), F.col("digests")).alias("ids"))
    runs = ids.select("conv", "q", "above", "top", "ids", F.posexplode("ids").alias("i", "id"))
    before = F.when(F.col("i") == 0, F.col("above")).otherwise(F.get("ids", F.col("i") - 1))
    after = F.when(F.col("i") == FAN - 1, F.col("top")).otherwise(F.col("id"))
    return runs.select("conv", (F.col("q") * FAN + F.col("i")).alias("k"), before.alias("before"), after.alias("after"))


def blocks(turns: DataFrame) -> DataFrame:
    """(conv, k, before, after, block, digests, words, last) of every block of the turns
    (conv, pos, digest, words, length); ``before`` and ``after`` name the prefixes at its ends."""
    per = turns.groupBy("conv", F.expr(f"pos div {BLOCK}").alias("k")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("turns"), F.max("length").alias("length"))
    per = _stored(per.select("conv", "k", F.col("turns.digest").alias("digests"), F.col("turns.words").alias("words"),
                             (F.col("k") == F.expr(f"(length - 1) div {BLOCK}")).alias("last"))
                  .withColumn("block", _hash(_glued(F.col("digests")))), "trie-blocks")
    ends = _above(per.select("conv", "k", F.col("block").alias("digest")))
    return per.join(ends, ["conv", "k"])


def _node_ids() -> Column:
    """Identifiers of the nodes of a block: the last turn of a full one ends a prefix of whole blocks."""
    inner = _prefixes(F.col("before"), F.slice("digests", 1, BLOCK - 1))
    return F.when(F.size("digests") == BLOCK, F.concat(inner, F.array("after"))).otherwise(inner)


def nodes(parts: DataFrame) -> tuple[DataFrame, int]:
    """All nodes but the root, and the number of the last block.

    id, parent, base (the prefix before the node's block), j (turns into it), depth,
    n (conversations), rep (the smallest), words, ends (conversations that end here)
    and path (ids of the nodes of the block down to this one).
    """
    groups = parts.groupBy("before", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("rep"), F.sum(F.col("last").cast("long")).alias("ends"),
        F.first("k").alias("k"), F.first("digests").alias("digests"), F.first("words").alias("words"), F.first("after").alias("after"))
    groups = _stored(groups, "trie-groups")
    head = groups.agg(F.max("k").alias("k"), F.count(F.when(F.col("k") == 0, 1)).alias("first")).first()
    # All conversations start at the root, so its blocks are counted, not joined.
    several = groups.where(F.col("k") > 0).groupBy("before").agg(F.count(F.lit(1)).alias("__c")).where(F.col("__c") > 1).select("before", F.lit(True).alias("split"))
    later = groups.where(F.col("k") > 0).join(several, "before", "left").withColumn("split", F.coalesce("split", F.lit(False)))
    marked = groups.where(F.col("k") == 0).withColumn("split", F.lit(head["first"] > 1)).unionByName(later)
    ids = marked.withColumn("ids", _node_ids()).withColumn("node", F.explode(F.sequence(F.lit(1), F.size("ids"))))
    j = F.col("node")
    out = ids.select(
        "split", F.get("ids", j - 1).alias("id"), F.when(j == 1, F.col("before")).otherwise(F.get("ids", j - 2)).alias("parent"),
        F.col("before").alias("base"), j.alias("j"), (F.col("k") * BLOCK + j).alias("depth"), "n", "rep", F.get("words", j - 1).alias("words"),
        F.when(j == F.size("ids"), F.col("ends")).otherwise(F.lit(0)).cast("long").alias("ends"), F.slice("ids", F.lit(1), j).alias("path"))
    # Blocks that diverge share the nodes down to the turn where they do.
    split = out.where("split").groupBy("id").agg(
        *[F.first(c).alias(c) for c in ("parent", "base", "j", "depth")], F.sum("n").alias("n"), F.min("rep").alias("rep"),
        F.first("words").alias("words"), F.sum("ends").alias("ends"), F.first("path").alias("path"))
    both = split.unionByName(out.where(~F.col("split")).drop("split"))
    return _stored(both.select("id", "parent", "base", "j", "depth", "n", "rep", "words", "ends", "path"), "trie-nodes"), head["k"]


def _below(marked: DataFrame, depth: int) -> DataFrame:
    """(id, leaves_below, saved_below) of the prefixes of whole blocks that go on, carried up by doubling.

    ``marked``: nodes with their own leaf and saved; ``depth``: number of the last block.
    """
    own = marked.where(F.col("base") != F.lit(ROOT)).groupBy(F.col("base").alias("id")).agg(F.sum("leaf").alias("l"), F.sum("saved").alias("s"))
    sums = _stored(own, "trie-sums")
    # From each prefix to the one a block (two, four, ... blocks) before it.
    links = marked.where((F.col("j") == BLOCK) & (F.col("base") != F.lit(ROOT))).select("id", F.col("base").alias("up"))
    links = _stored(links.join(sums.select("id"), "id", "left_semi"), "trie-links")
    step = 1
    while step < depth:
        more = links.join(sums, "id").groupBy(F.col("up").alias("id")).agg(F.sum("l").alias("l2"), F.sum("s").alias("s2"))
        added = sums.join(more, "id", "left").select("id", (F.col("l") + F.coalesce("l2", F.lit(0))).alias("l"), (F.col("s") + F.coalesce("s2", F.lit(0))).alias("s"))
        on = links.select(F.col("id").alias("up"), F.col("up").alias("next"))
        sums, links = _stored(added, "trie-sums"), _stored(links.join(on, "up").select("id", F.col("next").alias("up")), "trie-links")
        step *= 2
    return sums.select("id", F.col("l").alias("leaves_below"), F.col("s").alias("saved_below"))


_ENDS = pa.schema([("id", pa.binary()), ("first", pa.int64()), ("ids", pa.large_string())])
_DIGESTS = pa.schema([("id", pa.binary()), ("ends_sha256", pa.string())])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (id, conv) rows to comma-joined pieces of each id's list."""
    out: list[tuple] = []
    node, held, size = None, [], 0
    for batch in batches:
        for at, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (at != node or size >= PIECE):
                out.append((node, held[0], ",".join(map(str, held))))
                held, size = [], 0
            node = at
            held.append(conv)
            size += 20
        if sum(len(p[2]) for p in out) > 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ENDS)], schema=_ENDS)
            out = []
    if held:
        out.append((node, held[0], ",".join(map(str, held))))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ENDS)], schema=_ENDS)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each id's pieces, which arrive sorted."""
    node, state = None, None
    for batch in batches:
        done: list[tuple] = []
        for at, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if at == node:
                state.update(b",")
            else:
                if state:
                    done.append((node, state.hexdigest()))
                node, state = at, hashlib.sha256()
            state.update(piece.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _DIGESTS)], schema=_DIGESTS)
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()], pa.string())], schema=_DIGESTS)


def end_digests(ended: DataFrame) -> DataFrame:
    """(id, ends_sha256) from rows (id, conv): ids of a list in order, spread by range, then one digest a list."""
    n = int(ended.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = ended.repartitionByRange(n, "id", "conv").sortWithinPartitions("id", "conv").mapInArrow(_pieces, "id binary, first long, ids string")
    return pieces.repartition("id").sortWithinPartitions("id", "first").mapInArrow(_digested, "id binary, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie of the turns (conv, pos, digest, words, length) of the
    conversations (conv, length): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    ship(spark)
    parts = _stored(blocks(turns), "trie-parts")
    found, depth = nodes(parts)
    marked = found.withColumn("leaf", (F.col("ends") == F.col("n")).cast("long")).withColumn("saved", (F.col("n") - 1) * F.col("words"))
    total = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("rep"), F.count(F.when(F.col("length") == 0, 1)).alias("ends")).first()
    sums = marked.agg(F.coalesce(F.sum("leaf"), F.lit(0)).alias("l"), F.coalesce(F.sum("saved"), F.lit(0)).alias("s")).first()
    if depth:
        marked = marked.join(_below(marked, depth), "id", "left")
        marked = marked.withColumn("leaf", F.col("leaf") + F.coalesce("leaves_below", F.lit(0))).withColumn("saved", F.col("saved") + F.coalesce("saved_below", F.lit(0)))
    subtree = marked.select(F.explode("path").alias("id"), "leaf", "saved").groupBy("id").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    children = found.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    ended = parts.where("last").select(F.element_at(_node_ids(), -1).alias("id"), "conv").unionByName(
        convs.where(F.col("length") == 0).select(F.lit(ROOT).alias("id"), "conv"))
    ends = end_digests(ended)
    plain = found.select("id", "parent", F.col("depth").cast("long").alias("depth"), "n", "rep")
    reps = plain.select(F.col("id").alias("parent"), F.col("rep").alias("parent_conv_id"))
    top = F.col("parent") == F.lit(ROOT)
    under = plain.where(top).withColumn("parent_conv_id", F.lit(total["rep"]).cast("long")).unionByName(plain.where(~top).join(reps, "parent"), allowMissingColumns=True)
    rows = under.drop("parent").join(subtree, "id")
    if total["n"]:
        leaves = sums["l"] + (total["ends"] == total["n"])
        root = spark.createDataFrame([(bytearray(ROOT), 0, total["n"], total["rep"], None, leaves, sums["s"])],
                                     "id binary, depth long, n long, rep long, parent_conv_id long, n_leaves long, saved_tokens long")
        rows = rows.unionByName(root)
    rows = rows.join(children, "id", "left").join(ends, "id", "left")
    return rows.select(F.col("rep").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
                       F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
                       F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table (conv_id, turn, role, text)."""
    spark = conversations.sparkSession
    path = scratch_path(spark, "trie")
    with scratch_scope(spark):  # what is made on the way goes once the nodes are stored
        trie(*rebuilt(numbered_turns(conversations))).write.parquet(path)
    return spark.read.parquet(path)
