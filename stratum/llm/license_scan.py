"""License scan by diagonal voting.

Words are runs of ASCII letters and digits and of any non-ASCII characters, with
A-Z in lower case. Every rolling k-gram of a document's words (k is 2 for
templates of 2 or 3 words, 4 for longer ones) is joined by its hash to the
positions of that k-gram in the license templates; equal words are checked in
the same join. A match votes for its diagonal, document position minus template
position. Votes are aggregated by (document, template, diagonal); diagonals that
differ by at most ``DRIFT`` words from the one before (words put in or left out)
are merged into one span, and a span counts for a template when the words of the
template that its matches hold - found word for word, each counted once - are at
least ``COVERAGE`` of them. Base phrases are templates of exactly k words, so
each of their matches is a place and covers the whole phrase.

Texts are split in the scan and never shuffled: only matches, one row a diagonal
and map task, and one row of counts a document are. Documents are known by
(id, SHA-256 of the text), so ids may repeat. Long texts are cut into overlapping
chunks of ``CHUNK`` words before k-grams are formed; a task holds one text, its
words and one chunk's k-grams.

Defined results: a null text is the empty text; texts without words or matches
have no labels, no positions and score 0; a null id is kept; rows that repeat id
and text get the same result each, rows that repeat only the id are scanned
apart; overlapping places of one phrase all count; a table without rows has none
in the result; further columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.session import scratch_path

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WIDTHS = (2, 4)
DRIFT = 3
COVERAGE = 0.6
CHUNK = 512


@dataclass(frozen=True)
class Template:
    """``words`` as they stand after splitting; ``base`` phrases are exact."""
    label: str
    words: str
    base: bool = False

    def width(self) -> int:
        return WIDTHS[1] if len(self.words.split()) >= WIDTHS[1] else WIDTHS[0]


# The base phrases, then opening sentences of well-known licenses.
TEMPLATES = (
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                    "documentation files the software to deal in the software without restriction"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
                    "following conditions are met"),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                    "license as published by the free software foundation"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("cc-by", "this work is licensed under a creative commons attribution"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Templates of more k-grams than this are joined without a broadcast.
BROADCAST_GRAMS = 100_000


def _gram_hash(gram: Column) -> Column:
    return F.xxhash64(gram)


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(hash, gram, template, at) of every k-gram of the templates."""
    rows = []
    for t, template in enumerate(templates):
        words, k = template.words.split(), template.width()
        if len(words) < WIDTHS[0] or (template.base and len(words) != k):
            raise ValueError(f"a template has at least {WIDTHS[0]} words, a base phrase one of {WIDTHS}: {template.words}")
        rows += [(" ".join(words[i:i + k]), t, i) for i in range(len(words) - k + 1)]
    grams = spark.createDataFrame(rows, "t_gram string, template int, at int").withColumn("hash", _gram_hash(F.col("t_gram")))
    return F.broadcast(grams) if len(rows) <= BROADCAST_GRAMS else grams


def words_of(text: Column) -> Column:
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(folded, SEPARATOR, -1), lambda w: w != "")


def _joined(left: Column, right: Column, shift: int) -> Column:
    """Element i of ``left`` and element i + ``shift`` of ``right``, for all that have both."""
    n = F.greatest(F.size(right) - F.lit(shift), F.lit(0))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(shift + 1), n), lambda a, b: F.concat(a, F.lit(" "), b))


def rolling_grams(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, pos, gram) of every document; one row with pos -1 for each."""
    whole = F.coalesce(F.col(text), F.lit(""))
    key = F.struct(F.col(id_column).alias("id"), F.unhex(F.sha2(whole.cast("binary"), 256)).alias("content")).alias("key")
    split = docs.select(key, words_of(F.col(text)).alias("words"))
    reach = WIDTHS[1] - 1  # words a chunk shares with the next one
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(CHUNK))
    cut = F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice("words", s + 1, CHUNK + reach).alias("words")))
    chunks = split.select("key", F.size("words").cast("long").alias("n_words"), F.explode(cut).alias("chunk"))
    words = F.col("chunk.words")
    chunks = chunks.select("key", "n_words", "chunk.start", _joined(words, words, 1).alias("pairs"))
    # A k-gram belongs to the chunk that its first word is in.
    grams = F.concat(F.slice("pairs", 1, CHUNK), F.slice(_joined(F.col("pairs"), F.col("pairs"), 2), 1, CHUNK))
    n = F.least(F.size("pairs"), F.lit(CHUNK))
    marked = F.concat(F.when(F.col("start") == 0, F.array(F.lit(None).cast("string"))).otherwise(F.expr("cast(array() as array<string>)")), grams)
    lead = F.when(F.col("start") == 0, F.lit(1)).otherwise(F.lit(0))
    flat = chunks.select("key", "n_words", "start", lead.alias("lead"), n.alias("n"), F.posexplode(marked).alias("i", "gram"))
    at = F.col("i") - F.col("lead")
    pos = F.when(F.col("gram").isNull(), F.lit(-1)).otherwise(F.col("start") + F.when(at < F.col("n"), at).otherwise(at - F.col("n")))
    return flat.select("key", "n_words", pos.cast("long").alias("pos"), "gram")


def matches(grams: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(key, n_words, pos, template, at) of the k-grams that a template holds, and every document's row with pos -1."""
    lookup = template_grams(grams.sparkSession, templates)
    found = grams.withColumn("hash", _gram_hash(F.col("gram"))).join(lookup, "hash", "left")
    return (found.where((F.col("gram") == F.col("t_gram")) | (F.col("pos") == -1))
            .select("key", "n_words", "pos", F.when(F.col("pos") >= 0, F.col("template")).alias("template"), F.when(F.col("pos") >= 0, F.col("at")).alias("at")))


def votes(found: DataFrame) -> DataFrame:
    """(key, template, diagonal) with the rows that voted, the template positions
    they hold, and the places of the first and the last. Documents are template null."""
    return found.groupBy("key", "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("n"), F.collect_set("at").alias("ats"), F.min("pos").alias("first"), F.max("pos").alias("last"),
        F.max("n_words").alias("n_words"))


def spans(diagonals: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(key, template, start, end, share): neighbouring diagonals merged, and the
    share of the template's words that their matches hold. Positions in words, end exclusive."""
    long = [t for t, template in enumerate(templates) if not template.base]
    known = diagonals.where(F.col("template").isin(long))
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT, F.lit(True))
    runs = known.withColumn("__far", far.cast("int")).withColumn("run", F.sum("__far").over(order))
    ends = runs.groupBy("key", "template", "run").agg(F.min("first").alias("start"), F.max("last").alias("last"))
    # Words of the template under the matches, each once.
    width = _by_template(templates, lambda t: t.width())
    words = _by_template(templates, lambda t: len(t.words.split()))
    held = (runs.select("key", "template", "run", F.explode("ats").alias("at"))
            .select("key", "template", "run", F.explode(F.sequence(F.col("at"), F.col("at") + width - 1)).alias("word")).distinct()
            .groupBy("key", "template", "run").agg(F.count(F.lit(1)).alias("held")))
    return held.join(ends, ["key", "template", "run"]).select(
        "key", "template", "start", (F.col("last") + width).alias("end"), (F.col("held") / words).alias("share"))


def _by_template(templates: tuple[Template, ...], value) -> Column:
    return F.element_at(F.array(*[F.lit(value(t)) for t in templates]), F.col("template") + 1)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_column: str = "doc_id", text: str = "text",
         coverage: float = COVERAGE) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word,
    base_labels, labels and score, the best share of a template found (1: a whole
    one or a base phrase, 0: nothing)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "license-votes")
    votes(matches(rolling_grams(docs, id_column, text), templates)).write.parquet(path)
    diagonals = spark.read.parquet(path)
    base = [t for t, template in enumerate(templates) if template.base]
    is_base = F.col("template").isin(base)
    label = _by_template(templates, lambda t: t.label)
    best = (spans(diagonals, templates).groupBy("key", "template").agg(F.max("share").alias("share"))
            .select("key", label.alias("label"), "share"))
    plain = diagonals.select(
        "key", F.when(F.col("template").isNull(), F.col("n")).alias("copies"), "n_words",
        F.when(is_base, F.col("n")).alias("hits"), F.when(is_base, F.col("first")).alias("first"), F.when(is_base, F.col("last")).alias("last"),
        F.when(is_base, label).alias("base_label"), F.when(is_base, label).alias("label"), F.when(is_base, F.lit(1.0)).alias("share"))
    found = plain.unionByName(best.select("key", F.when(F.col("share") >= coverage, F.col("label")).alias("label"), "share"), allowMissingColumns=True)
    per = found.groupBy("key").agg(
        F.max("copies").alias("copies"), F.max("n_words").alias("n_words"), F.coalesce(F.sum("hits"), F.lit(0)).alias("hits"),
        F.min("first").alias("first_word"), F.max("last").alias("last_word"), F.collect_set("base_label").alias("base"),
        F.collect_set("label").alias("labels"), F.coalesce(F.max("share"), F.lit(0.0)).alias("score"))
    # Rows that repeat id and text voted together, each as often as any other.
    rows = per.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    listed = lambda c: F.array_join(F.array_sort(c), ",")
    return rows.select(F.col("key.id").alias(id_column), "n_words", F.expr("hits div copies").alias("n_base"), "first_word", "last_word",
                       listed("base").alias("base_labels"), listed("labels").alias("labels"), F.col("score").cast("double").alias("score"))
