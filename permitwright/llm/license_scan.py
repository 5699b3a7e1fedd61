"""License scans by diagonal voting over joined word pairs, in DataFrame functions throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases whose every exact place counts, with the label each gives (fixed values).
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Longer wordings, which may deviate a little.
WORDINGS = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
)

# A wording counts if so much of its word pairs is there on neighbouring diagonals, within so many words more.
SIMILARITY = 0.75
SLACK = 1


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _templates(df: DataFrame, base: tuple, wordings: tuple) -> DataFrame:
    """One row per word pair of every phrase: template, label, whether base, pairs, place in the phrase, words, hash."""
    rows = [
        (number, label, number < len(base), len(words) - 1, place, words[place], words[place + 1])
        for number, (words, label) in enumerate((p.split(), name) for p, name in (*base, *wordings))
        for place in range(len(words) - 1)
    ]
    made = df.sparkSession.createDataFrame(
        rows, "template int, label string, base boolean, pairs int, tplace int, t1 string, t2 string")
    return made.withColumn("hash", F.xxhash64("t1", "t2"))


def scan_licenses(df: DataFrame, base: tuple = BASE, wordings: tuple = WORDINGS, similarity: float = SIMILARITY,
                  slack: int = SLACK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_doc, _text, template, label, base, diagonal, first, last, similarity): the verified spans.

    All pairs of neighbouring words are joined by their hash to the places of the phrases' pairs, and the words
    themselves are compared. A pair votes for its diagonal: its place in the text less its place in the phrase. A diagonal
    with all votes of a base phrase is an exact place. For the wordings, diagonals at most `slack` apart are merged, so that
    a word more or less does no harm, and a span counts if the pairs found make `similarity` of the phrase's and it is
    at most `slack` words longer. `first` and `last` are the span's outer words, from 0.

    `_doc` is the id and `_text` a hash of the text: rows that repeat both count once. A diagonal has no more votes than
    the phrase has pairs, and only votes are shuffled, which a document shares with no other. The phrases are the only
    side that is broadcast: a fixed list.
    """
    words = F.regexp_extract_all(lowered(F.col(text_col)), F.lit(WORD), 0)
    rows = df.select(F.col(id_col).alias("_doc"), F.xxhash64(F.col(text_col)).alias("_text"), words.alias("w"))
    pairs = F.arrays_zip(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))).alias("w1"),
                         F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))).alias("w2"))
    grams = rows.select("_doc", "_text", F.posexplode(pairs).alias("place", "pair"))
    grams = grams.select("_doc", "_text", "place", F.col("pair.w1").alias("w1"), F.col("pair.w2").alias("w2"))
    phrases = F.broadcast(_templates(df, base, wordings))
    hits = grams.join(phrases, F.xxhash64("w1", "w2") == F.col("hash")).where("w1 = t1 and w2 = t2")
    hits = hits.withColumn("diagonal", (F.col("place") - F.col("tplace")).cast("long"))
    key = ["_doc", "_text", "template", "label", "base", "pairs"]
    votes = hits.groupBy(*key, "diagonal").agg(
        F.collect_set("tplace").alias("found"), F.min("place").cast("long").alias("first"),
        (F.max("place") + 1).cast("long").alias("last"))
    exact = votes.where("base and size(found) = pairs")
    along = Window.partitionBy("_doc", "_text", "template").orderBy("diagonal")
    opens = (F.col("diagonal") - F.lag("diagonal").over(along) <= slack).cast("int")
    group = votes.where("not base").withColumn("_new", 1 - F.coalesce(opens, F.lit(0))).withColumn(
        "_group", F.sum("_new").over(along))
    merged = group.groupBy(*key, "_group").agg(
        F.min("diagonal").alias("diagonal"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("n"))
    merged = merged.withColumn("similarity", F.col("n") / F.col("pairs")).where(
        (F.col("similarity") >= similarity) & (F.col("last") - F.col("first") <= F.col("pairs") + slack))
    columns = ["_doc", "_text", "template", "label", "base", "diagonal", "first", "last", "similarity"]
    return exact.withColumn("similarity", F.lit(1.0)).select(*columns).unionAll(merged.select(*columns))


def license_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row per row of `df`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the exact places of all base phrases, first_word and last_word are the smallest and largest start of
    one (null without any). Labels are distinct, sorted and joined by commas, the empty string if there are none; `labels`
    has those of the wordings too. The score is the best similarity of a span, 0 without spans. A null text counts as
    empty. Null ids are kept, and rows that repeat an id and a text each get the same answer. An empty table gives no
    rows; other columns are not read, so their names cannot clash.
    """
    spans = scan_licenses(df, id_col=id_col, text_col=text_col, **settings)
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = spans.groupBy(F.col("_doc").alias("_d"), F.col("_text").alias("_t")).agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"), F.min(F.when(F.col("base"), F.col("diagonal"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("diagonal"))).alias("last_word"),
        names(F.when(F.col("base"), F.col("label"))).alias("base_labels"), names("label").alias("labels"),
        F.max("similarity").alias("score"))
    words = F.regexp_count(lowered(F.col(text_col)), F.lit(WORD)).cast("long")
    rows = df.select(F.col(id_col).alias("doc_id"), words.alias("n_words"), F.xxhash64(F.col(text_col)).alias("_text"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t")), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
