"""Line dedup by site-relative frequency, in DataFrame functions throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permitwright.llm.common import saved

# Share of a host's pages beyond which a line is boilerplate, at every host size, and the pages that a repeat needs. The README
# says what spread of shares the ratio rests on.
RATIO = 0.05
REPEATED = 2


def line_key(line: Column) -> Column:
    """Identity of a line without the blanks around it: two hashes and the length, some 140 bits."""
    return F.struct(
        F.xxhash64(line).alias("a"), F.xxhash64(F.concat(F.lit("\n"), line)).alias("b"), F.length(line).alias("n")
    )


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def boilerplate(pages: DataFrame, host_col: str, text_col: str, max_ratio: float = RATIO,
                min_pages: int = REPEATED, once_per_text: bool = False) -> DataFrame:
    """(host, keys): per host the lines that stand on at least `min_pages` and over `max_ratio` of its pages.

    A line counts once per page. A host has fewer such lines than its pages have lines on average, divided by
    `max_ratio`, so the list stays short however large the host is. `once_per_text` counts pages of one host with equal
    texts as one page, so that copies do not make each other's lines boilerplate.
    """
    rows = pages.select(F.col(host_col).alias("host"), _lines(F.col(text_col)).alias("lines"), line_key(F.col(text_col)).alias("same"))
    keys = F.array_distinct(F.transform(F.filter(F.transform("lines", lambda s: F.trim(s)), lambda s: s != ""), line_key))
    placed = rows.select("host", "same", F.explode(keys).alias("key"))
    if once_per_text:
        # Equal texts are told by their hashes: no text is shuffled.
        totals = rows.select("host", "same").distinct().groupBy("host").agg(F.count("*").alias("pages"))
        placed = placed.select("host", "key", F.col("same.a").alias("same")).distinct()
    else:
        totals = rows.groupBy("host").agg(F.count("*").alias("pages"))
    counts = placed.groupBy("host", "key").agg(F.count("*").alias("n"))
    counts = counts.where(F.col("n") >= min_pages)
    frequent = counts.join(totals, counts["host"].eqNullSafe(totals["host"])).where(F.col("n") > max_ratio * F.col("pages"))
    return frequent.select(counts["host"], "key").groupBy("host").agg(F.collect_list("key").alias("keys"))


def drop_boilerplate(pages: DataFrame, host_col: str, text_col: str, max_ratio: float = RATIO,
                     min_pages: int = REPEATED, max_share: float = 1.0, once_per_text: bool = False) -> DataFrame:
    """All rows and columns of `pages`, with boilerplate lines taken out of the text, plus _lines and _dropped counts.

    A line is what stands between line feeds; blanks around it do not matter and blank lines always stay. `max_share`
    below 1 leaves pages alone of whose characters boilerplate makes more than that share. `once_per_text` counts equal
    texts of a host once; lines are dropped from all of them alike. Null hosts form a host of their own, null texts stay null and
    count as pages without lines, repeated rows count as pages of their own, and a page of one very long line has one
    line. An empty table gives no rows. Columns named _lines, _dropped,
    _keys, _host, _left or _text are replaced.

    The list of lines per host is written down first, so that Spark knows its size and joins it to the texts without
    a shuffle where it is small; a large list is joined by host, and a hot host is split.
    """
    listed = saved(boilerplate(pages, host_col, text_col, max_ratio, min_pages, once_per_text), "boilerplate")
    listed = listed.select(F.col("host").alias("_host"), F.col("keys").alias("_keys"))
    joined = pages.drop("_lines", "_dropped", "_keys", "_host", "_text", "_left").join(listed, F.col(host_col).eqNullSafe(F.col("_host")), "left")
    lines = _lines(F.col(text_col))
    left = F.filter(lines, lambda s: ~F.array_contains(F.col("_keys"), line_key(F.trim(s))) | (F.trim(s) == ""))
    kept = F.when(F.col("_keys").isNull(), lines).otherwise(left)
    done = joined.withColumn("_left", kept).withColumn("_text", F.array_join("_left", "\n"))
    size = F.length(F.col(text_col))
    whole = F.col("_keys").isNull() | F.col(text_col).isNull() | (size - F.length("_text") > max_share * size)
    count = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long")
    gone = F.when(whole, 0).otherwise(F.size(lines) - F.size("_left")).cast("long")
    text = F.when(whole, F.col(text_col)).otherwise(F.col("_text"))
    names = [c for c in pages.columns if c not in ("_lines", "_dropped", "_keys", "_host", "_text", "_left")]
    return done.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in names], count.alias("_lines"), gone.alias("_dropped")
    )
