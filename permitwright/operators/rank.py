"""Order-dependent operators that never gather a group, or the whole table, in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from permitwright.session import shared_dir

# Sort keys: a column name or an expression, and whether it ascends.
Order = list[tuple[str | Column, bool]]


def with_sort_columns(df: DataFrame, order: Order) -> tuple[DataFrame, list[Column]]:
    """Add a column per expression in the order. Spark would evaluate an expression anew in every comparison."""
    sort = []
    for place, (key, ascending) in enumerate(order):
        name = key
        if isinstance(key, Column):
            name = f"_sort{place}"
            df = df.withColumn(name, key)
        sort.append(F.col(name).asc() if ascending else F.col(name).desc())
    return df, sort


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One whole row per key, the first in `order`; remaining ties break on the row's own values.

    A min over structs, so each task sends on at most one row per key however often the key occurs.
    """
    rest = [name for name in df.columns if name not in keys]
    ranked = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(name) for name in rest])
    first = df.groupBy(*keys).agg(F.min(ranked).alias("_first"))
    return first.select(*[F.col(f"_first.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def key_set(df: DataFrame, keys: list[str], shares: int = 16) -> DataFrame:
    """Keys for the far side of a semi or anti join, at most `shares` rows per key.

    Repeats are dropped before anything is shuffled, so a key with very many rows costs nothing. The last step of
    that is left out on purpose: an aggregate directly below a join keeps Spark from splitting a hot key on the
    near side, as it splits only joins of two shuffles.
    """
    share = F.spark_partition_id() % shares
    return df.select(*keys, share.alias("_share")).distinct().select(*keys)


def join_side(df: DataFrame, keys: list[str]) -> DataFrame:
    """An aggregate made ready to be joined with a side that may have hot keys.

    Rewriting the text keys gives up the aggregate's partitioning. The join then shuffles this side itself, which
    lets Spark split a hot key on the other side.
    """
    return df.withColumns({key: F.concat(F.col(key), F.lit("")) for key in keys})


def _laid_out(df: DataFrame, order: Order, keys: list[str], copies: bool) -> DataFrame:
    """The rows in `order` within the keys, over range partitions, with their partition and a place that ascends in it.

    The rows are range-partitioned on the full order, so a hot leading value or a hot group spreads over many tasks. The
    checkpoint pins partition and place, so that all uses agree and a lost executor cannot change them.
    """
    shared_dir(df.sparkSession)
    rows, sort = with_sort_columns(df, order)
    sort = [F.col(k).asc() for k in keys] + sort
    spread = sort
    if copies:
        rows = rows.sortWithinPartitions(*sort).withColumn("_copy", F.monotonically_increasing_id())
        spread = [*sort, F.col("_copy").asc()]
    return (
        rows.repartitionByRange(*spread)
        .sortWithinPartitions(*sort)
        .select(*df.columns, F.monotonically_increasing_id().alias("_place"))
        # The upper bits of the place are the partition's number.
        .withColumn("_part", F.shiftright("_place", 33))
        .checkpoint(eager=True)
    )


def _pieces(laid_out: DataFrame, keys: list[str]) -> DataFrame:
    return laid_out.groupBy("_part", *keys).agg(F.min("_place").alias("_start"), F.count("*").alias("_rows"))


def numbered(
    df: DataFrame, order: Order, name: str, within: list[str] | None = None, copies: bool = True
) -> DataFrame:
    """Add the exact 1-based row number in `order`, over the table or within the `within` columns.

    A row's number is its place inside its partition plus the rows before it in earlier partitions; the latter comes
    from one count per partition (and group). The call runs the sort; what it returns is lazy.

    The order must be total but for equal rows. These are told apart by a running number, so that very many copies
    of one row spread as well; `copies=False` saves that where rows are known to differ. The local sort before it
    makes the number the same when a task runs again.
    """
    keys = list(within or [])
    laid_out = _laid_out(df, order, keys, copies)
    # One row per partition and group: a group has at most as many pieces as there are partitions.
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _pieces(laid_out, keys).select(
        "_part", *keys, "_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    # Without groups there is one offset per partition, a size known to be small. With groups the join shuffles the
    # rows once more, by pieces that are never larger than a partition was.
    side = offsets if keys else F.broadcast(offsets)
    return laid_out.join(side, ["_part", *keys]).select(
        *df.columns, (F.col("_place") - F.col("_start") + F.col("_before") + 1).alias(name)
    )


def page_slice(
    df: DataFrame, order: Order, start: int, size: int, name: str, copies: bool = True, total: str | None = None
) -> DataFrame:
    """Rows `start` to `start + size` in `order` with their 1-based position and, in `total`, the number of all rows.

    One way for every depth: the rows are laid out over range partitions, and the number of rows of each partition
    tells which of them hold the page. Only the page's rows leave their partitions.
    """
    laid_out = _laid_out(df, order, [], copies)
    position, wanted, before = F.lit(0), F.lit(False), 0
    for piece in _pieces(laid_out, []).orderBy("_part").collect():  # one row per partition
        first, last = max(start, before), min(start + size, before + piece["_rows"])
        if first < last:
            low = piece["_start"] + first - before
            here = F.col("_place").between(low, low + last - first - 1)
            position = F.when(here, F.col("_place") - (piece["_start"] - before - 1)).otherwise(position)
            wanted = wanted | here
        before += piece["_rows"]
    found = laid_out.filter(wanted).select(*df.columns, position.cast("bigint").alias(name))
    return found.withColumn(total, F.lit(before).cast("bigint")) if total else found
