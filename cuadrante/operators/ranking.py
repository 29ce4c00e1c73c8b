"""Row numbers, sequence ids and top-k that survive hot groups.

A plain window sends every group to one task.  Here groups above a measured size
are cut into ordered ranges instead: each range is numbered by its own task and a
small table of offsets, no longer than the number of ranges and hot groups, makes
the numbers continue from one range to the next.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuadrante.functions import keys as key_functions
from cuadrante.session import pin

HOT_ROWS = 5_000_000
GROUP_LIMIT = 1000  # Spark limits groups before the shuffle up to this (spark.sql.optimizer.windowGroupLimitThreshold)
BUCKETS = 256  # parts a round of top_k_per_group counts
ROUNDS = 4  # rounds it takes at most; further rows are left to the numbering


def _cols(x) -> list[Column]:
    x = [x] if isinstance(x, (str, Column)) else list(x)
    return [F.col(c) if isinstance(c, str) else c for c in x]


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sort globally into range partitions and write them down with each row's
    position: partition number in the high bits, place in it in the low 33."""
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    return pin(placed)


def sequential_id(df: DataFrame, order_by, start: int = 1, name: str = "id") -> DataFrame:
    """Dense ids start, start+1, ... in the given order, without a global window.

    ``order_by`` should be a total order.  The offsets table has one row per
    range partition, which bounds the broadcast.
    """
    placed = _ranges(df, _cols(order_by))
    part = F.shiftright("_pos", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.lit(start) + F.col("_offset") + inside)
        .drop("_part", "_offset", "_pos")
    )


def row_numbers(df: DataFrame, keys, order_by, name: str = "rn", hot_rows: int = HOT_ROWS) -> DataFrame:
    """1, 2, ... within each key in the given order.

    One aggregate finds the groups above ``hot_rows``.  When there are none, a
    window does the work.  Otherwise the hot groups, and only they, are sorted
    into ranges and numbered range by range; the result is the same.
    """
    keys = _names(keys)
    order = _cols(order_by)
    plain = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_size"))
        .filter(F.col("_size") > F.lit(hot_rows))
        .select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    )
    if hot.isEmpty():
        return df.withColumn(name, plain)

    match = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys))
    cold_rows = df.join(hot, match, "left_anti").withColumn(name, plain)
    placed = _ranges(df.join(hot, match, "left_semi"), [*map(F.col, keys), *order])
    placed = placed.withColumn("_part", F.shiftright("_pos", 33))
    pieces = placed.groupBy(*keys, "_part").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        *[F.col(k).alias(f"_h_{k}") for k in keys],
        F.col("_part").alias("_h_part"),
        "_first",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
    )
    # One piece per hot key and range it touches; Spark broadcasts them while small.
    hot_rows_df = (
        placed.join(pieces, match & (F.col("_part") == F.col("_h_part")))
        .withColumn(name, F.col("_pos") - F.col("_first") + F.lit(1) + F.col("_before"))
        .select(*df.columns, name)
    )
    return cold_rows.unionByName(hot_rows_df)


def padded_ordinal(df: DataFrame, keys, order_by, width: int, name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Row number within a group as zero-padded text."""
    out = row_numbers(df, keys, order_by, "_ordinal", hot_rows)
    return out.withColumn(name, key_functions.padded("_ordinal", width)).drop("_ordinal")


def daily_account_key(df: DataFrame, ts: str, order_by, width: int = 7,
                      name: str = "account_key", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Account number ``1yyyyMMdd`` + the row's number within its day.

    The number has ``width`` digits, or as many as the fullest day needs: all keys of
    one call have the same length, so they stay unique and sort by day.  Only a day of
    10**10 rows or more does not fit into the bigint and raises an error.
    """
    dated = df.withColumn("_day", F.to_date(F.col(ts)))
    out = row_numbers(dated, "_day", order_by, "_seq", hot_rows)
    most = dated.groupBy("_day").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    width = max(width, len(str(most)))
    if width > 10:
        raise ValueError(f"daily_account_key: {most} rows in a day do not fit into a bigint key")
    key = F.concat(
        F.lit("1"), F.date_format("_day", "yyyyMMdd"), F.lpad(F.col("_seq").cast("string"), width, "0")
    ).cast("bigint")
    return out.withColumn(name, key).drop("_day", "_seq")


def _span(values: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """For each key of ``values`` (keys, _v) with more than ``k`` values: ``_hi``, such that at
    least ``k`` values are at most ``_hi``, and as few others as the rounds could tell.

    A round cuts what may hold the k-th value into ``BUCKETS`` equal parts, counts them in
    one aggregation (a row per key and part from each task), and goes on with the part
    that holds the k-th.  It ends when that part holds few values or a single one.
    """
    big = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    ).filter(F.col("_n") > k)
    state = pin(big.select(*keys, "_lo", "_hi", F.lit(k).cast("bigint").alias("_need"), "_n"))
    for _ in range(ROUNDS):
        open_keys = (F.col("_n") > F.lit(k)) & (F.col("_lo") < F.col("_hi"))
        if state.filter(open_keys).isEmpty():
            break
        match = _same_keys(keys)
        renamed = state.filter(open_keys).select(*[F.col(c).alias(f"_h_{c}") for c in keys], "_lo", "_hi", "_need")
        inside = values.join(renamed, match & F.col("_v").between(F.col("_lo"), F.col("_hi")))
        part = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * BUCKETS), F.lit(BUCKETS - 1))
        parts = inside.groupBy(*keys, F.coalesce(part, F.lit(0)).alias("_part")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.max("_need").alias("_need")
        )
        before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        cut = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).filter(
            (F.col("_before") < F.col("_need")) & (F.col("_before") + F.col("_n") >= F.col("_need"))
        )
        cut = cut.select(*keys, "_lo", "_hi", (F.col("_need") - F.col("_before")).alias("_need"), "_n")
        state = pin(cut.unionByName(state.filter(~open_keys)))
    return state.select(*keys, "_hi")


def _same_keys(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in keys))


def top_k_per_group(df: DataFrame, keys, order_by, k: int, name: str = "rn", lead: Column | None = None,
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """The first k rows of each key, numbered.

    Up to ``GROUP_LIMIT`` the filter on the row number is pushed below the shuffle (a
    group limit per map task), so a hot key sends at most k rows per task.  Spark does
    not do so for a larger ``k``; then rows beyond a key's threshold go first.  ``lead``
    is a number that never falls along ``order_by`` (such as ``-F.col("amount")`` for a
    falling amount): its k-th value of each key is narrowed down by counts, and only rows
    up to there are numbered, hot keys range by range.  Rows whose ``lead`` is null or NaN
    all stay to be numbered, as do ties; without ``lead`` all rows do.  The result is the same.
    """
    if k <= GROUP_LIMIT:
        w = Window.partitionBy(*_names(keys)).orderBy(*_cols(order_by))
        return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
    keys = _names(keys)
    if lead is not None:
        value = lead.cast("double")
        df = pin(df.withColumn("_v", F.when(~F.isnan(value), value)))
        ends = _span(df.filter("_v is not null").select(*keys, "_v"), keys, k)
        ends = ends.select(*[F.col(c).alias(f"_h_{c}") for c in keys], F.col("_hi").alias("_h_end"))
        df = df.join(ends, _same_keys(keys), "left")
        df = df.filter(F.col("_h_end").isNull() | F.col("_v").isNull() | (F.col("_v") <= F.col("_h_end")))
        df = pin(df.drop("_v", "_h_end", *[f"_h_{c}" for c in keys]))
    return row_numbers(df, keys, order_by, name, hot_rows).filter(F.col(name) <= k).withColumn(name, F.col(name).cast("int"))
