"""Whole-number quotas and row repetition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuadrante.operators.ranking import HOT_ROWS, row_numbers
from cuadrante.operators.relational import with_group_totals

CHUNK = 100_000


def apportion_truncate(df: DataFrame, total, weight: str, name: str = "quota") -> DataFrame:
    """int(total x share of the whole weight) per row; zero quotas are dropped
    and the remainder is lost, so the quotas add up to at most ``total``."""
    total = total if isinstance(total, Column) else F.lit(total)
    whole = df.agg(F.sum(weight).alias("w")).scalar()
    share = F.try_divide(F.col(weight).cast("double"), whole)
    return df.withColumn(name, F.floor(total * share).cast("bigint")).filter(F.col(name) > 0)


def apportion_remainder(
    df: DataFrame, total: str, weight: str, by, order_by, name: str = "quota", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Share each group's whole ``total`` among its rows exactly.

    Every row gets floor(total x weight / sum of weights) and the first rows in
    order get one more until nothing is left.  Groups whose weights are all zero
    are split evenly.  The quotas of a group always add up to its total.
    """
    by = [by] if isinstance(by, str) else list(by)
    hot = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > F.lit(hot_rows))
    group, cold = Window.partitionBy(*by), hot.isEmpty()
    if cold:  # numbers and sums of a group in one shuffle
        order = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
        sized = df.withColumns(
            {
                "_rn": F.row_number().over(group.orderBy(*order)).cast("bigint"),
                "_w": F.sum(weight).over(group),
                "_n": F.count(F.lit(1)).over(group),
            }
        )
    else:
        numbered = row_numbers(df, by, order_by, "_rn", hot_rows)
        sized = with_group_totals(
            numbered, by, [F.sum(weight).alias("_w"), F.count(F.lit(1)).alias("_n")]
        )
    t, w = F.col(total).cast("double"), F.coalesce(F.col(weight), F.lit(0))
    base = F.floor(
        F.when(F.col("_w") > 0, t * w / F.col("_w")).otherwise(t / F.col("_n"))
    ).cast("bigint")
    based = sized.withColumn(name, base)
    if cold:
        rest = based.withColumn("_given", F.sum(name).over(group))
    else:
        rest = with_group_totals(based, by, [F.sum(name).alias("_given")])
    extra = F.when(F.col("_rn") <= F.col(total) - F.col("_given"), F.lit(1)).otherwise(F.lit(0))
    return rest.withColumn(name, F.col(name) + extra).drop("_rn", "_w", "_n", "_given")


def uncount(df: DataFrame, n, ordinal: str = "ordinal", chunk: int = CHUNK, spread: bool = False) -> DataFrame:
    """Repeat each row n times with an ordinal 1..n; n of 0 or null drops it.

    Large counts are cut into chunks, so no array exceeds ``chunk`` elements.
    With ``spread`` the chunks (not the repeated rows) are first dealt out over
    the cluster, so one huge count is repeated by many tasks.
    """
    n = F.col(n) if isinstance(n, str) else n
    counted = df.withColumn("_n", n.cast("bigint")).filter(F.col("_n") > 0)
    last = F.floor((F.col("_n") - 1) / F.lit(chunk)).cast("bigint")
    chunks = counted.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    if spread:
        # A stated number, as few rows would be coalesced into one task that then
        # repeats all of them.
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        chunks = chunks.repartition(tasks, F.xxhash64(*[F.col(c) for c in df.columns], F.col("_chunk")))
    low = F.col("_chunk") * F.lit(chunk)
    ordinals = F.sequence(low + 1, F.least(F.col("_n"), low + F.lit(chunk)))
    return chunks.withColumn(ordinal, F.explode(ordinals)).drop("_n", "_chunk")
