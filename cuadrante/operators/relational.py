"""Projection, null handling, joins and aggregates shared by all jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cuadrante.functions import geo, measures


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _condition(cond) -> Column:
    return F.expr(cond) if isinstance(cond, str) else cond


# --- projection and nulls ---------------------------------------------------


def select_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the listed columns, each once, in the order of first mention."""
    return df.select(*dict.fromkeys(cols))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls by a value, or by another Column, per column."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), v if isinstance(v, Column) else F.lit(v))
            for name, v in defaults.items()
        }
    )


def cast_columns(df: DataFrame, cols: Sequence[str], to: str) -> DataFrame:
    """Cast many columns; text that is no such value (a censored ``*``) is null."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in cols})


def quarantine(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split into complete rows and rows with a null in a required column.

    Quarantined rows carry ``missing``, the names of their null columns.
    """
    required = list(dict.fromkeys(required))
    if not required:
        return df, df.filter(F.lit(False)).withColumn("missing", F.array().cast("array<string>"))
    has_null = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in required))
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return df.filter(~has_null), df.filter(has_null).withColumn("missing", names)


def split_on(df: DataFrame, cond) -> tuple[DataFrame, DataFrame]:
    """Rows where the condition holds, and all the others (null counts as no)."""
    hit = F.coalesce(_condition(cond), F.lit(False))
    return df.filter(hit), df.filter(~hit)


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# --- joins ------------------------------------------------------------------


def enrich(df: DataFrame, lookup: DataFrame, keys, cols: Sequence[str]) -> DataFrame:
    """Copy columns of a lookup onto matching rows; other rows get null.

    A lookup with several rows for a key raises, as the result would then
    depend on their order.  No size is assumed: the optimizer broadcasts the
    lookup when it measures it as small and otherwise splits skewed keys.
    """
    keys = _list(keys)
    once = lookup.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in cols]
    )
    once = once.withColumns(
        {
            c: F.when(F.col("_n") > 1, F.raise_error(F.lit("enrich: lookup key is not unique"))).otherwise(F.col(c))
            for c in cols
        }
    ).drop("_n")
    return df.join(once, on=keys, how="left")


def keep_members(df: DataFrame, keys_df: DataFrame, keys, anti: bool = False) -> DataFrame:
    """Rows whose key occurs in ``keys_df`` (or, with ``anti``, does not)."""
    return df.join(keys_df, on=_list(keys), how="left_anti" if anti else "left_semi")


def cross_grid(df: DataFrame, products: Sequence[Mapping[str, object]], n_periods: int,
               period: str = "period") -> DataFrame:
    """Each row once per product and period 1..n.

    Products are a fixed, short list given by the caller and the periods are a
    number, so both are exploded beside the row: no join and no shuffle.
    """
    if n_periods < 1:
        raise ValueError("n_periods must be at least 1")
    literals = F.array(
        *[F.struct(*[F.lit(v).alias(k) for k, v in p.items()]) for p in products]
    )
    return (
        df.withColumn("_product", F.explode(literals))
        .select(*df.columns, "_product.*")
        .withColumn(period, F.explode(F.sequence(F.lit(1), F.lit(n_periods))))
    )


def with_group_totals(df: DataFrame, keys, aggs: Sequence[Column]) -> DataFrame:
    """Group aggregates beside every row.

    Aggregate and join back rather than a window: the aggregate combines before
    the shuffle, and a hot key is then a skewed join side that gets split,
    where a window would take the whole group into one task.
    """
    keys = _list(keys)
    totals = df.groupBy(*keys).agg(*aggs)
    renamed = totals.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys))
    return df.join(renamed, match, "left").drop(*[f"_g_{k}" for k in keys])


# --- aggregates -------------------------------------------------------------


def history_features(
    df: DataFrame,
    keys,
    amount: str,
    event: str | None = None,
    flags: Sequence[str] = (),
    averages: Sequence[str] = (),
    latest: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Mean, sample deviation, count and maximum of an amount per key.

    ``flags`` are carried as maxima, ``averages`` as means, and ``latest`` maps a
    column to the ordering columns whose maximum picks its value.  Missing mean
    and deviation (a single row) become 0.
    """
    keys = _list(keys)
    aggs = [
        F.avg(amount).alias("avg_amount"),
        F.stddev(amount).alias("std_amount"),
        F.count(event or amount).alias("n_events"),
        F.max(amount).alias("max_amount"),
    ]
    aggs += [F.max(c).alias(c) for c in flags]
    aggs += [F.avg(c).alias(f"avg_{c}") for c in averages]
    aggs += [F.max_by(c, F.struct(*o)).alias(c) for c, o in (latest or {}).items()]
    return df.groupBy(*keys).agg(*aggs).fillna(0.0, subset=["avg_amount", "std_amount"])


def latest_value(df: DataFrame, keys, value: str, order: Sequence[str], name: str | None = None) -> DataFrame:
    """Value of the row with the greatest ordering columns per key.  Give enough
    of them to break ties, else one of the tied rows is taken."""
    return df.groupBy(*_list(keys)).agg(F.max_by(value, F.struct(*_list(order))).alias(name or value))


def crosstab_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows per pair of labels, ordered by both."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n")).orderBy(a, b)


def share_of_total(df: DataFrame, col: str, by=None, name: str = "share") -> DataFrame:
    """``col`` over its sum, in the whole table or within groups; null at sum 0."""
    if by is None:
        total = df.agg(F.sum(col).alias("t")).scalar()
        return df.withColumn(name, F.try_divide(F.col(col).cast("double"), total))
    out = with_group_totals(df, by, [F.sum(col).alias("_total")])
    return out.withColumn(name, F.try_divide(F.col(col).cast("double"), F.col("_total"))).drop("_total")


def zscore_columns(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """Add a Z-score per column; ``cols`` maps column to new name."""
    stats = measures.global_stats(df, list(cols))
    return df.withColumns(
        {new: measures.zscore(c, stats[c]["avg"], stats[c]["std"]) for c, new in cols.items()}
    )


def minmax_scale(df: DataFrame, col: str, name: str | None = None, default=None) -> DataFrame:
    """Rescale to 0..1; when all values are equal the result is ``default``."""
    stats = measures.global_stats(df, col)[col]
    scaled = measures.minmax(col, stats["min"], stats["max"])
    if default is not None:
        scaled = F.when(F.col(col).isNotNull(), F.coalesce(scaled, F.lit(default)))
    return df.withColumn(name or f"{col}_scaled", scaled)


def multi_resolution(df: DataFrame, lat: str, lon: str, levels: Sequence[int], sums: Sequence[str]) -> DataFrame:
    """Row counts, sums and means per grid cell at several levels.

    The rows are combined once at the finest level.  Cells nest, so the coarser
    levels are summed from those few cells and not from the rows again.  Rows without a
    place are counted once per level, under a null cell.
    """
    levels = sorted(set(levels), reverse=True)
    finest = levels[0]
    placed = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    fine = (
        df.select(
            F.when(placed, geo.grid_index(lat, 90.0, finest)).alias("_r"),
            F.when(placed, geo.grid_index(lon, 180.0, finest)).alias("_c"),
            *sums,
        )
        .groupBy("_r", "_c")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.sum(c).alias(f"_s_{c}") for c in sums],
            *[F.count(c).alias(f"_k_{c}") for c in sums],
        )
    )
    each = fine.withColumn("level", F.explode(F.array(*[F.lit(v) for v in levels])))
    step = F.pow(F.lit(2.0), F.lit(finest) - F.col("level")).cast("bigint")
    each = each.withColumn(
        "cell",
        F.concat(
            F.col("level").cast("string"),
            F.lit(":"),
            F.floor(F.col("_r") / step).cast("string"),
            F.lit(":"),
            F.floor(F.col("_c") / step).cast("string"),
        ),
    )
    out = each.groupBy("level", "cell").agg(
        F.sum("_n").alias("n"),
        *[F.sum(f"_s_{c}").alias(f"sum_{c}") for c in sums],
        *[F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_k_{c}")).alias(f"avg_{c}") for c in sums],
    )
    return out


def dissolve(df: DataFrame, keys, aggs: Sequence[Column]) -> DataFrame:
    """Merge the pieces that share all key attributes (null keys form a group)."""
    return df.groupBy(*_list(keys)).agg(F.count(F.lit(1)).alias("pieces"), *aggs)


def table_profile(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """One row per column: rows, nulls and distinct values, from a single pass.

    Distinct values are a sketch unless ``exact`` is asked for.
    """
    cols = list(cols or df.columns)
    distinct = F.count_distinct if exact else F.approx_count_distinct
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_n{i}"))
        aggs.append(distinct(F.col(c)).alias(f"_d{i}"))
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col("_rows").alias("rows"),
                F.col(f"_n{i}").alias("nulls"),
                F.col(f"_d{i}").alias("distinct_values"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return df.agg(*aggs).select(F.inline(cells))


def column_sketches(df: DataFrame, cols: Sequence[str], shares: Sequence[float] = (0.25, 0.5, 0.75), top: int = 5,
                    accuracy: int = 10_000, counters: int = 4096) -> DataFrame:
    """One row per column: rows, nulls, distinct values, ``quantiles`` at the given shares
    (of numbers; null for other types) and the ``top`` most frequent values with their
    ``estimate``, from a single pass over ``df``.

    All are sketches that tasks merge: their size does not grow with the table.  A
    quantile's rank is off by at most one in ``accuracy`` of the rows.  Values are counted as
    text by ``counters`` counters (a power of 2); an estimate is never below the true count
    and above it by at most ``3.5 / counters`` of the rows.  Nulls are in no quantile and no
    frequent value.  An empty table has zero rows and no values.
    """
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs.append(F.count_if(F.col(_quote(c)).isNull()).alias(f"_n{i}"))
        aggs.append(F.approx_count_distinct(_quote(c)).alias(f"_d{i}"))
        if c in numeric:
            aggs.append(F.percentile_approx(F.col(_quote(c)).cast("double"), list(shares), accuracy).alias(f"_q{i}"))
        aggs.append(F.expr(f"approx_top_k(cast({_quote(c)} as string), {top + 1}, {counters})").alias(f"_t{i}"))
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col("_rows").alias("rows"),
                F.col(f"_n{i}").alias("nulls"),
                F.col(f"_d{i}").alias("distinct_values"),
                (F.col(f"_q{i}") if c in numeric else F.lit(None).cast("array<double>")).alias("quantiles"),
                F.slice(F.filter(_frequent(f"_t{i}"), lambda x: x["value"].isNotNull()), 1, top).alias("frequent"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return df.agg(*aggs).select(F.inline(cells))


def _frequent(counted: str) -> Column:
    return F.transform(counted, lambda x: F.struct(x["item"].alias("value"), x["count"].alias("estimate")))


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
