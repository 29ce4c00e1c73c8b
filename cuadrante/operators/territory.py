"""Economic indices of spatial cells.

Establishment columns used below: ``cell``, ``code`` (six-digit activity code),
``workers`` and ``wages`` (both nullable), ``lat``, ``lon``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadrante.functions import measures
from cuadrante.functions.keys import prefix_in
from cuadrante.operators.relational import fill_defaults
from cuadrante.session import pin

# Activity-code prefixes and the constants of each index.
CASH_HIGH = ["46", "72", "81"]
CASH_MEDIUM = ["43", "48", "49"]
CASH_LOW = ["31", "32", "33", "51", "52", "55"]
CASH_BASE = {"high": 1.0, "medium": 0.5, "low": 0.1, "other": 0.3}
CASH_DECAY = 0.01
CAPACITY_DECAY = 0.02
INDEX_FLOOR = 0.05
CROWDING_SPAN = 0.5
ANCHOR_SIZE = 100
ANCHOR_RULES = [(["462"], 30), (["611", "622"], 50), (["522"], 20)]
FOAM_SIZE = 5
POLE_SCALE = 0.05


def capacity(workers) -> Column:
    """Friction by size: exp(-0.02 workers), at least 0.05; 1 without workers."""
    w = F.col(workers) if isinstance(workers, str) else workers
    raw = F.when(w.isNull() | (w == 0), F.lit(1.0)).otherwise(F.exp(F.lit(-CAPACITY_DECAY) * w))
    return F.greatest(raw, F.lit(INDEX_FLOOR))


def cash_exposure(code="code", workers="workers") -> Column:
    """Dependence on cash by sector, falling with size; null for null workers."""
    base = (
        F.when(prefix_in(code, 2, CASH_HIGH), F.lit(CASH_BASE["high"]))
        .when(prefix_in(code, 2, CASH_MEDIUM), F.lit(CASH_BASE["medium"]))
        .when(prefix_in(code, 2, CASH_LOW), F.lit(CASH_BASE["low"]))
        .otherwise(F.lit(CASH_BASE["other"]))
    )
    return measures.floor_at(base * F.exp(F.lit(-CASH_DECAY) * F.col(workers)), INDEX_FLOOR)


def anchor(code="code", workers="workers") -> Column:
    """1 for large employers and for mid-sized ones of anchoring sectors."""
    w = F.col(workers)
    rule = F.when(w.isNull() | (w == 0), F.lit(0.0)).when(w >= ANCHOR_SIZE, F.lit(1.0))
    for prefixes, least in ANCHOR_RULES:
        rule = rule.when(prefix_in(code, 3, prefixes) & (w >= least), F.lit(1.0))
    return rule.otherwise(F.lit(0.0))


def foam(code="code", workers="workers") -> Column:
    """1 for establishments without workers and for tiny ones of cash sectors."""
    w = F.col(workers)
    return (
        F.when(w.isNull() | (w == 0), F.lit(1.0))
        .when((w <= FOAM_SIZE) & prefix_in(code, 2, CASH_HIGH), F.lit(1.0))
        .otherwise(F.lit(0.0))
    )


def friction(df: DataFrame, cell: str = "cell", workers: str = "workers", name: str = "friction") -> DataFrame:
    """Friction of each establishment: capacity x crowding of its cell, rescaled
    to 0..1 over the whole table (0 everywhere when all are equal).

    Both whole-table ranges come from the cells: a cell's extremes are its own
    extreme capacities times its one crowding factor.
    """
    cells = df.groupBy(cell).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(capacity(workers)).alias("_low"),
        F.max(capacity(workers)).alias("_high"),
    )
    # Written down once (a row per cell), as three places below read it.
    cells = _crowding(pin(cells))
    low, high = _friction_range(cells)
    factor = cells.select(F.col(cell).alias("_cell"), "_crowd")
    scaled = F.coalesce(measures.minmax(capacity(workers) * F.col("_crowd"), low, high), F.lit(0.0))
    joined = df.join(factor, F.col(cell).eqNullSafe(F.col("_cell")), "left")
    return joined.withColumn(name, scaled).drop("_cell", "_crowd")


def _crowding(cells: DataFrame) -> DataFrame:
    """Crowding factor 1 .. 1.5 from each cell's row count ``_n``."""
    dense = cells.withColumn("_log", measures.log_density("_n"))
    stats = measures.global_stats(dense, "_log")["_log"]
    scale = F.coalesce(measures.minmax("_log", stats["min"], stats["max"]), F.lit(0.0))
    return dense.withColumn("_crowd", F.lit(1.0) + scale * F.lit(CROWDING_SPAN)).drop("_log")


def _friction_range(cells: DataFrame) -> tuple[Column, Column]:
    row = cells.agg(
        F.struct(
            F.min(F.col("_low") * F.col("_crowd")).alias("low"),
            F.max(F.col("_high") * F.col("_crowd")).alias("high"),
        ).alias("r")
    ).scalar()
    return row["low"], row["high"]


def entropy_by(df: DataFrame, cell: str, category, weight: str, name: str = "entropy") -> DataFrame:
    """Shannon entropy (natural log) of the categories' weight shares per cell.

    Only positive weights count.  -sum(p ln p) = ln W - sum(w ln w) / W, so the
    shares need no join or window: weights are combined by cell and category,
    and those few rows once more by cell.
    """
    by_category = (
        df.filter(F.col(weight) > 0)
        .groupBy(F.col(cell).alias(cell), category.alias("_category"))
        .agg(F.sum(weight).cast("double").alias("_w"))
    )
    return by_category.groupBy(cell).agg(_entropy("_w").alias(name))


def _entropy(w: str) -> Column:
    total = F.sum(w)
    raw = F.ln(total) - F.sum(F.col(w) * F.ln(w)) / total
    return F.greatest(raw, F.lit(0.0))


def mixed_use(df: DataFrame, cell: str, sector, friction_col: str, name: str = "mixed_use") -> DataFrame:
    """(1 - sum of squared sector shares) x mean over sectors of their friction."""
    by_sector = df.groupBy(F.col(cell).alias(cell), sector.alias("_sector")).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(friction_col).alias("_f")
    )
    n = F.col("_n").cast("double")
    spread = F.lit(1.0) - F.sum(n * n) / (F.sum(n) * F.sum(n))
    return by_sector.groupBy(cell).agg((spread * F.avg("_f")).alias(name))


def cell_master(df: DataFrame, cell: str = "cell", active_only: bool = True) -> DataFrame:
    """All indices of a cell from its establishments.

    One map-side combined aggregate by cell and four-digit branch is the only
    pass over the rows.  It is written down, and everything else, friction
    included, is derived from that small table: friction is linear in the capacity once a cell's crowding
    and the global range are known, so its weighted sums follow from the
    capacity's.
    """
    w = F.col("workers")
    known = w.isNotNull()
    cap = capacity("workers")
    branches = df.groupBy(F.col(cell).alias("cell"), F.substring("code", 1, 4).alias("branch")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(w > 0).alias("n_active"),
        F.count_if(known).alias("n_known"),
        F.sum(w).cast("double").alias("w"),
        F.sum("wages").alias("wages"),
        F.sum(cash_exposure() * w).alias("cash_w"),
        F.sum(F.when(known, anchor() * w)).alias("anchor_w"),
        F.sum(F.when(known, foam() * w)).alias("foam_w"),
        F.sum(F.col("lat") * w).alias("lat_w"),
        F.sum(F.col("lon") * w).alias("lon_w"),
        F.sum(cap * w).alias("cap_w"),
        F.sum(cap).alias("cap"),
        F.min(cap).alias("cap_low"),
        F.max(cap).alias("cap_high"),
    )
    branches = pin(branches)

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0.0))

    cells = branches.groupBy("cell").agg(
        F.sum("n").alias("_n"),
        F.sum("n_active").alias("n_active"),
        F.sum("n_known").alias("n_known"),
        total("w").alias("w"),
        total("wages").alias("wages"),
        total("cash_w").alias("cash_w"),
        total("anchor_w").alias("anchor_w"),
        total("foam_w").alias("foam_w"),
        F.sum("lat_w").alias("lat_w"),
        F.sum("lon_w").alias("lon_w"),
        F.sum("cap_w").alias("cap_w"),
        F.min("cap_low").alias("_low"),
        F.max("cap_high").alias("_high"),
        _entropy_of_positive("w").alias("entropy"),
    )
    crowded = _crowding(cells)
    low, high = _friction_range(crowded)
    sectors = branches.groupBy("cell", F.substring("branch", 1, 2).alias("sector")).agg(
        F.sum("n").alias("n"), (F.sum("cap") / F.sum("n")).alias("cap_mean")
    )
    n = F.col("n").cast("double")
    mixed = sectors.groupBy(F.col("cell").alias("_cell")).agg(
        (F.lit(1.0) - F.sum(n * n) / (F.sum(n) * F.sum(n))).alias("_spread"),
        F.avg("cap_mean").alias("_cap_mean"),
    )
    joined = crowded.join(mixed, F.col("cell").eqNullSafe(F.col("_cell")), "left")

    weight = F.col("w") + F.lit(measures.WEIGHT_EPSILON) * F.col("n_known")
    span = high - low

    def rescaled(sum_of_capacity: Column, sum_of_weights: Column) -> Column:
        return F.try_divide(sum_of_capacity * F.col("_crowd") - low * sum_of_weights, span)

    ratio = F.when(F.col("foam_w") == 0, F.col("anchor_w")).otherwise(
        F.try_divide(F.col("anchor_w"), F.col("foam_w"))
    )
    out = joined.select(
        "cell",
        F.col("w").alias("floating_population"),
        F.col("wages").alias("wage_mass"),
        (F.lit(1.0) - F.col("n_active") / F.col("_n")).alias("zombie_rate"),
        F.try_divide("cash_w", weight).alias("cash_vulnerability"),
        F.try_divide("lat_w", weight).alias("lat_pole"),
        F.try_divide("lon_w", weight).alias("lon_pole"),
        (F.log10(F.lit(1.0) + F.col("wages")) * F.lit(POLE_SCALE)).alias("pole_weight"),
        F.try_divide(rescaled(F.col("cap_w"), F.col("w")), weight).alias("pole_friction"),
        F.ln(F.lit(1.0) + ratio).alias("resilience"),
        "entropy",
        (F.col("_spread") * rescaled(F.col("_cap_mean"), F.lit(1.0))).alias("mixed_use"),
    )
    out = fill_defaults(out, {"entropy": 0.0, "mixed_use": 0.0, "pole_friction": 0.0})
    if active_only:
        out = out.filter(
            F.col("cell").isNotNull() & (F.col("entropy") > 0) & (F.col("floating_population") > 0)
        )
    return out


def _entropy_of_positive(w: str) -> Column:
    positive = F.when(F.col(w) > 0, F.col(w))
    total = F.sum(positive)
    raw = F.ln(total) - F.try_divide(F.sum(positive * F.ln(positive)), total)
    # A single branch gives ln W - ln W up to rounding: report it as exactly 0.
    return F.when(F.count(positive) > 1, F.greatest(raw, F.lit(0.0))).when(F.count(positive) == 1, F.lit(0.0))


def territory_index(df: DataFrame, cell: str, income: str, client: str, label: str) -> DataFrame:
    """Mean label, mean income, clients, and income x clients / 1000 per cell."""
    return (
        df.groupBy(cell)
        .agg(
            F.avg(label).alias("avg_label"),
            F.avg(income).alias("cell_income"),
            F.count(client).alias("n_clients"),
        )
        .withColumn("potential", F.col("cell_income") * F.col("n_clients") / F.lit(1000))
    )


def territory_enriched(df: DataFrame, cell: str, income: str, client: str, label: str) -> DataFrame:
    """Every client beside the index of its cell."""
    index = territory_index(df, cell, income, client, label)
    return df.join(index, on=cell, how="left")


def zscore_territory(df: DataFrame, cell: str, a: str, b: str, client: str) -> DataFrame:
    """Mean Z-scores of two amounts per cell and their average.

    The Z-score is linear, so a cell's mean score is the score of its mean, and
    the whole table's mean and deviation follow from the cells' own.  The rows
    are read once; the table of cells is written down and read for the rest.
    """
    per_cell = [F.count(client).alias("n_clients")]
    for c, p in ((a, "a"), (b, "b")):
        per_cell += [F.count(c).alias(f"_n{p}"), F.avg(c).alias(f"_m{p}"), F.var_pop(c).alias(f"_v{p}")]
    cells = pin(df.groupBy(cell).agg(*per_cell))
    means = cells.agg(
        F.struct(*[F.try_divide(F.sum(F.col(f"_m{p}") * F.col(f"_n{p}")), F.sum(f"_n{p}")).alias(p) for p in "ab"]).alias("m")
    ).scalar()
    spread = cells.withColumn("_mean", means)

    def deviation(p: str) -> Column:
        n, off = F.col(f"_n{p}"), F.col(f"_m{p}") - F.col(f"_mean.{p}")
        return F.sqrt(F.try_divide(F.sum(n * (F.col(f"_v{p}") + off * off)), F.sum(n) - F.lit(1)))

    devs = spread.agg(F.struct(*[deviation(p).alias(p) for p in "ab"]).alias("d")).scalar()
    za, zb = (measures.zscore(f"_m{p}", means[p], devs[p]) for p in "ab")
    return cells.select(
        cell,
        za.alias("index_a"),
        zb.alias("index_b"),
        "n_clients",
        ((za + zb) / F.lit(2)).alias("score"),
    )
