"""Population frames: blocks to dwellings to households to persons, census
enrichment and tiered attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadrante.functions import keys
from cuadrante.operators.apportion import uncount
from cuadrante.operators.relational import cast_columns, fill_defaults

# Width of each geographic key, and the defaults for blocks that
# the census does not report.
KEY_WIDTHS = {"CVE_ENT": 2, "CVE_MUN": 3, "CVE_LOC": 4, "CVE_AGEB": 4, "CVE_MZA": 3}
BLOCK_DEFAULTS = {"VIVTOT": 5, "TVIVPAR": 3, "VIVPAR_HAB": 3, "POBTOT": 11}
CENSUS_DEFAULTS = {"POBTOT": 11, "VIVPAR_HAB": 3}
DEFAULT_HOUSEHOLDS = 3


def pad_keys(df: DataFrame, source: dict[str, str] | None = None) -> DataFrame:
    """The five geographic keys as zero-padded text.  ``source`` maps a key to
    the column it comes from, where the names differ."""
    source = source or {}
    return df.withColumns({k: keys.padded(source.get(k, k), w) for k, w in KEY_WIDTHS.items()})


def enrich_census(blocks: DataFrame, census: DataFrame, counts: Sequence[str],
                  defaults: dict[str, int] | None = None) -> DataFrame:
    """Attach census counts to blocks by the five keys.

    Keys are padded and counts cast on the census side (censored text becomes
    null); blocks that stay without population or inhabited dwellings get the
    defaults.
    """
    ready = cast_columns(pad_keys(census), list(counts), "int").select(*KEY_WIDTHS, *counts)
    joined = blocks.join(ready, on=list(KEY_WIDTHS), how="left")
    return fill_defaults(joined, CENSUS_DEFAULTS if defaults is None else defaults)


def clean_blocks(blocks: DataFrame) -> DataFrame:
    """Defaults for missing block counts; blocks without dwellings are dropped.
    Households count only where somebody lives."""
    filled = fill_defaults(blocks, {k: v for k, v in BLOCK_DEFAULTS.items() if k in blocks.columns})
    homes = F.when(F.col("VIVPAR_HAB") > 0, F.coalesce(F.col("TOTHOG"), F.lit(DEFAULT_HOUSEHOLDS))).otherwise(F.lit(0))
    return filled.withColumn("TOTHOG", homes.cast("int")).filter(F.col("VIVTOT") > 0)


def dwelling_frame(blocks: DataFrame, carry: Sequence[str]) -> DataFrame:
    """One row per dwelling with its households and persons.

    The first VIVPAR_HAB dwellings are inhabited by one household each, the
    first TOTHOG - VIVPAR_HAB get one more, and the block's POBTOT persons are
    shared by households, the remainder going to the first dwellings.  Since a
    dwelling's place in its block is the exploded ordinal, every block total is
    plain arithmetic on the block row: nothing is grouped or shuffled but the
    chunks of very large blocks.
    """
    total, inhabited = F.col("VIVTOT"), F.col("VIVPAR_HAB")
    people = F.col("POBTOT")
    lived = F.greatest(F.least(inhabited, total), F.lit(0))
    second = F.greatest(F.least(F.col("TOTHOG") - inhabited, total), F.lit(0))
    homes = lived + second
    # A dwelling has 0, 1 or 2 households; how many have two follows from the two
    # prefixes 1..lived and 1..second.
    doubles = F.least(lived, second)
    singles = F.greatest(lived, second) - doubles

    def share(households) -> Column:
        return F.floor(people.cast("double") * F.lit(float(households)) / homes).cast("bigint")

    given = F.when(homes > 0, doubles * share(2) + singles * share(1)).otherwise(
        total * F.floor(people / total).cast("bigint")
    )
    based = blocks.withColumns({"_homes": homes, "_given": given.cast("bigint")})
    d = uncount(based, "VIVTOT", "_d", spread=True)
    i = F.col("_d")
    here = F.when(i <= F.col("VIVPAR_HAB"), F.lit(1)).otherwise(F.lit(0)) + F.when(
        i <= F.col("TOTHOG") - F.col("VIVPAR_HAB"), F.lit(1)
    ).otherwise(F.lit(0))
    base = F.floor(
        F.when(F.col("_homes") > 0, people.cast("double") * here / F.col("_homes")).otherwise(people / total)
    ).cast("bigint")
    extra = F.when(i <= people - F.col("_given"), F.lit(1)).otherwise(F.lit(0))
    return d.select(
        *carry,
        keys.padded("_d", 6).alias("ID_DOMICILIO"),
        F.when(i <= F.col("VIVPAR_HAB"), i).otherwise(F.lit(0)).cast("int").alias("ID_VPH"),
        here.cast("int").alias("HOGxVPH"),
        (base + extra).cast("bigint").alias("PERxVIV"),
    )


def household_frame(dwellings: DataFrame, carry: Sequence[str]) -> DataFrame:
    """One row per household of the inhabited dwellings, with its persons: the
    dwelling's persons split evenly, the remainder to the first households."""
    h = uncount(dwellings.filter(F.col("ID_VPH") > 0), "HOGxVPH", "_h")
    base = F.floor(F.col("PERxVIV") / F.col("HOGxVPH")).cast("bigint")
    left = F.col("PERxVIV") - base * F.col("HOGxVPH")
    return h.select(
        *carry,
        "ID_DOMICILIO",
        "ID_VPH",
        keys.padded("_h", 3).alias("ID_HOGAR"),
        (base + F.when(F.col("_h") <= left, F.lit(1)).otherwise(F.lit(0))).alias("PERxHOG"),
    )


def unhoused_frame(dwellings: DataFrame, carry: Sequence[str]) -> DataFrame:
    """One row per person whom ``household_frame`` leaves out: those the block's census
    puts into dwellings that are not inhabited.  With ``person_frame`` they add up to
    the block's persons."""
    p = uncount(dwellings.filter("ID_VPH = 0 OR HOGxVPH = 0"), "PERxVIV", "_p")
    return p.select(*carry, "ID_DOMICILIO", keys.padded("_p", 3).alias("ID_PER"))


def person_frame(households: DataFrame, carry: Sequence[str]) -> DataFrame:
    """One row per person of a household."""
    p = uncount(households, "PERxHOG", "_p")
    return p.select(*carry, "ID_DOMICILIO", "ID_VPH", "ID_HOGAR", keys.padded("_p", 3).alias("ID_PER"))


# --- tiers ------------------------------------------------------------------


def apply_tiers(
    df: DataFrame, rules: DataFrame, tier: str, columns: dict[str, str], draw, default: str = "*",
    matched: str = "tier_matched",
) -> DataFrame:
    """Draw attributes from ranges that depend on a row's tier.

    ``rules`` has the rows (tier, column, low, span); the tier named ``default``
    serves tiers without rules of their own, and ``matched`` tells them apart.
    ``columns`` maps each attribute to its type and ``draw(name)`` gives the
    fraction used for it.  The value is low + fraction x span.
    """
    pivoted = rules.groupBy(F.col("tier").alias("_tier")).agg(
        *[F.max(F.when(F.col("column") == c, F.col("low"))).alias(f"_low_{c}") for c in columns],
        *[F.max(F.when(F.col("column") == c, F.col("span"))).alias(f"_span_{c}") for c in columns],
    )
    fallback = pivoted.filter(F.col("_tier") == default).select(
        F.struct(*[c for c in pivoted.columns if c != "_tier"]).alias("d")
    ).scalar()
    joined = df.join(pivoted, F.col(tier) == F.col("_tier"), "left")
    hit = F.col("_tier").isNotNull() & (F.col("_tier") != F.lit(default))

    def bound(kind: str, c: str) -> Column:
        own = F.col(f"_{kind}_{c}")
        return F.when(hit, own).otherwise(fallback[f"_{kind}_{c}"])

    drawn = {
        c: (bound("low", c) + draw(c) * bound("span", c)).cast(to) for c, to in columns.items()
    }
    out = joined.withColumns(drawn).withColumn(matched, hit)
    return out.select(*df.columns, *columns, matched)


def unmatched_tiers(df: DataFrame, rules: DataFrame, tier: str) -> DataFrame:
    """Tiers in the data that no rule names, with their rows."""
    counts = df.groupBy(F.col(tier).alias("tier")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(rules.select("tier").distinct(), "tier", "left_anti")


# Marital states and their weights.
MARITAL = ["Soltero(a)", "Casado(a)", "Divorciado(a)", "Viudo(a)"]
MARITAL_WEIGHTS = [3, 4, 2, 1]
