"""Reproducible draws: fractions from hashes, and values drawn from a fraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _part(k: Column) -> Column:
    return F.coalesce(F.concat(F.length(k).cast("string"), F.lit(":"), k), F.lit("-"))


def hash_fraction(*cols, salt: str = "", algo: str = "md5", signed: bool = False) -> Column:
    """A fraction in [0, 1) that depends only on the key columns and ``salt``.

    ``md5`` gives 32-bit resolution and can be recomputed in other engines.  Each key
    part is hashed with its length before it, and a null part as a dash, so keys that
    only look alike when joined, or that differ by a null, draw on their own.
    ``murmur3`` is cheaper and has the 1/100 steps of the rules written for it.
    ``signed=True`` keeps the sign of the murmur3 remainder (range -0.99..0.99),
    only to reproduce data that was cut that way.
    """
    keys = [_col(c) for c in cols]
    if algo == "md5":
        text = F.concat_ws("|", *[_part(k.cast("string")) for k in keys], F.lit(salt))
        head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        return head / F.lit(TWO_32)
    if algo != "murmur3":
        raise ValueError(f"unknown hash {algo!r}")
    h = F.hash(*keys, F.lit(salt)) if salt else F.hash(*keys)
    step = h % F.lit(100) if signed else F.pmod(h, F.lit(100))
    return step / F.lit(100.0)


def between(u, low, high) -> Column:
    """Uniform value in [low, high)."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return low + _col(u) * (high - low)


def between_int(u, low: int, high: int) -> Column:
    """Uniform integer in low..high, both ends included."""
    return (F.floor(_col(u) * F.lit(high - low + 1)) + F.lit(low)).cast("int")


def normal(u1, u2, mean=0.0, sigma=1.0) -> Column:
    """Normal value from two independent fractions (Box-Muller)."""
    mean = mean if isinstance(mean, Column) else F.lit(mean)
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - _col(u1)))
    return mean + F.lit(sigma) * radius * F.cos(F.lit(2.0) * F.pi() * _col(u2))


def dagum_quantile(u, scale, p: float, a: float) -> Column:
    """Inverse distribution function of the Dagum law: b (u^(-1/p) - 1)^(-1/a).

    It is 0 at u = 0, where the formula itself would divide by zero.
    """
    u = _col(u)
    scale = scale if isinstance(scale, Column) else F.lit(float(scale))
    inside = F.pow(u, F.lit(-1.0 / p)) - F.lit(1.0)
    return F.when(u <= 0, F.lit(0.0)).otherwise(scale * F.pow(inside, F.lit(-1.0 / a)))


def weighted_pick(u, values: Sequence, weights: Sequence[float]) -> Column:
    """The value whose share of the summed weights holds the fraction ``u``."""
    if len(values) != len(weights) or not values:
        raise ValueError("values and weights must have the same, non-zero length")
    u = _col(u)
    total = float(sum(weights))
    running = 0.0
    ladder = F.when(u.isNull(), F.lit(None))
    for value, weight in zip(values[:-1], weights[:-1]):
        running += weight
        ladder = ladder.when(u < F.lit(running / total), F.lit(value))
    return ladder.otherwise(F.lit(values[-1]))
