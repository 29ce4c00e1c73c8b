"""Text keys: padding, prefixes, postal codes, and dates of birth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Postal-code prefix of each federal entity, by entity code.
POSTAL_PREFIX = {
    1: "20", 2: "21", 3: "23", 4: "24", 5: "25", 6: "28", 7: "29", 8: "31",
    9: "0", 10: "34", 11: "36", 12: "39", 13: "42", 14: "44", 15: "50", 16: "58",
    17: "62", 18: "63", 19: "64", 20: "68", 21: "72", 22: "76", 23: "77", 24: "78",
    25: "80", 26: "83", 27: "86", 28: "87", 29: "90", 30: "91", 31: "97", 32: "98",
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def padded(value, width: int) -> Column:
    """Zero-padded text of at least ``width`` characters; longer values are kept
    whole (``lpad`` alone would cut them)."""
    text = _col(value).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def prefix_in(code, length: int, values) -> Column:
    """True when the first ``length`` characters of the code are in ``values``."""
    return F.substring(_col(code), 1, length).isin(list(values))


def file_name(path) -> Column:
    """Last part of a path."""
    return F.regexp_extract(_col(path), r"([^/]+)$", 1)


def prefixed_code(entity, u, width: int = 5) -> Column:
    """Postal-like code: the entity's prefix (``0`` when unknown), then digits
    taken from the fraction ``u`` up to ``width``."""
    table = F.create_map(*[F.lit(x) for pair in POSTAL_PREFIX.items() for x in pair])
    prefix = F.coalesce(F.try_element_at(table, _col(entity).cast("int")), F.lit("0"))
    missing = F.lit(width) - F.length(prefix)
    digits = F.floor(_col(u) * F.pow(F.lit(10.0), missing)).cast("bigint").cast("string")
    return F.concat(prefix, F.lpad(digits, missing, "0"))


def birth_date(age, reference, u) -> Column:
    """A birthday that makes the person ``age`` years old on the reference date."""
    back = F.add_months(_col(reference), F.lit(-12) * _col(age).cast("int"))
    return F.date_sub(back, F.floor(_col(u) * F.lit(365)).cast("int"))
