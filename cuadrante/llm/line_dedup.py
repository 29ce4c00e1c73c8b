"""Boilerplate lines: lines that many sites share are taken out of every text.

The number of distinct sites of a line is estimated from HyperLogLog sketches, which
merge by aggregation, so a line that every document holds costs one sketch per task.
Only lines whose estimate lies near the threshold are counted exactly.

Texts stay where they are: the shared lines (their hashes of 16 bytes each) go to the
tasks, which look up the lines of their own documents.  Should more lines be shared than
may be sent, each document is joined with its own shared lines instead, which moves every
text once; the rows are the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadrante.llm.common import bounded
from cuadrante.session import pin

MIN_SITES = 10
SKETCH_BITS = 12
NEAR = 0.25  # estimates this share around the threshold are counted exactly
BLANKS = " \t\x0b\x0c\r"
SENT_LINES = 2_000_000  # shared lines that may be sent to the tasks, 32 MB


def _line_hash(line: Column) -> Column:
    """The 128 bits of a line without the blanks around it, null if nothing is left."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit("line"), bare).alias("b")))


def shared_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The hashes ``h`` of ``lines`` (h, site) that occur at ``min_sites`` sites or more,
    once each.  Rows without a site count for none."""
    placed = lines.filter("site is not null and h is not null")
    sketches = placed.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("_sketch"))
    spread = pin(sketches.select("h", F.hll_sketch_estimate("_sketch").alias("_sites")).filter(F.col("_sites") >= min_sites * (1 - NEAR)))
    sure = spread.filter(F.col("_sites") > min_sites * (1 + NEAR)).select("h")
    near = pin(spread.filter(F.col("_sites") <= min_sites * (1 + NEAR)).select("h"))
    exact = placed.join(bounded(near), "h", "left_semi").select("h", "site").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("_n"))
    return sure.unionByName(exact.filter(F.col("_n") >= min_sites).select("h"))


def _sent(shared: DataFrame):
    """A function from the halves of a document's line hashes to whether each line is
    among ``shared``, which is sent to the tasks as two sorted columns."""
    halves = shared.select("h.a", "h.b").toArrow()
    first, second = (halves[c].to_numpy().astype(np.int64) for c in ("a", "b"))
    order = np.argsort(first, kind="stable")
    first, second = first[order], second[order]
    alike = int(np.unique(first, return_counts=True)[1].max(initial=0))  # hashes with the same first half
    sent = shared.sparkSession.sparkContext.broadcast((first, second))

    @F.arrow_udf("array<boolean>")
    def among(a: pa.Array, b: pa.Array) -> pa.Array:
        known, other = sent.value
        x, y = (half.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for half in (a, b))
        start = np.searchsorted(known, x)
        found = np.zeros(len(x), dtype=bool)
        for step in range(alike):
            at = np.minimum(start + step, len(known) - 1)
            found |= (known[at] == x) & (other[at] == y)
        sizes = pa.compute.list_value_length(a).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found))

    return among


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES, sent_lines: int = SENT_LINES
) -> DataFrame:
    """``doc_id``, ``text`` without shared lines, ``n_lines`` (lines that are not blank)
    and ``n_removed`` of every row.

    Lines are parted by ``\\n`` and compared without the blanks around them; blank lines
    stay.  Null text counts as empty and becomes empty.  A null site adds nothing to a
    line's spread, but shared lines leave such documents too.  Equal rows get equal
    results, a line that a document repeats leaves it everywhere, and a line is shared
    from ``min_sites`` sites on.  Texts may be of any length; an empty table gives no
    rows; other columns are left out, whatever their names.  ``sent_lines`` shared lines
    are sent to the tasks, more are joined; the rows do not depend on it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.col(site_col).cast("string").alias("site"))
    hashes = F.transform(F.split("_text", "\n"), _line_hash)
    found = base.select("site", F.explode(hashes).alias("h")).filter("h is not null")
    shared = pin(shared_lines(pin(found), min_sites))
    n_shared = shared.limit(sent_lines + 1).count()
    base = base.withColumn("_lines", F.split("_text", "\n"))
    if n_shared <= sent_lines:
        among = _sent(shared)
        base = base.withColumn("_hashes", F.transform("_lines", _line_hash))
        # Blank lines have no hash; zeros stand for it.
        bits = F.transform("_hashes", lambda x: F.coalesce(x, F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))))
        out = base.withColumn("_gone", among(bits["a"], bits["b"]))
    else:
        base = base.withColumn("_row", F.struct(F.xxhash64("_id", "_text").alias("a"), F.xxhash64("_text").alias("b")))
        lines = base.select("_row", F.explode(F.transform("_lines", _line_hash)).alias("h")).filter("h is not null")
        touched = pin(lines.join(shared, "h").groupBy("_row").agg(F.collect_set("h").alias("_shared")))
        out = base.join(touched, "_row", "left")
        out = out.withColumn("_gone", F.transform("_lines", lambda x: F.coalesce(F.array_contains("_shared", _line_hash(x)), F.lit(False))))
    kept = F.filter("_lines", lambda x, i: ~F.get("_gone", i))
    return out.select("_id", "_lines", kept.alias("_kept")).select(
        F.col("_id").alias(id_col),
        F.array_join("_kept", "\n").alias("text"),
        F.size(F.filter("_lines", lambda x: F.btrim(x, F.lit(BLANKS)) != "")).cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_removed"),
    )
