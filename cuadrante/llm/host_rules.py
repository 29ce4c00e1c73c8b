"""Quality rules per document and per host, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadrante.llm.common import bounded
from cuadrante.session import pin

WINDOW = 8
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
NOT_SYMBOLS = "[^#*$%&|<>]+"


def _windows(hashes: str) -> Column:
    """The hash of each run of ``WINDOW`` words."""
    return F.expr(
        f"case when size({hashes}) >= {WINDOW} then transform(sequence(0, size({hashes}) - {WINDOW}), i -> xxhash64("
        + ", ".join(f"{hashes}[i + {k}]" for k in range(WINDOW))
        + ")) else array() end"
    )


def rule_features(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the rule figures of each text: ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``.

    Repeated words are found within the row: windows are hashed; a text whose hashes
    are all distinct is done, else the hashes are sorted with their places, so the work
    is n log n in the words for any text.  Null and empty texts have zeros.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANKS))
    names = [f"_keep_{i}" for i in range(len(keep))]
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), text.alias("_text"), trimmed.alias("_trim"))
    rows = rows.select(
        *names,
        F.length(F.regexp_replace("_text", NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.when(F.col("_trim") == "", F.array().cast("array<string>")).otherwise(F.split("_trim", BLANK_RUN)).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("_lines"),
    )
    rows = rows.select(
        *names,
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "_words")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    figures = [*names, "n_symbols", "n_words", "word_chars", "n_dup_lines"]
    rows = rows.select(*figures, _windows("_hashes").alias("_windows"))
    # Places of windows are sorted by hash only where some window occurs twice.
    rows = rows.select(*figures, F.expr("case when size(array_distinct(_windows)) < size(_windows) then array_sort(transform(_windows, (h, i) -> struct(h, i))) end").alias("_sorted"))
    rows = rows.select(
        *figures,
        F.expr("sort_array(filter(transform(_sorted, (e, j) -> case when e.h = get(_sorted, j - 1).h or e.h = get(_sorted, j + 1).h then e.i end), i -> i is not null))").alias("_starts"),
    )
    covered = F.expr(f"aggregate(_starts, struct(0L as n, cast(-{WINDOW} as int) as last), (a, i) -> struct(a.n + least({WINDOW}, i - a.last) as n, i as last)).n")
    return rows.select(
        *(F.col(n).alias(c) for c, n in zip(keep, names)), "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")
    )


def host_rates(flags: DataFrame, host_col: str, failed_col: str) -> DataFrame:
    """Per host: rows, failures and the failure rate shrunk towards the rate of all.

    The beta prior is empirical: its mean is the rate over all rows and its strength
    follows, by the method of moments, from how much the hosts' rates differ beyond
    what chance draws of their sizes would.  Hosts that do not differ share one rate.
    """
    hosts = pin(flags.groupBy(host_col).agg(F.count(F.lit(1)).alias("host_docs"), F.sum(F.col(failed_col).cast("long")).alias("host_failed")))
    n, failed, k, n2 = hosts.agg(F.sum("host_docs"), F.sum("host_failed"), F.count(F.lit(1)), F.sum(F.pow(F.col("host_docs").cast("double"), F.lit(2)))).first()
    if not n:
        return hosts.withColumn("host_rate", F.lit(None).cast("double"))
    mean = failed / n
    spread = hosts.agg(F.sum(F.col("host_docs") * F.pow(F.col("host_failed") / F.col("host_docs") - mean, F.lit(2)))).first()[0]
    chance, room = mean * (1 - mean), n - n2 / n
    excess = (spread - (k - 1) * chance) / room if room > 0 else 0.0
    if excess > 0:
        strength = max(chance / excess - 1, 0.0)
        shrunk = (F.col("host_failed") + strength * mean) / (F.col("host_docs") + strength)
    else:
        shrunk = F.lit(mean)
    return hosts.withColumn("host_rate", shrunk)


def host_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_words: int = 20, max_repeat_pct: int = 30, max_host_rate: float = 0.5
) -> DataFrame:
    """Rule figures per document, ``base_failed``, the host's shrunk rate of failures
    and ``kept``: neither the document's own rules nor its host's verdict reject it.

    A host is rejected when its shrunk rate of failing documents is above
    ``max_host_rate``.  Documents without a host have no host verdict: their
    ``host_rate`` is null and their own rules decide.  Null text counts as empty and
    fails.  Rows are kept as they come, repeated or not.
    """
    figures = rule_features(docs, text_col, (id_col, host_col))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    figures = pin(figures.toDF("_id", "_host", *figures.columns[2:]).withColumn("base_failed", failed))
    hosts = host_rates(figures.filter("_host is not null"), "_host", "base_failed")
    out = figures.join(bounded(hosts), "_host", "left")
    good_host = F.coalesce(F.col("host_rate") <= max_host_rate, F.lit(True))
    return out.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_docs", "host_failed", "host_rate", (~F.col("base_failed") & good_host).alias("kept")
    )
