"""Queries over single tables: projections, filters, joins, aggregates, windows
and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuadrante.functions import draws, finance, geo, keys, measures
from cuadrante.operators import apportion, ranking, relational
from cuadrante.plans.registry import query, r, rounded
from cuadrante.plans.tables import SQL, blocks, clients, history, payments, poles, table, with_

# --- scans ------------------------------------------------------------------


@query(
    "scan_parquet",
    "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 5",
)
def scan_parquet(spark, d):
    li = table(spark, d, "lineitem")
    return li.filter(F.col("l_quantity") < 5).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")


@query(
    "range_grid",
    with_("clients")
    + """ SELECT client, product, p.period::INT AS period
    FROM clients, (VALUES ('Nomina'), ('Personal'), ('TDC_1'), ('TDC_2')) AS c(product),
    (SELECT unnest(range(1, 49)) AS period) p""",
)
def range_grid(spark, d):
    products = [{"product": p} for p in ("Nomina", "Personal", "TDC_1", "TDC_2")]
    return relational.cross_grid(clients(spark, d).select("client"), products, 48)


# --- projection and nulls ---------------------------------------------------


@query(
    "project_rename",
    "SELECT o_orderkey AS event, o_custkey AS client, o_totalprice * 2 AS doubled FROM orders",
)
def project_rename(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_orderkey", "event")
    return o.selectExpr("event", "o_custkey AS client", "o_totalprice * 2 AS doubled")


@query(
    "with_columns_lateral",
    with_("clients")
    + """ SELECT client, round(income * 12, 4) AS yearly, round(income * 12 * 0.3, 4) AS reserve FROM clients""",
)
def with_columns_lateral(spark, d):
    c = clients(spark, d).withColumns({"yearly": F.col("income") * 12, "reserve": F.col("yearly") * 0.3})
    return rounded(c.select("client", "yearly", "reserve"), 4, "yearly", "reserve")


@query(
    "filter_predicates",
    """SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderstatus IN ('F', 'P') AND NOT (o_totalprice > 200000) AND o_custkey IS NOT NULL""",
)
def filter_predicates(spark, d):
    o = table(spark, d, "orders")
    return (
        o.filter(F.col("o_orderstatus").isin("F", "P"))
        .filter(~(F.col("o_totalprice") > 200000))
        .filter("o_custkey IS NOT NULL")
        .select("o_orderkey", "o_orderstatus")
    )


@query(
    "case_ladder",
    with_("clients")
    + """ SELECT client, CASE WHEN income >= 9000 THEN 'alto' WHEN income >= 5000 THEN 'medio'
    WHEN income >= 2000 THEN 'bajo' ELSE 'minimo' END AS band FROM clients""",
)
def case_ladder(spark, d):
    i = F.col("income")
    band = F.when(i >= 9000, "alto").when(i >= 5000, "medio").when(i >= 2000, "bajo").otherwise("minimo")
    return clients(spark, d).select("client", band.alias("band"))


@query(
    "fill_defaults",
    """SELECT c_custkey, coalesce(CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_acctbal END, 0.0::DOUBLE) AS balance,
    coalesce(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END, 'NONE') AS tier FROM customer""",
)
def fill_defaults(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 19 != 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("tier"),
    )
    return relational.fill_defaults(c, {"balance": 0.0, "tier": "NONE"})


def _nullable_features(spark, d):
    f = relational.history_features(history(spark, d), "client", "amount")
    return f.select(
        "client",
        F.when(F.col("client") % 19 != 0, F.col("avg_amount")).alias("avg_amount"),
        F.when(F.col("client") % 23 != 0, F.col("n_events")).alias("n_events"),
    )


@query(
    "quarantine_split",
    with_("history")
    + """, f AS (SELECT client, CASE WHEN client % 19 = 0 THEN NULL ELSE avg(amount) END AS avg_amount,
      CASE WHEN client % 23 = 0 THEN NULL ELSE count(amount) END AS n_events FROM history GROUP BY client)
    SELECT client, 'complete' AS part, '' AS missing FROM f WHERE avg_amount IS NOT NULL AND n_events IS NOT NULL
    UNION ALL
    SELECT client, 'quarantined', concat_ws(',', CASE WHEN avg_amount IS NULL THEN 'avg_amount' END,
      CASE WHEN n_events IS NULL THEN 'n_events' END) FROM f WHERE avg_amount IS NULL OR n_events IS NULL""",
)
def quarantine_split(spark, d):
    ok, bad = relational.quarantine(_nullable_features(spark, d), ["avg_amount", "n_events"])
    ok = ok.dropna(subset=["avg_amount", "n_events"])
    return ok.select("client", F.lit("complete").alias("part"), F.lit("").alias("missing")).unionByName(
        bad.select("client", F.lit("quarantined").alias("part"), F.concat_ws(",", "missing").alias("missing"))
    )


@query(
    "bulk_try_cast",
    """SELECT l_orderkey, l_linenumber, l_partkey,
    TRY_CAST(CASE WHEN l_partkey % 17 = 0 THEN '*' ELSE l_linenumber::VARCHAR END AS INT) AS a,
    TRY_CAST(CASE WHEN l_partkey % 5 = 0 THEN 'N/D' ELSE l_suppkey::VARCHAR END AS INT) AS b FROM lineitem""",
)
def bulk_try_cast(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_partkey") % 17 == 0, "*").otherwise(F.col("l_linenumber").cast("string")).alias("a"),
        F.when(F.col("l_partkey") % 5 == 0, "N/D").otherwise(F.col("l_suppkey").cast("string")).alias("b"),
    )
    return relational.cast_columns(li, ["a", "b"], "int")


@query("select_unique", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def select_unique(spark, d):
    return relational.select_unique(
        table(spark, d, "customer"), ["c_custkey", "c_nationkey", "c_custkey", "c_acctbal", "c_nationkey"]
    )


@query(
    "split_sentinel",
    """SELECT CASE WHEN l_linenumber = 1 THEN 'totals' ELSE 'detail' END AS part, count(*) AS n,
    round(sum(l_extendedprice), 2) AS amount FROM lineitem GROUP BY 1""",
)
def split_sentinel(spark, d):
    li = table(spark, d, "lineitem").select("l_linenumber", "l_extendedprice")
    totals, detail = relational.split_on(li, "l_linenumber = 1")
    aggs = (F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("amount"))
    return totals.agg(F.lit("totals").alias("part"), *aggs).unionByName(
        detail.agg(F.lit("detail").alias("part"), *aggs)
    )


# --- joins ------------------------------------------------------------------


@query(
    "inner_join_multi",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name, n_name FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
)
def inner_join_multi(spark, d):
    li = table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    joined = li.join(table(spark, d, "supplier"), "s_suppkey").join(
        table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("s_suppkey").alias("l_suppkey"), "s_name", "n_name"
    )


@query(
    "left_join_multi",
    """SELECT c_custkey, n, s_suppkey FROM customer
    LEFT JOIN (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) o
      ON c_custkey = o_custkey AND o_orderstatus = 'P'
    LEFT JOIN supplier ON c_custkey = s_suppkey AND c_nationkey = s_nationkey""",
)
def left_join_multi(spark, d):
    counts = (
        table(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    )
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    joined = c.join(counts, (c.c_custkey == counts.o_custkey) & (counts.o_orderstatus == "P"), "left").join(
        s, (c.c_custkey == s.s_suppkey) & (c.c_nationkey == s.s_nationkey), "left"
    )
    return joined.select("c_custkey", "n", "s_suppkey")


@query(
    "enrich_lookup",
    """SELECT c_custkey, c_nationkey, n_name AS name FROM customer
    LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n ON c_nationkey = n_nationkey""",
)
def enrich_lookup(spark, d):
    lookup = table(spark, d, "nation").filter("n_nationkey < 20").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("name")
    )
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return relational.enrich(c, lookup, "c_nationkey", ["name"])


@query(
    "semi_anti",
    """SELECT o_orderkey, 'kept' AS part FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)
    UNION ALL SELECT o_orderkey, 'left' FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""",
)
def semi_anti(spark, d):
    rich = table(spark, d, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    kept = relational.keep_members(o, rich, "o_custkey")
    rest = relational.keep_members(o, rich, "o_custkey", anti=True)
    return kept.select("o_orderkey", F.lit("kept").alias("part")).unionByName(
        rest.select("o_orderkey", F.lit("left").alias("part"))
    )


# --- aggregates -------------------------------------------------------------


@query(
    "history_features",
    with_("history")
    + """ SELECT client, round(coalesce(avg(amount), 0), 6) AS avg_amount,
    round(coalesce(stddev_samp(amount), 0), 4) AS std_amount, count(event) AS n_events, max(amount) AS max_amount
    FROM history GROUP BY client""",
)
def history_features(spark, d):
    f = relational.history_features(history(spark, d), "client", "amount", event="event")
    return rounded(rounded(f, 6, "avg_amount"), 4, "std_amount")


@query(
    "latest_value",
    with_("history")
    + """ SELECT client, arg_max(status, (ts, event)) AS status FROM history GROUP BY client""",
)
def latest_value(spark, d):
    return relational.latest_value(history(spark, d), "client", "status", ["ts", "event"])


@query(
    "top_k_per_group",
    with_("history")
    + """ SELECT client, event, amount, rn FROM (SELECT *, row_number() OVER
    (PARTITION BY client ORDER BY amount DESC, event) AS rn FROM history) WHERE rn <= 3""",
)
def top_k_per_group(spark, d):
    top = ranking.top_k_per_group(history(spark, d), "client", [F.desc("amount"), "event"], 3)
    return top.select("client", "event", "amount", "rn")


@query(
    "top_k_hot_key",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, rn::INT AS rn FROM (SELECT *, row_number() OVER
    (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn <= 5000""",
)
def top_k_hot_key(spark, d):
    """The 5,000 dearest lines of each of three keys, which hold all rows."""
    lines = table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"]
    return ranking.top_k_per_group(lines, "l_returnflag", order, 5000, lead=-F.col("l_extendedprice"))


@query(
    "weighted_centroid",
    with_("establishments")
    + """ SELECT cell, round(sum(lat * workers) / sum(workers + 1e-9::DOUBLE), 6) AS lat,
    round(sum(lon * workers) / sum(workers + 1e-9::DOUBLE), 6) AS lon,
    count(*) FILTER (WHERE workers > 0) AS n_active FROM establishments GROUP BY cell""",
)
def weighted_centroid(spark, d):
    from cuadrante.plans.tables import establishments

    e = establishments(spark, d).groupBy("cell").agg(
        measures.weighted_mean("lat", "workers").alias("lat"),
        measures.weighted_mean("lon", "workers").alias("lon"),
        F.count_if(F.col("workers") > 0).alias("n_active"),
    )
    return rounded(e, 6, "lat", "lon")


@query(
    "distinct_keys",
    """SELECT DISTINCT o_custkey, o_orderstatus, n FROM orders
    JOIN (SELECT count(DISTINCT o_orderpriority) AS n FROM orders) ON true""",
)
def distinct_keys(spark, d):
    o = table(spark, d, "orders")
    n = o.agg(F.count_distinct("o_orderpriority").alias("n")).scalar()
    return o.select("o_custkey", "o_orderstatus").distinct().withColumn("n", n)


@query(
    "crosstab_counts",
    "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2",
)
def crosstab_counts(spark, d):
    return relational.crosstab_counts(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


@query(
    "share_of_total",
    """WITH w AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL)
    SELECT c_nationkey, c_mktsegment, n, round(n / sum(n) OVER (), 8) AS share,
    round(n / sum(n) OVER (PARTITION BY c_nationkey), 8) AS share_in_nation FROM w""",
)
def share_of_total(spark, d):
    w = table(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    both = relational.share_of_total(
        relational.share_of_total(w, "n"), "n", by="c_nationkey", name="share_in_nation"
    )
    return rounded(both, 8, "share", "share_in_nation")


@query(
    "multi_resolution",
    with_("clients")
    + """, levels AS (SELECT unnest([3, 5, 7]) AS level)
    SELECT level, concat_ws(':', level, floor((lat + 90.0::DOUBLE) * pow(2.0::DOUBLE, level) / 180.0::DOUBLE)::BIGINT,
      floor((lon + 180.0::DOUBLE) * pow(2.0::DOUBLE, level) / 180.0::DOUBLE)::BIGINT) AS cell, count(*) AS n,
      round(sum(income), 4) AS sum_income, round(avg(income) + 1e-7::DOUBLE, 6) AS avg_income
    FROM clients, levels GROUP BY 1, 2""",
)
def multi_resolution(spark, d):
    out = relational.multi_resolution(clients(spark, d), "lat", "lon", [3, 5, 7], ["income"])
    return rounded(rounded(out, 4, "sum_income"), 6, "avg_income", shift=1e-7)


@query(
    "dissolve_keys",
    with_("blocks")
    + """ SELECT CVE_ENT, CVE_MUN, AMBITO, count(*) AS pieces, sum(POBTOT)::BIGINT AS POBTOT FROM blocks GROUP BY 1, 2, 3""",
)
def dissolve_keys(spark, d):
    return relational.dissolve(blocks(spark, d), ["CVE_ENT", "CVE_MUN", "AMBITO"], [F.sum("POBTOT").alias("POBTOT")])


# --- numbering --------------------------------------------------------------


@query(
    "sequential_id",
    """SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey)
    + (SELECT coalesce(max(c_custkey), 0) FROM customer) AS id FROM orders""",
)
def sequential_id(spark, d):
    from cuadrante.operators.maintenance import max_id

    start = max_id(table(spark, d, "customer"), "c_custkey").first()[0] + 1
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return ranking.sequential_id(o, ["o_orderdate", "o_orderkey"], start=start)


@query(
    "daily_account_key",
    """SELECT o_orderkey, ('1' || strftime(o_orderdate, '%Y%m%d') || lpad((row_number() OVER
    (PARTITION BY o_orderdate::DATE ORDER BY o_custkey, o_orderkey))::VARCHAR, 7, '0'))::BIGINT AS account_key FROM orders""",
)
def daily_account_key(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return ranking.daily_account_key(o, "o_orderdate", ["o_custkey", "o_orderkey"]).select("o_orderkey", "account_key")


@query(
    "padded_ordinal",
    """SELECT o_orderkey, lpad((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))::VARCHAR, 3, '0')
    AS ordinal FROM orders""",
)
def padded_ordinal(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = ranking.padded_ordinal(o, "o_custkey", ["o_orderdate", "o_orderkey"], 3, "ordinal")
    return out.select("o_orderkey", "ordinal")


@query(
    "minmax_scale",
    """SELECT s_suppkey, round((s_acctbal - min(s_acctbal) OVER ()) / (max(s_acctbal) OVER () - min(s_acctbal) OVER ()), 8)
    AS scaled FROM supplier""",
)
def minmax_scale(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    out = relational.minmax_scale(s, "s_acctbal", "scaled")
    return rounded(out.select("s_suppkey", "scaled"), 8, "scaled")


# --- order, limit, union ----------------------------------------------------


@query(
    "order_multi",
    "SELECT o_custkey, o_orderstatus, o_orderdate, o_orderkey FROM orders ORDER BY 1, 2, 3 DESC, 4",
)
def order_multi(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey")
    return o.orderBy("o_custkey", "o_orderstatus", F.desc("o_orderdate"), "o_orderkey")


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_n(spark, d):
    from cuadrante.sources.catalog import first_rows

    return first_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"])


@query(
    "union_by_name",
    """SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS tier, NULL::DOUBLE AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_nationkey, NULL, s_acctbal FROM supplier""",
)
def union_by_name(spark, d):
    c = table(spark, d, "customer").selectExpr("c_custkey AS id", "c_nationkey AS nation", "c_mktsegment AS tier")
    s = table(spark, d, "supplier").selectExpr("s_nationkey AS nation", "s_suppkey AS id", "s_acctbal AS balance")
    return relational.union_all([c, s])


# --- scalar functions -------------------------------------------------------


@query(
    "string_prefix",
    """SELECT p_partkey, substring((310000 + (p_partkey * 377) % 510000)::VARCHAR, 1, 2) AS sector,
    substring((310000 + (p_partkey * 377) % 510000)::VARCHAR, 1, 2) IN ('46', '72', '81') AS cash FROM part""",
)
def string_prefix(spark, d):
    code = (F.lit(310000) + (F.col("p_partkey") * 377) % 510000).cast("string")
    return table(spark, d, "part").select(
        "p_partkey", F.substring(code, 1, 2).alias("sector"), keys.prefix_in(code, 2, ["46", "72", "81"]).alias("cash")
    )


@query(
    "padded_keys",
    """SELECT s_suppkey, CASE WHEN length(s_suppkey::VARCHAR) >= 4 THEN s_suppkey::VARCHAR ELSE lpad(s_suppkey::VARCHAR, 4, '0') END AS k4,
    ('1' || lpad(s_nationkey::VARCHAR, 3, '0') || CASE WHEN length(s_suppkey::VARCHAR) >= 7 THEN s_suppkey::VARCHAR
      ELSE lpad(s_suppkey::VARCHAR, 7, '0') END)::BIGINT AS k FROM supplier""",
)
def padded_keys(spark, d):
    key = F.concat(F.lit("1"), keys.padded("s_nationkey", 3), keys.padded("s_suppkey", 7)).cast("bigint")
    return table(spark, d, "supplier").select("s_suppkey", keys.padded("s_suppkey", 4).alias("k4"), key.alias("k"))


@query(
    "regex_extract",
    "SELECT page_id, regexp_extract(url, '([^/]+)$', 1) AS file_name FROM pages",
)
def regex_extract(spark, d):
    return table(spark, d, "pages").select("page_id", keys.file_name("url").alias("file_name"))


@query(
    "month_grid",
    with_("clients")
    + """ SELECT client, m::INT AS period, (DATE '2020-01-01' + to_months(m::INT))::DATE AS month,
    strftime(DATE '2020-01-01' + to_months(m::INT), '%Y-%m-%d') AS month_text
    FROM clients, (SELECT unnest(range(1, 49)) AS m)""",
)
def month_grid(spark, d):
    month = F.add_months(F.to_date(F.lit("2020-01-01")), F.col("period"))
    grid = clients(spark, d).select("client", F.explode(F.sequence(F.lit(1), F.lit(48))).alias("period"))
    return grid.withColumns({"month": month, "month_text": F.date_format(month, "yyyy-MM-dd")})


_CIRCLE = """6371.0::DOUBLE * acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE,
  sin(radians({a})) * sin(radians({c})) + cos(radians({a})) * cos(radians({c})) * cos(radians({d}) - radians({b})))))"""


@query(
    "great_circle",
    with_("clients")
    + f""", d AS (SELECT client, {_CIRCLE.format(a='lat', b='lon', c='19.4326::DOUBLE', d='-99.1332::DOUBLE')} AS km FROM clients)
    SELECT client, round(CASE WHEN km <= 1500 THEN km END, 4) AS km FROM d""",
)
def great_circle(spark, d):
    km = geo.great_circle_km("lat", "lon", F.lit(19.4326), F.lit(-99.1332), max_km=1500)
    return clients(spark, d).select("client", r(km, 4).alias("km"))


@query(
    "math_scalars",
    """SELECT s_suppkey, round(exp(-0.01::DOUBLE * (s_suppkey % 50)), 8) AS e, round(ln(1.0::DOUBLE + s_suppkey), 8) AS l,
    round(log10(1.0::DOUBLE + s_suppkey), 8) AS l10, round(pow(1.0::DOUBLE + s_suppkey, 0.3::DOUBLE), 8) AS p,
    ceil(s_acctbal / 100)::BIGINT AS c, floor(s_acctbal / 100)::BIGINT AS f FROM supplier""",
)
def math_scalars(spark, d):
    k = F.lit(1.0) + F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        "s_suppkey",
        r(F.exp(F.lit(-0.01) * (F.col("s_suppkey") % 50)), 8).alias("e"),
        r(F.ln(k), 8).alias("l"),
        r(F.log10(k), 8).alias("l10"),
        r(F.pow(k, F.lit(0.3)), 8).alias("p"),
        F.ceil(F.col("s_acctbal") / 100).alias("c"),
        F.floor(F.col("s_acctbal") / 100).alias("f"),
    )


@query(
    "clamp_nulls",
    with_("establishments")
    + """ SELECT cell, workers, count(*) AS n, max(CASE WHEN workers IS NULL THEN NULL ELSE greatest(workers / 100.0::DOUBLE, 0.05::DOUBLE) END) AS kept,
    max(least(coalesce(workers, 7), 30)) AS capped FROM establishments GROUP BY cell, workers""",
)
def clamp_nulls(spark, d):
    from cuadrante.plans.tables import establishments

    w = F.col("workers")
    return establishments(spark, d).groupBy("cell", "workers").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(measures.floor_at(w / F.lit(100.0), 0.05)).alias("kept"),
        F.max(F.least(F.coalesce(w, F.lit(7)), F.lit(30))).alias("capped"),
    )


def md5_fraction(*keys: str, salt: str = "") -> str:
    """The SQL of ``hash_fraction`` over the parts of a key."""
    text = " || '|' || ".join([*(f"coalesce(length(({k})::VARCHAR) || ':' || ({k})::VARCHAR, '-')" for k in keys), f"'{salt}'"])
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


@query(
    "hash_fraction_parts",
    f"""WITH k AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus || '|' || o_orderpriority ELSE o_orderstatus END AS a,
      CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_orderpriority END AS b FROM orders)
    SELECT o_orderkey, {md5_fraction("a", "b", salt="p")} AS u FROM k""",
)
def hash_fraction_parts(spark, d):
    """Keys with a bar in a part and with a null part."""
    third = F.col("o_orderkey") % 3
    a = F.when(third == 0, F.concat_ws("|", "o_orderstatus", "o_orderpriority")).otherwise(F.col("o_orderstatus"))
    b = F.when(third != 1, F.col("o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", draws.hash_fraction(a, b, salt="p").alias("u"))


@query(
    "hash_fraction",
    f"SELECT c_custkey, {md5_fraction("c_custkey", "c_nationkey", salt="x")} AS u FROM customer",
)
def hash_fraction(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", draws.hash_fraction("c_custkey", "c_nationkey", salt="x").alias("u")
    )


@query(
    "array_pipeline",
    with_("poles")
    + """, v AS (SELECT pole_id, [w, f, NULL, pole_lat / 100] AS a FROM poles),
    s AS (SELECT pole_id, list_sort(list_filter(a, lambda x: x IS NOT NULL)) AS a FROM v)
    SELECT pole_id, round(a[1], 8) AS least, len(a)::INT AS n, round(list_sum(list_transform(a[1:2], lambda x: x * x)), 8) AS squares FROM s""",
)
def array_pipeline(spark, d):
    values = F.array("w", "f", F.lit(None).cast("double"), F.col("pole_lat") / 100)
    a = poles(spark, d).select("pole_id", F.array_sort(F.array_compact(values)).alias("a"))
    squares = F.transform(F.slice("a", 1, 2), lambda x: x * x)
    return a.select(
        "pole_id",
        r(F.element_at("a", 1), 8).alias("least"),
        F.size("a").alias("n"),
        r(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x), 8).alias("squares"),
    )


@query(
    "json_parse",
    """SELECT event_id, (props::JSON ->> '$.k')::INT AS k FROM events""",
)
def json_parse(spark, d):
    from pyspark.sql.types import IntegerType, StructField, StructType

    schema = StructType([StructField("k", IntegerType())])
    raw = F.col("props").cast("binary")
    return table(spark, d, "events").select(
        "event_id", F.from_json(raw.cast("string"), schema).alias("data")
    ).select("event_id", "data.*")


@query(
    "instalment",
    """SELECT o_orderkey, round(CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice / 24 ELSE
    o_totalprice * (0.22::DOUBLE / 12) / (1 - pow(1 + 0.22::DOUBLE / 12, -24)) END, 6) AS instalment FROM orders""",
)
def instalment(spark, d):
    rate = F.when(F.col("o_orderkey") % 10 == 0, F.lit(0.0)).otherwise(F.lit(0.22 / 12))
    return table(spark, d, "orders").select(
        "o_orderkey", r(finance.instalment("o_totalprice", rate, 24), 6).alias("instalment")
    )


@query(
    "months_to_settle",
    """WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN l_partkey % 29 = 0 THEN 0.0::DOUBLE ELSE l_extendedprice END AS b,
      l_quantity * 100 AS p, 0.38::DOUBLE / 12 AS r FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN b <= 0 THEN 0 WHEN p <= b * r THEN 99
    ELSE least(99, ceil(ln(p / (p - b * r)) / ln(1 + r)))::INT END AS months FROM b""",
)
def months_to_settle(spark, d):
    balance = F.when(F.col("l_partkey") % 29 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        finance.months_to_settle(balance, F.col("l_quantity") * 100, F.lit(0.38 / 12)).alias("months"),
    )


@query(
    "minimum_payment",
    """SELECT c_custkey, round(CASE WHEN c_acctbal > 0 THEN c_acctbal * (0.55::DOUBLE / 12) + c_acctbal * 0.0125::DOUBLE ELSE 0 END, 6) AS least
    FROM customer""",
)
def minimum_payment(spark, d):
    due = finance.minimum_payment("c_acctbal", F.lit(0.55 / 12))
    return table(spark, d, "customer").select("c_custkey", r(due, 6).alias("least"))


@query(
    "ratios",
    with_("clients")
    + """ SELECT client, round(income * (1 + 0.38::DOUBLE) / 36, 6) AS flat, round(expense / (income * 12), 6) AS debt_ratio FROM clients""",
)
def ratios(spark, d):
    return clients(spark, d).select(
        "client",
        r(finance.flat_instalment("income", 0.38, 36), 6).alias("flat"),
        r(finance.debt_to_income("expense", "income"), 6).alias("debt_ratio"),
    )


@query(
    "zscore",
    with_("clients")
    + """, s AS (SELECT avg(income) AS m, stddev_samp(income) AS d FROM clients)
    SELECT client, round((income - m) / d, 6) + 0.0 AS z FROM clients, s""",
)
def zscore(spark, d):
    z = relational.zscore_columns(clients(spark, d).select("client", "income"), {"income": "z"})
    return rounded(z.select("client", "z"), 6, "z")


@query(
    "dagum_quantile",
    f"""WITH u AS (SELECT c_custkey, {md5_fraction("c_custkey", salt="i")} AS u, {md5_fraction("c_custkey", salt="g")} AS g FROM customer)
    SELECT c_custkey, round(15000.0::DOUBLE * pow(pow(u, -1 / 0.7::DOUBLE) - 1, -1 / 3.5::DOUBLE), 4) AS income,
    round(9000.0::DOUBLE * pow(pow(g, -1 / 0.8::DOUBLE) - 1, -1 / 4.0::DOUBLE), 4) AS expense FROM u""",
)
def dagum_quantile(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        r(draws.dagum_quantile(draws.hash_fraction("c_custkey", salt="i"), 15000.0, 0.7, 3.5), 4).alias("income"),
        r(draws.dagum_quantile(draws.hash_fraction("c_custkey", salt="g"), 9000.0, 0.8, 4.0), 4).alias("expense"),
    )


@query(
    "weighted_pick",
    f"""WITH u AS (SELECT c_custkey, {md5_fraction("c_custkey", salt="civil")} AS u FROM customer)
    SELECT c_custkey, CASE WHEN u < 0.3 THEN 'Soltero(a)' WHEN u < 0.7 THEN 'Casado(a)' WHEN u < 0.9 THEN 'Divorciado(a)'
    ELSE 'Viudo(a)' END AS marital FROM u""",
)
def weighted_pick(spark, d):
    from cuadrante.operators.frames import MARITAL, MARITAL_WEIGHTS

    u = draws.hash_fraction("c_custkey", salt="civil")
    return table(spark, d, "customer").select("c_custkey", draws.weighted_pick(u, MARITAL, MARITAL_WEIGHTS).alias("marital"))


@query(
    "noise",
    f"""WITH u AS (SELECT c_custkey, {md5_fraction("c_custkey", salt="n1")} AS a, {md5_fraction("c_custkey", salt="n2")} AS b FROM customer)
    SELECT c_custkey, floor(a * 480)::INT AS months, round(0.5::DOUBLE + a * (1.2::DOUBLE - 0.5::DOUBLE), 8) AS uniform,
    round(sqrt(-2 * ln(1 - a)) * cos(2 * pi() * b), 6) + 0.0 AS normal FROM u""",
)
def noise(spark, d):
    a, b = draws.hash_fraction("c_custkey", salt="n1"), draws.hash_fraction("c_custkey", salt="n2")
    return table(spark, d, "customer").select(
        "c_custkey",
        draws.between_int(a, 0, 479).alias("months"),
        r(draws.between(a, 0.5, 1.2), 8).alias("uniform"),
        r(draws.normal(a, b), 6).alias("normal"),
    )


@query(
    "grid_cell",
    with_("clients")
    + """, i AS (SELECT client, floor((lat + 90.0::DOUBLE) * 256.0::DOUBLE / 180.0::DOUBLE)::BIGINT AS r,
      floor((lon + 180.0::DOUBLE) * 256.0::DOUBLE / 180.0::DOUBLE)::BIGINT AS c FROM clients)
    SELECT client, concat_ws(':', '8', r, c) AS cell, concat_ws(':', '6', r // 4, c // 4) AS parent FROM i""",
)
def grid_cell(spark, d):
    cell = geo.grid_cell("lat", "lon", 8)
    return clients(spark, d).select("client", cell.alias("cell"), geo.grid_parent(cell, 2).alias("parent"))


# --- quotas and repetition --------------------------------------------------


@query(
    "apportion_truncate",
    """WITH w AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1),
    q AS (SELECT c_nationkey, n, floor((SELECT count(*) FROM orders) * (n / (SELECT sum(n) FROM w)::DOUBLE))::BIGINT AS quota FROM w)
    SELECT * FROM q WHERE quota > 0""",
)
def apportion_truncate(spark, d):
    w = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    total = table(spark, d, "orders").agg(F.count(F.lit(1)).alias("n")).scalar()
    return apportion.apportion_truncate(w, total, "n")


@query(
    "apportion_remainder",
    """WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, CASE WHEN l_orderkey % 5 = 0 THEN 0 ELSE l_linenumber END AS weight,
      (l_orderkey % 97)::BIGINT AS total, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity) AS rn FROM lineitem),
    b AS (SELECT *, CASE WHEN sum(weight) OVER o > 0 THEN floor(total::DOUBLE * weight / sum(weight) OVER o)
      ELSE floor(total::DOUBLE / count(*) OVER o) END::BIGINT AS base FROM l WINDOW o AS (PARTITION BY l_orderkey))
    SELECT l_orderkey, rn, total, weight, base + CASE WHEN rn <= total - sum(base) OVER (PARTITION BY l_orderkey) THEN 1 ELSE 0 END AS quota FROM b""",
)
def apportion_remainder(spark, d):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]
    li = table(spark, d, "lineitem").select(
        "l_orderkey",
        *order,
        F.when(F.col("l_orderkey") % 5 == 0, 0).otherwise(F.col("l_linenumber")).alias("weight"),
        (F.col("l_orderkey") % 97).alias("total"),
    )
    numbered = ranking.row_numbers(li, "l_orderkey", order)
    out = apportion.apportion_remainder(numbered, "total", "weight", "l_orderkey", "rn")
    return out.select("l_orderkey", "rn", "total", "weight", "quota")


@query(
    "uncount",
    """SELECT p_partkey, unnest(range(1, p_size % 7 + 1)) AS ordinal FROM part""",
)
def uncount(spark, d):
    p = table(spark, d, "part").select("p_partkey", (F.col("p_size") % 7).alias("n"))
    return apportion.uncount(p, "n").select("p_partkey", "ordinal")


@query(
    "prefixed_code",
    f"""WITH p AS (SELECT s_suppkey,
      CASE s_nationkey + 1 WHEN 1 THEN '20' WHEN 2 THEN '21' WHEN 3 THEN '23' WHEN 4 THEN '24' WHEN 5 THEN '25' WHEN 6 THEN '28'
       WHEN 7 THEN '29' WHEN 8 THEN '31' WHEN 9 THEN '0' WHEN 10 THEN '34' WHEN 11 THEN '36' WHEN 12 THEN '39' WHEN 13 THEN '42'
       WHEN 14 THEN '44' WHEN 15 THEN '50' WHEN 16 THEN '58' WHEN 17 THEN '62' WHEN 18 THEN '63' WHEN 19 THEN '64' WHEN 20 THEN '68'
       WHEN 21 THEN '72' WHEN 22 THEN '76' WHEN 23 THEN '77' WHEN 24 THEN '78' WHEN 25 THEN '80' ELSE '0' END AS prefix,
      {md5_fraction("s_suppkey", salt="zip")} AS u FROM supplier)
    SELECT s_suppkey, prefix || lpad(floor(u * pow(10.0::DOUBLE, 5 - length(prefix)))::BIGINT::VARCHAR, (5 - length(prefix))::INT, '0') AS zip FROM p""",
)
def prefixed_code(spark, d):
    u = draws.hash_fraction("s_suppkey", salt="zip")
    return table(spark, d, "supplier").select("s_suppkey", keys.prefixed_code(F.col("s_nationkey") + 1, u).alias("zip"))


@query(
    "birth_date",
    f"""WITH u AS (SELECT c_custkey, (18 + c_custkey % 58)::INT AS age, {md5_fraction("c_custkey", salt="b")} AS u FROM customer)
    SELECT c_custkey, age, ((DATE '2024-02-29' - to_months(12 * age))::DATE - floor(u * 365)::INT)::DATE AS born FROM u""",
)
def birth_date(spark, d):
    age = (F.col("c_custkey") % 58 + 18).cast("int")
    born = keys.birth_date(age, F.lit("2024-02-29").cast("date"), draws.hash_fraction("c_custkey", salt="b"))
    return table(spark, d, "customer").select("c_custkey", age.alias("age"), born.alias("born"))
