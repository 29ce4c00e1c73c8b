"""The test tables and the domain frames derived from them.

Each frame has the same arithmetic as SQL in ``SQL``, a set of WITH clauses the
reference queries start from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lat_of(key: Column) -> Column:
    return F.lit(14.5) + ((key * F.lit(7919)) % F.lit(18000)) / F.lit(1000.0)


def lon_of(key: Column) -> Column:
    return F.lit(-118.0) + ((key * F.lit(104729)) % F.lit(32000)) / F.lit(1000.0)


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    income = F.greatest(F.col("c_acctbal"), F.lit(0.0)) + F.lit(1000.0)
    return c.select(
        F.col("c_custkey").alias("client"),
        F.col("c_nationkey").alias("cell"),
        F.col("c_mktsegment").alias("tier"),
        income.alias("income"),
        (income * (F.lit(0.5) + (F.col("c_custkey") % 7) / F.lit(10.0))).alias("expense"),
        lat_of(F.col("c_custkey")).alias("lat"),
        lon_of(F.col("c_custkey")).alias("lon"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("client"),
        F.col("o_orderkey").alias("event"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderstatus").alias("status"),
    )


def poles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey") + 5000
    return s.select(
        F.col("s_suppkey").alias("pole_id"),
        lat_of(k).alias("pole_lat"),
        lon_of(k).alias("pole_lon"),
        (F.lit(0.05) * F.log10(F.lit(1.0) + F.greatest(F.col("s_acctbal"), F.lit(0.0)))).alias("w"),
        (F.lit(1.0) + (F.col("s_suppkey") % 10) / F.lit(10.0)).alias("f"),
    )


def establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("cell")
    )
    pk = F.col("l_partkey")
    return li.join(s, "l_suppkey").select(
        "cell",
        F.when(pk % 11 == 0, F.lit(None))
        .when(pk % 13 == 0, F.lit(0))
        .otherwise(F.col("l_quantity").cast("int"))
        .alias("workers"),
        F.col("l_extendedprice").alias("wages"),
        (F.lit(310000) + (pk * 377) % 510000).cast("string").alias("code"),
        lat_of(pk).alias("lat"),
        lon_of(pk).alias("lon"),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    lived = F.floor(size * F.lit(0.8)).cast("int")
    return p.select(
        k.alias("block"),
        (k % 32 + 1).cast("string").alias("CVE_ENT"),
        (k % 125).cast("string").alias("CVE_MUN"),
        F.lpad((k % 9000).cast("string"), 4, "0").alias("CVE_LOC"),
        k.cast("string").alias("CVEGEO"),
        F.when(k % 3 == 0, "R").otherwise("U").alias("AMBITO"),
        size.alias("VIVTOT"),
        lived.alias("VIVPAR_HAB"),
        (lived + k % 3).cast("int").alias("TOTHOG"),
        (size * 3 + k % 7).cast("int").alias("POBTOT"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account movements: one row per order line, by month of shipment."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("account"), F.col("o_totalprice").alias("opening")
    )
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("account"),
        ((F.year("l_shipdate") - 1990) * 12 + F.month("l_shipdate")).cast("bigint").alias("period"),
        F.when(F.col("l_returnflag") == "R", F.lit(0.0))
        .otherwise(F.col("l_extendedprice") * F.lit(0.2))
        .alias("payment"),
        F.col("l_quantity").alias("charge"),
        (F.col("l_linenumber") * 15).alias("line_days"),
        "l_returnflag",
    )
    fixed = F.col("account") % 2 == 0
    return li.join(o, "account").select(
        "account",
        "period",
        "payment",
        F.when(fixed, F.lit(0.0)).otherwise(F.col("charge")).alias("charge"),
        "opening",
        F.lit(0.22 / 12).alias("rate"),
        F.lit(24).alias("term"),
        F.when(fixed, "fijo").otherwise("revolvente").alias("kind"),
        (F.col("opening") / F.lit(4.0)).alias("income"),
        F.lit(600.0).alias("score"),
        "l_returnflag",
        "line_days",
    )


# The same frames for the reference queries.
SQL = {
    "clients": """clients AS (SELECT c_custkey AS client, c_nationkey AS cell, c_mktsegment AS tier,
      greatest(c_acctbal, 0.0::DOUBLE) + 1000.0::DOUBLE AS income,
      (greatest(c_acctbal, 0.0::DOUBLE) + 1000.0::DOUBLE) * (0.5::DOUBLE + (c_custkey % 7) / 10.0::DOUBLE) AS expense,
      14.5::DOUBLE + ((c_custkey * 7919) % 18000) / 1000.0::DOUBLE AS lat,
      -118.0::DOUBLE + ((c_custkey * 104729) % 32000) / 1000.0::DOUBLE AS lon FROM customer)""",
    "history": """history AS (SELECT o_custkey AS client, o_orderkey AS event, o_totalprice AS amount,
      o_orderdate AS ts, o_orderstatus AS status FROM orders)""",
    "poles": """poles AS (SELECT s_suppkey AS pole_id,
      14.5::DOUBLE + (((s_suppkey + 5000) * 7919) % 18000) / 1000.0::DOUBLE AS pole_lat,
      -118.0::DOUBLE + (((s_suppkey + 5000) * 104729) % 32000) / 1000.0::DOUBLE AS pole_lon,
      0.05::DOUBLE * log10(1.0::DOUBLE + greatest(s_acctbal, 0.0::DOUBLE)) AS w,
      1.0::DOUBLE + (s_suppkey % 10) / 10.0::DOUBLE AS f FROM supplier)""",
    "establishments": """establishments AS (SELECT s_nationkey AS cell,
      CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 13 = 0 THEN 0 ELSE l_quantity::INT END AS workers,
      l_extendedprice AS wages, (310000 + (l_partkey * 377) % 510000)::VARCHAR AS code,
      14.5::DOUBLE + ((l_partkey * 7919) % 18000) / 1000.0::DOUBLE AS lat,
      -118.0::DOUBLE + ((l_partkey * 104729) % 32000) / 1000.0::DOUBLE AS lon
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)""",
    "blocks": """blocks AS (SELECT p_partkey AS block, (p_partkey % 32 + 1)::VARCHAR AS CVE_ENT,
      (p_partkey % 125)::VARCHAR AS CVE_MUN, lpad((p_partkey % 9000)::VARCHAR, 4, '0') AS CVE_LOC,
      p_partkey::VARCHAR AS CVEGEO, CASE WHEN p_partkey % 3 = 0 THEN 'R' ELSE 'U' END AS AMBITO,
      p_size AS VIVTOT, floor(p_size * 0.8::DOUBLE)::INT AS VIVPAR_HAB,
      (floor(p_size * 0.8::DOUBLE)::INT + p_partkey % 3)::INT AS TOTHOG,
      (p_size * 3 + p_partkey % 7)::INT AS POBTOT FROM part)""",
    "payments": """payments AS (SELECT l_orderkey AS account,
      ((year(l_shipdate) - 1990) * 12 + month(l_shipdate))::BIGINT AS period,
      CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE ELSE l_extendedprice * 0.2::DOUBLE END AS payment,
      CASE WHEN l_orderkey % 2 = 0 THEN 0.0::DOUBLE ELSE l_quantity END AS charge,
      o_totalprice AS opening, 0.22::DOUBLE / 12 AS rate, 24 AS term,
      CASE WHEN l_orderkey % 2 = 0 THEN 'fijo' ELSE 'revolvente' END AS kind,
      o_totalprice / 4.0::DOUBLE AS income, 600.0::DOUBLE AS score, l_returnflag, l_linenumber * 15 AS line_days
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
}


def with_(*names: str, recursive: bool = False) -> str:
    """A WITH clause holding the named frames (no trailing comma)."""
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(SQL[n] for n in names)
