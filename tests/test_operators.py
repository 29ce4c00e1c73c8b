import pytest
from pyspark.sql import functions as F

from cuadrante.functions import draws, geo
from cuadrante.operators import apportion, maintenance, ranking, relational, territory


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# A table where one key holds most rows, as every numbering must survive.
@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 != 0, 0).otherwise(F.col("id") % 50).alias("k"), ((F.col("id") * 7919) % 3001).alias("o")
    )


@pytest.mark.parametrize("hot", [10, 100, 10**9])
def test_row_numbers_are_the_same_for_hot_groups(spark, skewed, hot):
    got = ranking.row_numbers(skewed, "k", "o", hot_rows=hot)
    want = skewed.selectExpr("id", "row_number() OVER (PARTITION BY k ORDER BY o) AS w")
    assert got.count() == 3000
    assert got.join(want, "id").filter("rn <> w").count() == 0


def test_row_numbers_with_null_keys(spark):
    df = spark.createDataFrame([(None, i) for i in range(20)] + [(1, 5)], "k int, o int")
    got = ranking.row_numbers(df, "k", "o", hot_rows=5)
    assert rows(got.filter("k IS NULL").select("o", "rn")) == [(i, i + 1) for i in range(20)]
    assert rows(got.filter("k = 1").select("rn")) == [(1,)]


@pytest.mark.parametrize("k,hot", [(1001, 10**9), (1500, 100), (1999, 10), (5000, 500)])
def test_large_k(spark, k, hot):
    """Outliers, ties, nulls, NaN and infinities in the leading column."""
    lead = F.when(F.col("id") % 97 == 0, None).when(F.col("id") % 101 == 0, float("nan")).when(F.col("id") == 1, float("-inf"))
    lead = lead.when(F.col("id") % 1000 == 7, F.col("id") * 1e12).when(F.col("id") % 2 == 0, F.lit(5.0)).otherwise(F.rand(3))
    key = F.when(F.col("id") % 10 < 6, 1).when(F.col("id") % 10 < 9, None).otherwise(F.col("id") % 70)
    df = spark.range(20_000).select("id", key.alias("k"), lead.alias("x")).withColumn("other", F.lit("z"))
    want = df.selectExpr("*", "row_number() OVER (PARTITION BY k ORDER BY x, id) AS w").filter(F.col("w") <= k)
    got = ranking.top_k_per_group(df, "k", ["x", "id"], k, lead=F.col("x"), hot_rows=hot)
    assert got.columns == ["id", "k", "x", "other", "rn"] and got.count() == want.count()
    assert got.join(want, "id").filter("rn = w").count() == want.count()


def test_large_k_numbers_few_rows(spark, monkeypatch):
    """Rows beyond the threshold are gone before any of them is numbered."""
    seen = []
    plain = ranking.row_numbers
    monkeypatch.setattr(ranking, "row_numbers", lambda df, *a: seen.append(df.count()) or plain(df, *a))
    df = spark.range(200_000).select(F.lit(1).alias("k"), "id", (F.rand(1) * F.rand(2)).alias("x"))
    got = ranking.top_k_per_group(df, "k", [F.desc("x"), "id"], 5000, lead=-F.col("x"))
    assert got.count() == 5000 and 5000 <= seen[0] <= 10_000
    assert ranking.top_k_per_group(df.limit(0), "k", ["x"], 5000, lead=F.col("x")).count() == 0


def test_sequential_ids_are_dense_and_ordered(spark, skewed):
    got = ranking.sequential_id(skewed.drop("k"), "o", start=11, name="seq")
    want = skewed.selectExpr("id", "row_number() OVER (ORDER BY o) + 10 AS w")
    assert got.join(want, "id").filter("seq <> w").count() == 0


def test_sequential_id_of_nothing(spark):
    assert ranking.sequential_id(spark.range(0), "id", name="seq").count() == 0


def test_daily_key_widens_for_a_full_day(spark):
    df = spark.range(12).select("id", F.when(F.col("id") < 11, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("timestamp").alias("ts"))
    got = [r["account_key"] for r in ranking.daily_account_key(df, "ts", "id", width=1).orderBy("id").collect()]
    assert got == sorted(set(got)) and got[0] == 12024010101 and got[-1] == 12024010201
    with pytest.raises(ValueError, match="do not fit"):
        ranking.daily_account_key(df, "ts", "id", width=11)


def test_cells_without_a_place(spark):
    df = spark.createDataFrame([(10.0, None, 1.0), (None, 20.0, 2.0), (10.0, 20.0, 4.0)], "lat double, lon double, v double")
    cells = [r[0] for r in df.select(geo.grid_cell("lat", "lon", 4)).collect()]
    assert cells[:2] == [None, None] and cells[2].startswith("4:")
    assert df.limit(1).select(geo.grid_parent(F.lit(None).cast("string"))).first()[0] is None
    got = {(r["level"], r["cell"]): r["n"] for r in relational.multi_resolution(df, "lat", "lon", [2, 3], ["v"]).collect()}
    assert got[2, None] == got[3, None] == 2 and sum(got.values()) == 6


def test_hash_fraction_tells_parts_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("a", "-")], "x string, y string")
    assert df.select(draws.hash_fraction("x", "y").alias("u")).distinct().count() == 5


def test_remainder_goes_to_the_first_rows(spark):
    df = spark.createDataFrame([("a", i, 11, w) for i, w in enumerate([1, 1, 1, 0])], "g string, i int, t int, w int")
    got = apportion.apportion_remainder(df, "t", "w", "g", "i")
    assert rows(got.select("i", "quota")) == [(0, 4), (1, 4), (2, 3), (3, 0)]


def test_zero_weights_split_evenly(spark):
    df = spark.createDataFrame([("a", i, 7, 0) for i in range(3)], "g string, i int, t int, w int")
    assert rows(apportion.apportion_remainder(df, "t", "w", "g", "i").select("i", "quota")) == [(0, 3), (1, 2), (2, 2)]


@pytest.mark.parametrize("hot", [20, 10**9])
def test_quotas_add_up(spark, skewed, hot):
    df = skewed.withColumns({"t": F.col("k") * 13 + 5, "w": F.col("o") % 11})
    got = apportion.apportion_remainder(df, "t", "w", "k", "o", hot_rows=hot)
    assert got.groupBy("k").agg(F.sum("quota").alias("q"), F.max("t").alias("t")).filter("q <> t").count() == 0


def test_truncated_quotas_never_exceed_the_total(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate([5, 3, 3, 0])], "i int, w int")
    got = rows(apportion.apportion_truncate(df, 10, "w").select("i", "quota"))
    assert got == [(0, 4), (1, 2), (2, 2)]


@pytest.mark.parametrize("spread", [False, True])
def test_uncount(spark, spread):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 3), ("d", None), ("e", 25)], "k string, n int")
    got = apportion.uncount(df, "n", chunk=10, spread=spread)
    want = [("b", 1)] + [("c", i) for i in (1, 2, 3)] + [("e", i) for i in range(1, 26)]
    assert rows(got.select("k", "ordinal")) == want


def test_upsert(spark):
    target = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (3, 3.0, "c")], "k int, v double, s string")
    source = spark.createDataFrame([(2, None, "x"), (9, 9.0, "y")], "k int, v double, s string")
    once = maintenance.upsert(target, source, "k", ["v"])
    assert rows(once) == [(1, 1.0, "a"), (2, None, "b"), (3, 3.0, "c"), (9, 9.0, "y")]
    assert rows(maintenance.upsert(once, source, "k", ["v"])) == rows(once)


def test_upsert_refuses_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, 1.0)], "k int, v double")
    source = spark.createDataFrame([(1, 2.0), (1, 3.0)], "k int, v double")
    with pytest.raises(Exception, match="not unique"):
        maintenance.upsert(target, source, "k", ["v"]).collect()


def test_enrich_refuses_ambiguous_lookup(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    lookup = spark.createDataFrame([(1, "a"), (1, "b")], "k int, c string")
    with pytest.raises(Exception, match="not unique"):
        relational.enrich(df, lookup, "k", ["c"]).collect()
    assert rows(relational.enrich(df, lookup.limit(1), "k", ["c"])) in ([(1, "a"), (2, None)], [(1, "b"), (2, None)])


def test_delete_keeps_rows_with_null_condition(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    assert sorted(map(str, (r[0] for r in maintenance.delete_where(df, "k = 1").collect()))) == ["3", "None"]
    assert maintenance.delete_where(df, F.col("k").isNull()).count() == 2


def test_max_id_of_an_empty_table(spark):
    assert maintenance.max_id(spark.range(0), "id").first()[0] == 0


def test_group_of_one_row_has_zero_deviation(spark):
    df = spark.createDataFrame([(1, 5.0)], "k int, a double")
    assert relational.history_features(df, "k", "a").first()["std_amount"] == 0.0


def test_scaling_equal_values(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "k int, a double")
    assert {r["a_scaled"] for r in relational.minmax_scale(df, "a").collect()} == {None}
    assert {r["a_scaled"] for r in relational.minmax_scale(df, "a", default=0.0).collect()} == {0.0}


def test_quarantine_names_the_missing_columns(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, None)], "k int, x double, y string")
    ok, bad = relational.quarantine(df, ["x", "y"])
    assert ok.count() == 1 and bad.first()["missing"] == ["x", "y"]


def test_empty_input_keeps_the_schema(spark):
    df = spark.createDataFrame([], "k int, x double")
    ok, bad = relational.quarantine(df, ["x"])
    assert ok.columns == ["k", "x"] and ok.count() == 0 and bad.count() == 0
    assert relational.share_of_total(df, "x").columns == ["k", "x", "share"]


def test_shares_sum_to_one(spark, skewed):
    total = relational.share_of_total(skewed, "o", by="k").groupBy("k").agg(F.sum("share").alias("s"))
    assert total.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_entropy_bounds(spark, skewed):
    got = territory.entropy_by(skewed.withColumn("w", F.lit(2)), "k", F.col("o") % 8, "w")
    import math

    assert got.filter((F.col("entropy") < 0) | (F.col("entropy") > math.log(8) + 1e-9)).count() == 0


def test_entropy_skips_weightless_cells(spark):
    df = spark.createDataFrame([("a", "x", 0), ("a", "y", None), ("b", "x", 3)], "c string, s string, w int")
    assert rows(territory.entropy_by(df, "c", F.col("s"), "w")) == [("b", 0.0)]


def test_friction_of_equal_establishments_is_zero(spark):
    df = spark.createDataFrame([("a", 10), ("a", 10)], "cell string, workers int")
    assert [r["friction"] for r in territory.friction(df).collect()] == [0.0, 0.0]


def test_dissolve_and_crosstab(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    got = {r["k"]: (r["pieces"], r["v"]) for r in relational.dissolve(df, "k", [F.sum("v").alias("v")]).collect()}
    assert got == {"a": (2, 3), None: (2, 7)}


def test_column_sketches(spark):
    n = 100_000
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 == 0, None).when(F.col("id") % 7 == 0, "warm").otherwise(F.col("id").cast("string"))
    df = spark.range(n).repartition(7).select("id", hot.alias("a `name`"), F.lit(None).cast("double").alias("nothing"))
    got = {r["column"]: r for r in relational.column_sketches(df, df.columns, top=2).collect()}
    true = {r[0]: r["count"] for r in df.groupBy(F.col("`a ``name```")).count().filter("`a ``name``` IN ('hot', 'warm')").collect()}
    frequent = got["a `name`"]["frequent"]
    assert [x["value"] for x in frequent] == ["hot", "warm"]
    assert all(true[x["value"]] <= x["estimate"] <= true[x["value"]] + 3.5 / 4096 * n for x in frequent)
    assert got["a `name`"]["nulls"] == df.filter("`a ``name``` IS NULL").count() and got["a `name`"]["quantiles"] is None
    assert all(abs(q - s * n) <= n / 10_000 + 1 for q, s in zip(got["id"]["quantiles"], (0.25, 0.5, 0.75)))
    assert abs(got["id"]["distinct_values"] / n - 1) < 0.15
    assert got["nothing"]["nulls"] == n and got["nothing"]["quantiles"] is None and got["nothing"]["frequent"] == []
    empty = relational.column_sketches(df.limit(0), ["id"]).first()
    assert (empty["rows"], empty["quantiles"], empty["frequent"]) == (0, None, [])
