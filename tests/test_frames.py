from pyspark.sql import functions as F

from cuadrante.operators import frames

BLOCK = "CVEGEO string, VIVTOT int, TVIVPAR int, VIVPAR_HAB int, TOTHOG int, POBTOT int"


def chain(spark, rows):
    blocks = frames.clean_blocks(spark.createDataFrame(rows, BLOCK))
    d = frames.dwelling_frame(blocks, ["CVEGEO"])
    h = frames.household_frame(d, ["CVEGEO"])
    return blocks, d, h, frames.person_frame(h, ["CVEGEO"])


def test_persons_add_up_to_the_population(spark):
    rows = [(str(i), i % 9 + 1, 3, (i * 7) % 9 + 1, (i * 5) % 14, (i * 13) % 40) for i in range(120)]
    blocks, d, h, p = chain(spark, rows)
    want = {r["CVEGEO"]: r["POBTOT"] for r in blocks.collect()}
    got = {r["CVEGEO"]: r["n"] for r in d.groupBy("CVEGEO").agg(F.sum("PERxVIV").alias("n")).collect()}
    assert got == want
    lived = {r["CVEGEO"]: r["n"] for r in d.filter("ID_VPH > 0").groupBy("CVEGEO").agg(F.sum("PERxVIV").alias("n")).collect()}
    people = {r["CVEGEO"]: r["n"] for r in p.groupBy("CVEGEO").agg(F.count("*").alias("n")).collect()}
    assert {k: v for k, v in lived.items() if v} == people
    assert d.count() == sum(r["VIVTOT"] for r in blocks.collect())


def test_ordinals_are_unique(spark):
    _, d, h, p = chain(spark, [("a", 4, 3, 3, 5, 17), ("b", 2, 2, 2, 2, 3)])
    assert d.select("CVEGEO", "ID_DOMICILIO").distinct().count() == d.count() == 6
    assert h.select("CVEGEO", "ID_DOMICILIO", "ID_HOGAR").distinct().count() == h.count() == 7
    assert p.select("CVEGEO", "ID_DOMICILIO", "ID_HOGAR", "ID_PER").distinct().count() == p.count() == 20


def test_defaults_of_unreported_blocks(spark):
    blocks, d, *_ = chain(spark, [("a", None, None, None, None, None), ("b", 0, 3, 3, 3, 11), ("c", 2, 0, 0, 5, 7)])
    got = {r["CVEGEO"]: (r["VIVTOT"], r["VIVPAR_HAB"], r["TOTHOG"], r["POBTOT"]) for r in blocks.collect()}
    assert got == {"a": (5, 3, 3, 11), "c": (2, 0, 0, 7)}
    # Nobody lives in "c": its persons are split evenly, in whole numbers.
    assert sorted(r["PERxVIV"] for r in d.filter("CVEGEO = 'c'").collect()) == [3, 4]


def test_one_block_may_hold_nearly_everything(spark):
    _, d, _, p = chain(spark, [("a", 250_000, 3, 200_000, 210_000, 700_001), ("b", 1, 1, 1, 1, 2)])
    assert d.count() == 250_001 and p.count() == 700_003


def test_census_join_pads_and_casts(spark):
    keys = "CVE_ENT string, CVE_MUN string, CVE_LOC string, CVE_AGEB string, CVE_MZA string"
    blocks = spark.createDataFrame([("09", "002", "0001", "001A", "003"), ("09", "002", "0001", "001A", "004")], keys)
    census = spark.createDataFrame([("9", "2", "1", "1A", "3", "25", "*")], keys + ", POBTOT string, VIVPAR_HAB string")
    got = {r["CVE_MZA"]: (r["POBTOT"], r["VIVPAR_HAB"]) for r in frames.enrich_census(blocks, census, ["POBTOT", "VIVPAR_HAB"]).collect()}
    assert got == {"003": (25, 3), "004": (11, 3)}


def test_tiers_fall_back_and_are_reported(spark):
    rules = spark.createDataFrame([("A", "x", 10.0, 0.0), ("*", "x", 99.0, 0.0)], "tier string, column string, low double, span double")
    df = spark.createDataFrame([(1, "A"), (2, "Z"), (3, None)], "id int, tier string")
    got = {r["id"]: (r["x"], r["tier_matched"]) for r in frames.apply_tiers(df, rules, "tier", {"x": "int"}, lambda c: F.lit(0.5)).collect()}
    assert got[1] == (10, True) and got[2] == (99, False) and got[3][0] == 99 and not got[3][1]
    assert {(r["tier"], r["n"]) for r in frames.unmatched_tiers(df, rules, "tier").collect()} == {("Z", 1), (None, 1)}
