"""Queries of the domain: territory indices, frames, proximity and ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuadrante.functions import draws
from cuadrante.operators import clusters, density, frames, ledger, proximity, ranking, relational, territory
from cuadrante.operators.apportion import apportion_truncate, uncount
from cuadrante.plans.basics import md5_fraction
from cuadrante.plans.registry import ORACLES, query, rounded
from cuadrante.plans.tables import blocks, clients, establishments, history, lat_of, lon_of, payments, poles, table, with_

# --- territory --------------------------------------------------------------


@query(
    "territory_index",
    with_("clients", "history")
    + """, f AS (SELECT client, count(event) AS n_events FROM history GROUP BY client)
    SELECT cell, round(avg(n_events), 6) AS avg_label, round(avg(income), 4) AS cell_income, count(client) AS n_clients,
    round(avg(income) * count(client) / 1000, 4) AS potential FROM clients JOIN f USING (client) GROUP BY cell""",
)
def territory_index(spark, d):
    f = relational.history_features(history(spark, d), "client", "amount", event="event")
    joined = clients(spark, d).join(f, on="client", how="inner")
    out = territory.territory_index(joined, "cell", "income", "client", "n_events")
    return rounded(rounded(out, 6, "avg_label"), 4, "cell_income", "potential")


@query(
    "territory_enriched",
    with_("clients")
    + """, z AS (SELECT cell, avg(expense) AS l, avg(income) AS i, count(*) AS n FROM clients GROUP BY cell)
    SELECT client, cell, round(l, 4) AS avg_label, n AS n_clients, round(i * n / 1000, 4) AS potential FROM clients LEFT JOIN z USING (cell)""",
)
def territory_enriched(spark, d):
    out = territory.territory_enriched(clients(spark, d), "cell", "income", "client", "expense")
    return rounded(out.select("client", "cell", "avg_label", "n_clients", "potential"), 4, "avg_label", "potential")


@query(
    "zscore_territory",
    with_("clients")
    + """, s AS (SELECT avg(income) AS mi, stddev_samp(income) AS si, avg(expense) AS me, stddev_samp(expense) AS se FROM clients),
    z AS (SELECT cell, client, (income - mi) / si AS a, (expense - me) / se AS b FROM clients, s)
    SELECT cell, round(avg(a), 6) AS index_a, round(avg(b), 6) AS index_b, count(client) AS n_clients,
    round((avg(a) + avg(b)) / 2, 6) AS score FROM z GROUP BY cell""",
)
def zscore_territory(spark, d):
    out = territory.zscore_territory(clients(spark, d), "cell", "income", "expense", "client")
    return rounded(out, 6, "index_a", "index_b", "score")


@query(
    "entropy_by",
    with_("establishments")
    + """, b AS (SELECT cell, substr(code, 1, 4) AS c, sum(workers) AS w FROM establishments WHERE workers > 0 GROUP BY 1, 2),
    p AS (SELECT cell, w / sum(w) OVER (PARTITION BY cell) AS p FROM b)
    SELECT cell, round(-sum(p * ln(p)), 6) AS entropy FROM p GROUP BY cell""",
)
def entropy_by(spark, d):
    out = territory.entropy_by(establishments(spark, d), "cell", F.substring("code", 1, 4), "workers")
    return rounded(out, 6, "entropy")


_FRICTION = """, dens AS (SELECT cell, ln(count(*) + 1) AS ld FROM establishments GROUP BY cell),
    crowd AS (SELECT cell, 1 + 0.5::DOUBLE * (ld - (SELECT min(ld) FROM dens)) / ((SELECT max(ld) FROM dens) - (SELECT min(ld) FROM dens)) AS crowd FROM dens),
    raw AS (SELECT e.*, greatest(CASE WHEN workers IS NULL OR workers = 0 THEN 1.0::DOUBLE ELSE exp(-0.02::DOUBLE * workers) END, 0.05::DOUBLE) * crowd AS raw
      FROM establishments e JOIN crowd USING (cell)),
    fric AS (SELECT *, (raw - (SELECT min(raw) FROM raw)) / ((SELECT max(raw) FROM raw) - (SELECT min(raw) FROM raw)) AS friction FROM raw)"""


@query(
    "friction",
    with_("establishments")
    + _FRICTION
    + " SELECT cell, code, workers, wages, round(lat, 3) AS lat, round(friction, 6) AS friction FROM fric",
)
def friction(spark, d):
    out = territory.friction(establishments(spark, d))
    return rounded(rounded(out.select("cell", "code", "workers", "wages", "lat", "friction"), 3, "lat"), 6, "friction")


@query(
    "mixed_use",
    with_("establishments")
    + _FRICTION
    + """, s AS (SELECT cell, substr(code, 1, 2) AS s, count(*) AS n, avg(friction) AS f FROM fric GROUP BY 1, 2),
    m AS (SELECT cell, n / sum(n) OVER (PARTITION BY cell) AS share, f FROM s)
    SELECT cell, round((1 - sum(share * share)) * avg(f), 6) AS mixed_use FROM m GROUP BY cell""",
)
def mixed_use(spark, d):
    rows = territory.friction(establishments(spark, d))
    return rounded(territory.mixed_use(rows, "cell", F.substring("code", 1, 2), "friction"), 6, "mixed_use")


_CASH = """greatest((CASE WHEN substr(code, 1, 2) IN ('46', '72', '81') THEN 1.0::DOUBLE WHEN substr(code, 1, 2) IN ('43', '48', '49') THEN 0.5::DOUBLE
      WHEN substr(code, 1, 2) IN ('31', '32', '33', '51', '52', '55') THEN 0.1::DOUBLE ELSE 0.3::DOUBLE END) * exp(-0.01::DOUBLE * workers), 0.05::DOUBLE)"""
_ANCHOR = """CASE WHEN workers IS NULL OR workers = 0 THEN 0.0::DOUBLE WHEN workers >= 100 THEN 1.0::DOUBLE
      WHEN substr(code, 1, 3) = '462' AND workers >= 30 THEN 1.0::DOUBLE WHEN substr(code, 1, 3) IN ('611', '622') AND workers >= 50 THEN 1.0::DOUBLE
      WHEN substr(code, 1, 3) = '522' AND workers >= 20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"""
_FOAM = """CASE WHEN workers IS NULL OR workers = 0 THEN 1.0::DOUBLE
      WHEN workers <= 5 AND substr(code, 1, 2) IN ('46', '72', '81') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"""


@query(
    "cash_exposure",
    with_("establishments")
    + f" SELECT cell, code, workers, wages, CASE WHEN workers IS NOT NULL THEN round({_CASH}, 8) END AS is_cash FROM establishments",
)
def cash_exposure(spark, d):
    e = establishments(spark, d).select("cell", "code", "workers", "wages")
    return rounded(e.withColumn("is_cash", territory.cash_exposure()), 8, "is_cash")


@query(
    "anchor_foam",
    with_("establishments")
    + f" SELECT cell, code, workers, wages, {_ANCHOR} AS anchor, {_FOAM} AS foam FROM establishments",
)
def anchor_foam(spark, d):
    e = establishments(spark, d).select("cell", "code", "workers", "wages")
    return e.withColumns({"anchor": territory.anchor(), "foam": territory.foam()})


@query(
    "cell_master",
    with_("establishments")
    + _FRICTION
    + f""", flags AS (SELECT *, {_CASH} AS cash, {_ANCHOR} AS anchor, {_FOAM} AS foam FROM fric),
    b AS (SELECT cell, substr(code, 1, 4) AS c, sum(workers) AS w FROM fric WHERE workers > 0 GROUP BY 1, 2),
    p AS (SELECT cell, w / sum(w) OVER (PARTITION BY cell) AS p FROM b),
    ent AS (SELECT cell, -sum(p * ln(p)) AS entropy FROM p GROUP BY cell),
    s AS (SELECT cell, substr(code, 1, 2) AS s, count(*) AS n, avg(friction) AS f FROM fric GROUP BY 1, 2),
    m AS (SELECT cell, n / sum(n) OVER (PARTITION BY cell) AS share, f FROM s),
    mix AS (SELECT cell, (1 - sum(share * share)) * avg(f) AS mixed FROM m GROUP BY cell),
    t AS (SELECT cell, coalesce(sum(workers), 0) AS w, coalesce(sum(wages), 0) AS wages, 1 - count(*) FILTER (WHERE workers > 0) / count(*) AS zombie,
      sum(cash * workers) / sum(workers + 1e-9::DOUBLE) AS cash, sum(workers * anchor) AS a, sum(workers * foam) AS f,
      sum(lat * workers) / sum(workers + 1e-9::DOUBLE) AS lat, sum(lon * workers) / sum(workers + 1e-9::DOUBLE) AS lon,
      sum(friction * workers) / sum(workers + 1e-9::DOUBLE) AS fr FROM flags GROUP BY cell)
    SELECT cell, round(w::DOUBLE, 2) AS floating_population, round(wages, 2) AS wage_mass, round(zombie, 6) AS zombie_rate,
    round(cash, 6) AS cash_vulnerability, round(lat, 5) AS lat_pole, round(lon, 5) AS lon_pole, round(log10(1 + wages) * 0.05::DOUBLE, 6) AS pole_weight,
    round(coalesce(fr, 0), 6) AS pole_friction, round(ln(1 + CASE WHEN f = 0 THEN a ELSE a / f END), 6) AS resilience,
    round(coalesce(entropy, 0), 6) AS entropy, round(coalesce(mixed, 0), 6) AS mixed_use
    FROM t LEFT JOIN ent USING (cell) LEFT JOIN mix USING (cell) WHERE cell IS NOT NULL AND coalesce(entropy, 0) > 0 AND w > 0""",
)
def cell_master(spark, d):
    out = territory.cell_master(establishments(spark, d))
    out = rounded(out, 2, "floating_population", "wage_mass")
    out = rounded(out, 5, "lat_pole", "lon_pole")
    return rounded(
        out, 6, "zombie_rate", "cash_vulnerability", "pole_weight", "pole_friction", "resilience", "entropy", "mixed_use"
    )


# --- tiers and lots ---------------------------------------------------------

# Rules of the test tiers: (tier, column, low, span); "*" serves other tiers.
TIER_RULES = [
    ("BUILDING", "dependants", 0.0, 6.0),
    ("BUILDING", "wealth", 0.0, 500000.0),
    ("BUILDING", "first_score", 300.0, 100.0),
    ("MACHINERY", "dependants", 0.0, 5.0),
    ("MACHINERY", "wealth", 0.0, 1000000.0),
    ("MACHINERY", "first_score", 400.0, 200.0),
    ("*", "dependants", 0.0, 2.0),
    ("*", "wealth", 0.0, 5000000.0),
    ("*", "first_score", 450.0, 500.0),
]


def md5_fraction_col(key: str, salt: str) -> str:
    """As ``md5_fraction`` with the salt from a column."""
    return md5_fraction(key, salt="' || " + salt + " || '")


_RULES_SQL = ", ".join(f"('{t}', '{c}', {lo}::DOUBLE, {sp}::DOUBLE)" for t, c, lo, sp in TIER_RULES)


@query(
    "apply_tiers",
    with_("clients")
    + f""", rules(tier, col, low, span) AS (VALUES {_RULES_SQL}),
    k AS (SELECT client, tier, tier IN (SELECT tier FROM rules WHERE tier <> '*') AS hit FROM clients),
    v AS (SELECT client, k.tier, hit, col, low + span * {md5_fraction_col("client", "col")} AS x
      FROM k JOIN rules ON rules.tier = CASE WHEN hit THEN k.tier ELSE '*' END)
    SELECT client, tier, floor(max(x) FILTER (WHERE col = 'dependants'))::INT AS dependants, round(max(x) FILTER (WHERE col = 'wealth'), 4) AS wealth,
    round(max(x) FILTER (WHERE col = 'first_score'), 6) AS first_score, hit AS tier_matched FROM v GROUP BY client, tier, hit""",
)
def apply_tiers(spark, d):
    rules = spark.createDataFrame(TIER_RULES, "tier string, column string, low double, span double")
    out = frames.apply_tiers(
        clients(spark, d).select("client", "tier"),
        rules,
        "tier",
        {"dependants": "int", "wealth": "double", "first_score": "double"},
        lambda name: draws.hash_fraction("client", salt=name),
    )
    return rounded(rounded(out, 4, "wealth"), 6, "first_score")


@query(
    "unmatched_tiers",
    with_("clients")
    + """ SELECT tier, count(*) AS n FROM clients WHERE tier NOT IN ('BUILDING', 'MACHINERY') GROUP BY tier""",
)
def unmatched_tiers(spark, d):
    rules = spark.createDataFrame(TIER_RULES, "tier string, column string, low double, span double")
    return frames.unmatched_tiers(clients(spark, d), rules, "tier")


@query(
    "client_lot",
    """WITH w AS (SELECT c_nationkey AS segment, count(*) AS n FROM customer GROUP BY 1),
    q AS (SELECT segment, n, floor((SELECT count(*) FROM orders) * (n / (SELECT sum(n) FROM w)::DOUBLE))::BIGINT AS quota FROM w)
    SELECT segment, n AS members, quota, unnest(range(1, quota + 1)) AS place FROM q WHERE quota > 0""",
)
def client_lot(spark, d):
    """Places of each segment's lot, in proportion to the segment's customers."""
    weights = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    total = table(spark, d, "orders").agg(F.count(F.lit(1)).alias("n")).scalar()
    segments = apportion_truncate(weights, total, "n")
    return uncount(segments, "quota", "place", spread=True).select("segment", F.col("n").alias("members"), "quota", "place")


# --- population frames ------------------------------------------------------

_DWELLINGS = """, d AS (SELECT block, CVEGEO, VIVTOT, VIVPAR_HAB, CASE WHEN VIVPAR_HAB > 0 THEN TOTHOG ELSE 0 END AS TOTHOG, POBTOT, unnest(range(1, VIVTOT + 1)) AS i FROM blocks WHERE VIVTOT > 0),
    h AS (SELECT *, (i <= VIVPAR_HAB)::INT + (i <= TOTHOG - VIVPAR_HAB)::INT AS hog FROM d),
    b AS (SELECT *, sum(hog) OVER w AS homes, CASE WHEN sum(hog) OVER w > 0 THEN floor(POBTOT::DOUBLE * hog / sum(hog) OVER w)
      ELSE floor(POBTOT / VIVTOT::DOUBLE) END::BIGINT AS base FROM h WINDOW w AS (PARTITION BY block)),
    viv AS (SELECT CVEGEO, lpad(i::VARCHAR, 6, '0') AS ID_DOMICILIO, CASE WHEN i <= VIVPAR_HAB THEN i ELSE 0 END::INT AS ID_VPH, hog AS HOGxVPH,
      (base + CASE WHEN i <= POBTOT - sum(base) OVER (PARTITION BY block) THEN 1 ELSE 0 END)::BIGINT AS PERxVIV FROM b)"""
_HOUSEHOLDS = """, hh AS (SELECT CVEGEO, ID_DOMICILIO, ID_VPH, PERxVIV, HOGxVPH, unnest(range(1, HOGxVPH + 1)) AS k FROM viv WHERE ID_VPH > 0 AND HOGxVPH > 0),
    hog AS (SELECT CVEGEO, ID_DOMICILIO, ID_VPH, lpad(k::VARCHAR, 3, '0') AS ID_HOGAR,
      (PERxVIV // HOGxVPH + CASE WHEN k <= PERxVIV % HOGxVPH THEN 1 ELSE 0 END)::BIGINT AS PERxHOG FROM hh)"""


def _dwellings(spark, d):
    return frames.dwelling_frame(frames.clean_blocks(blocks(spark, d)), ["CVEGEO"])


@query("dwelling_frame", with_("blocks") + _DWELLINGS + " SELECT * FROM viv")
def dwelling_frame(spark, d):
    return _dwellings(spark, d)


@query("household_frame", with_("blocks") + _DWELLINGS + _HOUSEHOLDS + " SELECT * FROM hog")
def household_frame(spark, d):
    return frames.household_frame(_dwellings(spark, d), ["CVEGEO"])


@query(
    "person_frame",
    with_("blocks")
    + _DWELLINGS
    + _HOUSEHOLDS
    + """, p AS (SELECT CVEGEO, ID_DOMICILIO, ID_VPH, ID_HOGAR, unnest(range(1, PERxHOG + 1)) AS k FROM hog)
    SELECT CVEGEO, ID_DOMICILIO, ID_VPH, ID_HOGAR, lpad(k::VARCHAR, 3, '0') AS ID_PER FROM p""",
)
def person_frame(spark, d):
    return frames.person_frame(frames.household_frame(_dwellings(spark, d), ["CVEGEO"]), ["CVEGEO"])


@query(
    "persons_add_up",
    with_("blocks") + " SELECT CVEGEO, sum(POBTOT)::BIGINT AS persons FROM blocks WHERE VIVTOT > 0 GROUP BY CVEGEO HAVING sum(POBTOT) > 0",
)
def persons_add_up(spark, d):
    """Persons of households and those without one are the census count of each key."""
    dwellings = _dwellings(spark, d)
    housed = frames.person_frame(frames.household_frame(dwellings, ["CVEGEO"]), ["CVEGEO"]).select("CVEGEO")
    everyone = housed.unionByName(frames.unhoused_frame(dwellings, ["CVEGEO"]).select("CVEGEO"))
    return everyone.groupBy("CVEGEO").agg(F.count(F.lit(1)).alias("persons"))


@query(
    "enrich_census",
    """WITH b AS (SELECT p_partkey AS block, lpad((p_partkey % 32 + 1)::VARCHAR, 2, '0') AS ent, lpad((p_partkey % 125)::VARCHAR, 3, '0') AS mun FROM part),
    c AS (SELECT p_partkey AS k, TRY_CAST(CASE WHEN p_partkey % 17 = 0 THEN '*' ELSE (p_size * 3)::VARCHAR END AS INT) AS pob,
      TRY_CAST(CASE WHEN p_partkey % 13 = 0 THEN '*' ELSE p_size::VARCHAR END AS INT) AS viv FROM part WHERE p_partkey % 4 <> 0)
    SELECT block, ent AS CVE_ENT, mun AS CVE_MUN, coalesce(pob, 11) AS POBTOT, coalesce(viv, 3) AS VIVPAR_HAB FROM b LEFT JOIN c ON block = k""",
)
def enrich_census(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey")
    raw_keys = {
        "CVE_ENT": (k % 32 + 1).cast("string"),
        "CVE_MUN": (k % 125).cast("string"),
        "CVE_LOC": F.floor(k / 10000).cast("string"),
        "CVE_AGEB": (k % 10000).cast("string"),
        "CVE_MZA": (k % 7).cast("string"),
    }
    b = frames.pad_keys(p.select(k.alias("block"), *[c.alias(n) for n, c in raw_keys.items()]))
    census = p.filter(k % 4 != 0).select(
        *[c.alias(n) for n, c in raw_keys.items()],
        F.when(k % 17 == 0, "*").otherwise((F.col("p_size") * 3).cast("string")).alias("POBTOT"),
        F.when(k % 13 == 0, "*").otherwise(F.col("p_size").cast("string")).alias("VIVPAR_HAB"),
    )
    out = frames.enrich_census(b, census, ["POBTOT", "VIVPAR_HAB"])
    return out.select("block", "CVE_ENT", "CVE_MUN", "POBTOT", "VIVPAR_HAB")


# --- proximity --------------------------------------------------------------

_PAIRS = """, pairs AS (SELECT client, income, expense, p.pole_id, w, f, round(6371.0::DOUBLE * acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE,
      sin(radians(lat)) * sin(radians(pole_lat)) + cos(radians(lat)) * cos(radians(pole_lat)) * cos(radians(pole_lon) - radians(lon))))), 6) AS km
    FROM clients, poles p), ranked AS (SELECT *, row_number() OVER (PARTITION BY client ORDER BY km, pole_id) AS rn FROM pairs)"""


@query(
    "nearest_k",
    with_("clients", "poles") + _PAIRS + " SELECT client, rn::INT AS place, pole_id, round(km, 3) AS km FROM ranked WHERE rn <= 3",
)
def nearest_k(spark, d):
    found = proximity.nearest_k(clients(spark, d).select("client", "lat", "lon"), poles(spark, d), 3)
    out = found.select("client", F.posexplode("nearest").alias("place", "p"))
    return out.select(
        "client", (F.col("place") + 1).alias("place"), F.col("p.id").alias("pole_id"), F.round("p.d", 3).alias("km")
    )


_FAR = """, fc AS (SELECT client, CASE WHEN client % 11 = 0 THEN NULL WHEN client % 13 = 0 THEN 97.5::DOUBLE ELSE lat END AS lat,
      CASE WHEN client % 17 = 0 THEN NULL ELSE lon + 360 * (client % 3 - 1) END::DOUBLE AS lon FROM clients),
    fp AS (SELECT pole_id, CASE WHEN pole_id % 7 = 0 THEN NULL WHEN pole_id % 5 = 0 THEN -120.0::DOUBLE ELSE pole_lat END AS pole_lat,
      (pole_lon + 360 * (pole_id % 3 - 1))::DOUBLE AS pole_lon FROM poles),
    fr AS (SELECT client, pole_id, round(6371.0::DOUBLE * acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE,
      sin(radians(lat)) * sin(radians(pole_lat)) + cos(radians(lat)) * cos(radians(pole_lat)) * cos(radians(pole_lon) - radians(lon))))), 6) AS km
      FROM fc, fp WHERE lat BETWEEN -90 AND 90 AND pole_lat BETWEEN -90 AND 90 AND lon IS NOT NULL)"""


@query(
    "nearest_k_around",
    with_("clients", "poles")
    + _FAR
    + """, fk AS (SELECT client, km, row_number() OVER (PARTITION BY client ORDER BY km) AS rn FROM fr)
    SELECT fc.client, rn::INT AS place, round(km, 3) AS km FROM fc LEFT JOIN fk ON fk.client = fc.client AND rn <= 3""",
)
def nearest_k_around(spark, d):
    """Longitudes beyond 180 degrees, and points and poles without a place."""
    c, p = F.col("client"), F.col("pole_id")
    points = clients(spark, d).select(
        "client",
        F.when(c % 11 == 0, None).when(c % 13 == 0, 97.5).otherwise(F.col("lat")).alias("lat"),
        F.when(c % 17 == 0, None).otherwise(F.col("lon") + 360 * (c % 3 - 1)).alias("lon"),
    )
    far = poles(spark, d).select(
        "pole_id",
        F.when(p % 7 == 0, None).when(p % 5 == 0, -120.0).otherwise(F.col("pole_lat")).alias("pole_lat"),
        (F.col("pole_lon") + 360 * (p % 3 - 1)).alias("pole_lon"),
    )
    out = proximity.nearest_k(points, far, 3).select("client", F.posexplode_outer("nearest").alias("place", "p"))
    return out.select("client", (F.col("place") + 1).alias("place"), F.round("p.d", 3).alias("km"))


@query(
    "assign_nearest",
    with_("clients", "poles")
    + _PAIRS
    + """ SELECT c.client, pole_id AS seed_id, round(km, 3) AS seed_km FROM clients c
    LEFT JOIN ranked r ON c.client = r.client AND rn = 1 AND km <= 120""",
)
def assign_nearest(spark, d):
    seeds = poles(spark, d).select(
        F.col("pole_id").alias("seed_id"), F.col("pole_lat").alias("seed_lat"), F.col("pole_lon").alias("seed_lon")
    )
    points = clients(spark, d).select("client", "lat", "lon")
    out = proximity.assign_nearest(points, seeds, 120.0)
    return rounded(out.select("client", "seed_id", "seed_km"), 3, "seed_km")


@query(
    "gravity_uplift",
    with_("clients", "poles")
    + _PAIRS
    + """, u AS (SELECT client, income, expense, sum(w / pow(1 + km, f)) AS u FROM ranked WHERE rn <= 3 GROUP BY ALL)
    SELECT client, round(u, 6) AS uplift, round(income * (1 + u), 2) AS income, round(expense * (1 + u), 2) AS expense FROM u""",
)
def gravity_uplift(spark, d):
    points = clients(spark, d).select("client", "income", "expense", "lat", "lon")
    out = proximity.gravity_uplift(points, poles(spark, d), 3, ["income", "expense"])
    return rounded(out.select("client", "uplift", "income", "expense"), 6, "uplift")


# --- accounts ---------------------------------------------------------------


_ELIGIBLE = with_("clients") + f""", pr(product, annual_rate, term, limit_multiple, kind) AS (VALUES ('Nomina', 0.22::DOUBLE, 24, 1.5::DOUBLE, 'fijo'),
      ('Personal', 0.38::DOUBLE, 36, 2.2::DOUBLE, 'fijo'), ('TDC_1', 0.55::DOUBLE, 12, 0.9::DOUBLE, 'revolvente'), ('TDC_2', 0.75::DOUBLE, 12, 1.4::DOUBLE, 'revolvente')),
    el AS (SELECT client, income, pr.* FROM clients, pr WHERE {md5_fraction("client", "product", salt="")} < CASE WHEN income > 12000 THEN 0.45 ELSE 0.18 END)"""


@query("eligible_products", _ELIGIBLE + " SELECT client, product, term, kind FROM el")
def eligible_products(spark, d):
    pairs = relational.cross_grid(clients(spark, d).select("client", "income"), ledger.PRODUCTS, 1)
    return ledger.eligible(pairs, ["client", "product"]).select("client", "product", "term", "kind")


@query(
    "account_grid",
    _ELIGIBLE
    + """ SELECT client, product, m::INT AS period, (DATE '2020-01-01' + to_months(m::INT))::DATE AS month,
    round(income * limit_multiple, 4) AS opening FROM el, (SELECT unnest(range(1, 49)) AS m)""",
)
def account_grid(spark, d):
    grid = ledger.account_grid(clients(spark, d).select("client", "income"), "client", "income")
    return rounded(grid.select("client", "product", "period", "month", "opening"), 4, "opening")


_MONTHS = """, m AS (SELECT account, period, sum(payment) AS payment, sum(charge) AS charge, max(opening) AS opening, max(rate) AS rate,
      max(term) AS term, max(kind) AS kind, max(income) AS income, max(score) AS score FROM payments GROUP BY account, period),
    n AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY period) AS k FROM m)"""


@query(
    "ledger_fold",
    with_("payments", recursive=True)
    + _MONTHS
    + """, z AS (SELECT *, CASE WHEN kind = 'fijo' THEN opening * rate / (1 - pow(1 + rate, -term)) ELSE 0 END AS quota FROM n),
    -- one row per account: the state after month k
    st(account, k, period, balance, arrears, overdue, score, paid) AS (
      SELECT account, 0::BIGINT, 0::BIGINT, opening, 0, 0.0::DOUBLE, score, 0.0::DOUBLE FROM z WHERE k = 1
      UNION ALL
      SELECT account, k, period, greatest(0.0::DOUBLE, balance + balance * rate + CASE WHEN days > 0 THEN 350.0::DOUBLE ELSE 0.0::DOUBLE END + charge - paid), days,
        CASE WHEN made THEN CASE WHEN paid >= due THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, due - paid) END WHEN balance > 0 THEN due ELSE overdue END,
        CASE WHEN made THEN least(850.0::DOUBLE, score + 2.0::DOUBLE) WHEN balance > 0 THEN greatest(300.0::DOUBLE, score - (arrears + 30) / 4.0::DOUBLE) ELSE score END, paid
      FROM (SELECT *, CASE WHEN made AND paid >= due THEN greatest(0, arrears - 30) WHEN NOT made AND balance > 0 THEN arrears + 30 ELSE arrears END AS days
        FROM (SELECT *, CASE WHEN made THEN least(payment, least(balance * (1 + rate), due, income * 0.45::DOUBLE)) ELSE 0.0::DOUBLE END AS paid
          FROM (SELECT z.account, z.k, z.period, s.balance, s.arrears, s.overdue, s.score, z.payment, z.charge, z.rate, z.income,
              z.payment > 0 AND s.balance > 0 AS made,
              CASE WHEN z.kind = 'fijo' THEN z.quota + s.overdue * (1 + z.rate * 1.5::DOUBLE)
                WHEN s.balance > 0 THEN s.balance * z.rate + s.balance * 0.0125::DOUBLE ELSE 0.0::DOUBLE END AS due
            FROM st s JOIN z ON z.account = s.account AND z.k = s.k + 1))))
    SELECT st.account, st.period, round(balance + 1e-6::DOUBLE, 4) AS balance, round(paid + 1e-6::DOUBLE, 4) AS payment, arrears,
    CASE WHEN arrears >= 90 THEN 'Cobranza' WHEN balance <= 0 THEN 'Liquidado' ELSE 'Vigente' END AS status, round(st.score, 2) AS score,
    CASE WHEN balance <= 0 THEN 0 WHEN paid <= balance * z.rate THEN 99
      ELSE least(99, ceil(ln(paid / (paid - balance * z.rate)) / ln(1 + z.rate)))::INT END AS months_left
    FROM st JOIN z ON z.account = st.account AND z.k = st.k WHERE st.k > 0""",
)
def ledger_fold(spark, d):
    out = ledger.ledger_fold(payments(spark, d), ["account"])
    return rounded(rounded(out, 4, "balance", "payment", shift=1e-6), 2, "score")


def _goes_on(spark, d):
    """The ledger in three goes: early months, later months, and months that come late."""
    every = payments(spark, d)
    late = (F.col("account") % 5 == 0) & (F.col("period") % 7 == 0)
    early = F.col("period") <= 50
    book = ledger.ledger_append(every.filter(early & ~late), ["account"])
    book = ledger.ledger_append(every.filter(~early & ~late), ["account"], book)
    return ledger.ledger_append(every.filter(late), ["account"], book)


@query("ledger_goes_on", ORACLES["ledger_fold"])
def ledger_goes_on(spark, d):
    return rounded(rounded(_goes_on(spark, d).rows, 4, "balance", "payment", shift=1e-6), 2, "score")


@query(
    "renewal_ledger",
    with_("payments", recursive=True)
    + """, t AS (SELECT account % 1000 AS client, account::VARCHAR AS product, period, payment, charge, opening, rate, kind, score, l_returnflag, line_days FROM payments),
    m AS (SELECT client, product, period, sum(payment) AS payment, sum(charge) AS charge, max(opening) AS opening, max(rate) AS rate, max(kind) AS kind, max(score) AS score,
      max(CASE WHEN l_returnflag = 'R' THEN line_days ELSE 0 END) AS delay, max(CASE WHEN line_days = 105 THEN 1 ELSE 0 END) AS renew FROM t GROUP BY 1, 2, 3),
    n AS (SELECT *, 4 AS term, row_number() OVER (PARTITION BY client ORDER BY product, period) AS k FROM m),
    st(client, k, product, period, balance, arrears, term_left, renewals, ended, score, payment, delay, status, shown) AS (
      SELECT client, 0::BIGINT, NULL::VARCHAR, 0::BIGINT, 0.0::DOUBLE, 0, 0, 0, false, 600.0::DOUBLE, 0.0::DOUBLE, 0, '', false FROM n WHERE k = 1
      UNION ALL
      SELECT client, k, product, period, CASE WHEN ended THEN balance WHEN renewed THEN rest + opening * 0.8::DOUBLE ELSE rest END,
        CASE WHEN ended THEN arrears0 ELSE arrears END, CASE WHEN ended THEN term0 WHEN renewed THEN term ELSE left_ END,
        CASE WHEN ended THEN renewals0 ELSE renewals0 + renewed::INT END,
        CASE WHEN ended THEN true ELSE CASE WHEN renewed THEN rest + opening * 0.8::DOUBLE ELSE rest END <= 0 AND kind = 'fijo' AND NOT renewed END,
        CASE WHEN ended THEN score0 ELSE score END, paid, delay, CASE WHEN renewed THEN 'Renovado' WHEN cur THEN 'Vigente' ELSE 'Cobranza' END, NOT ended
      FROM (SELECT *, cur AND kind = 'fijo' AND (left_ = 0 OR renew > 0) AND rest < opening * 0.3::DOUBLE AS renewed
        FROM (SELECT *, CASE WHEN cur THEN greatest(0.0::DOUBLE, balance + CASE WHEN kind = 'revolvente' THEN charge ELSE 0.0::DOUBLE END + balance * rate - paid)
              ELSE balance + balance * 0.05::DOUBLE - paid END AS rest,
            CASE WHEN cur AND kind = 'revolvente' AND charge > 0 THEN term ELSE greatest(0, term0 - 1) END AS left_
          FROM (SELECT *, arrears < 90 AS cur, CASE WHEN arrears < 90 AND delay >= 30 THEN 0.0::DOUBLE ELSE payment END AS paid
            FROM (SELECT *, CASE WHEN delay > 0 THEN greatest(arrears0, delay) ELSE greatest(0, arrears0 - 30) END AS arrears,
                greatest(300.0::DOUBLE, least(850.0::DOUBLE, CASE WHEN delay > 0 THEN score0 - delay / 3.0::DOUBLE ELSE score0 + 2.0::DOUBLE END)) AS score
              FROM (SELECT n.client, n.k, n.product, n.period, n.payment, n.charge, n.opening, n.rate, n.term, n.kind, n.delay, n.renew,
                  CASE WHEN s.product IS DISTINCT FROM n.product THEN n.opening ELSE s.balance END AS balance,
                  CASE WHEN s.product IS DISTINCT FROM n.product THEN 0 ELSE s.arrears END AS arrears0,
                  CASE WHEN s.product IS DISTINCT FROM n.product THEN n.term ELSE s.term_left END AS term0,
                  CASE WHEN s.product IS DISTINCT FROM n.product THEN 0 ELSE s.renewals END AS renewals0,
                  CASE WHEN s.product IS DISTINCT FROM n.product THEN false ELSE s.ended END AS ended, s.score AS score0
                FROM st s JOIN n ON n.client = s.client AND n.k = s.k + 1))))))
    SELECT client, product, period, term_left, round(balance + 1e-6::DOUBLE, 4) AS balance, round(payment + 1e-6::DOUBLE, 4) AS payment, delay, status,
    round(score)::BIGINT AS score, renewals FROM st WHERE shown""",
)
def renewal_ledger(spark, d):
    p = payments(spark, d)
    late = F.col("l_returnflag") == "R"
    txns = p.select(
        (F.col("account") % 1000).alias("client"),
        F.col("account").cast("string").alias("product"),
        "period", "payment", "charge", "opening", "rate", "kind", "score",
        F.lit(4).alias("term"),
        F.when(late, F.col("line_days")).otherwise(0).alias("delay"),
        F.when(F.col("line_days") == 105, 1).otherwise(0).alias("renew"),
    )
    return rounded(ledger.renewal_ledger(txns, "client"), 4, "balance", "payment", shift=1e-6)


# --- density clusters -------------------------------------------------------


def _clusters_sql(eps: float, min_pts: int, min_size: int) -> str:
    return (
        with_("clients", recursive=True)
        + f""", p AS (SELECT client AS k, lon AS x, lat AS y FROM clients),
    nb AS (SELECT a.k AS a, b.k AS b FROM p a JOIN p b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {eps}::DOUBLE * {eps}::DOUBLE),
    core AS (SELECT a AS k FROM nb GROUP BY a HAVING count(*) >= {min_pts}),
    ce AS (SELECT a, b FROM nb WHERE a IN (SELECT k FROM core) AND b IN (SELECT k FROM core)),
    reach(a, b) AS (SELECT k, k FROM core UNION SELECT r.a, ce.b FROM reach r JOIN ce ON r.b = ce.a),
    lab AS (SELECT a AS k, min(b) AS label FROM reach GROUP BY a),
    fin AS (SELECT * FROM lab UNION ALL SELECT nb.a, min(label) FROM nb JOIN lab ON nb.b = lab.k WHERE nb.a NOT IN (SELECT k FROM core) GROUP BY nb.a),
    big AS (SELECT label, row_number() OVER (ORDER BY label) AS id FROM fin GROUP BY label HAVING count(*) >= {min_size})"""
    )


@query(
    "density_clusters",
    _clusters_sql(0.6, 5, 8)
    + " SELECT p.k AS client, coalesce(id, 0)::BIGINT AS cluster FROM p LEFT JOIN fin ON p.k = fin.k LEFT JOIN big USING (label)",
)
def density_clusters(spark, d):
    points = clients(spark, d).select("client", F.col("lon").alias("x"), F.col("lat").alias("y"))
    return clusters.density_clusters(points, "client", "x", "y", 0.6, 5, 8).select("client", "cluster")


@query(
    "cluster_summary",
    _clusters_sql(0.9, 8, 20)
    + """, r AS (SELECT coalesce(id, 0) AS c FROM p LEFT JOIN fin ON p.k = fin.k LEFT JOIN big USING (label))
    SELECT count(DISTINCT CASE WHEN c > 0 THEN c END) AS n_clusters, count(*) FILTER (WHERE c > 0) AS n_clustered,
    count(*) FILTER (WHERE c = 0) AS n_noise FROM r""",
)
def cluster_summary(spark, d):
    points = clients(spark, d).select("client", F.col("lon").alias("x"), F.col("lat").alias("y"))
    return clusters.cluster_summary(clusters.density_clusters(points, "client", "x", "y", 0.9, 8, 20))


LEVELS = [density.Level("micro", 15, 5, 0.75), density.Level("macro", 200, 20, 1.6)]


def _level_sql(v: density.Level) -> str:
    """Numbers of the clusters of points whose core distance is within the cut."""
    near = f"(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {v.cut}::DOUBLE * {v.cut}::DOUBLE"
    n = v.name
    return f"""{n}_core AS (SELECT a.k, a.x, a.y FROM p a JOIN p b ON {near} GROUP BY ALL HAVING count(*) >= {v.min_pts}),
    {n}_edge AS (SELECT a.k AS a, b.k AS b FROM {n}_core a JOIN {n}_core b ON {near}),
    {n}_reach(a, b) AS (SELECT k, k FROM {n}_core UNION SELECT r.a, e.b FROM {n}_reach r JOIN {n}_edge e ON r.b = e.a),
    {n}_label AS (SELECT a AS k, min(b) AS label FROM {n}_reach GROUP BY a),
    {n}_number AS (SELECT label, row_number() OVER (ORDER BY label) AS {n} FROM {n}_label GROUP BY label HAVING count(*) >= {v.min_size})"""


@query(
    "density_levels",
    with_("clients", recursive=True)
    + ", p AS (SELECT client AS k, lon AS x, lat AS y FROM clients), "
    + ", ".join(map(_level_sql, LEVELS))
    + """ SELECT p.k AS client, coalesce(micro, 0)::BIGINT AS micro, coalesce(macro, 0)::BIGINT AS macro FROM p
    LEFT JOIN micro_label i ON i.k = p.k LEFT JOIN micro_number ON micro_number.label = i.label
    LEFT JOIN macro_label a ON a.k = p.k LEFT JOIN macro_number ON macro_number.label = a.label""",
)
def density_levels(spark, d):
    """Micro and macro clusters of the clients side by side, cut from one graph."""
    points = clients(spark, d).select("client", F.col("lon").alias("x"), F.col("lat").alias("y"))
    return density.density_levels(points, "client", "x", "y", LEVELS).select("client", "micro", "macro")


@query(
    "core_distances",
    with_("clients")
    + """, p AS (SELECT client, lon AS x, lat AS y FROM clients),
    r AS (SELECT a.client, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2,
          row_number() OVER (PARTITION BY a.client ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS rn FROM p a, p b)
    SELECT client, max(CASE WHEN rn = 5 AND d2 <= 2.5::DOUBLE * 2.5::DOUBLE THEN round(sqrt(d2), 9) END) AS core_5,
      max(CASE WHEN rn = 20 AND d2 <= 2.5::DOUBLE * 2.5::DOUBLE THEN round(sqrt(d2), 9) END) AS core_20 FROM r WHERE rn <= 20 GROUP BY client""",
)
def core_distances(spark, d):
    """The distance of each client to the fifth and the twentieth nearest one, within a reach."""
    points = clients(spark, d).select("client", F.col("lon").alias("x"), F.col("lat").alias("y"))
    places, _ = density.reach_graph(points, "client", "x", "y", [5, 20], 2.5)
    at = points.join(places.select("x", "y", "core2_5", "core2_20").hint("merge"), ["x", "y"])
    return at.select("client", *[F.round(F.sqrt(f"core2_{k}"), 9).alias(f"core_{k}") for k in (5, 20)])
