"""Queries of the scoring models."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cuadrante.functions import draws
from cuadrante.operators import network, relational, scoring
from cuadrante.plans.basics import md5_fraction
from cuadrante.plans.registry import query, rounded
from cuadrante.plans.tables import clients, history, table, with_
from cuadrante.session import pin

FEATURES = ["income", "expense", "avg_amount", "std_amount", "n_events"]


def training_frame(spark, d):
    """Clients with history features, their latest status and the two labels."""
    f = relational.history_features(
        history(spark, d), "client", "amount", event="event", latest={"status": ["ts", "event"]}
    )
    joined = clients(spark, d).join(f, "client")
    return joined.withColumns(
        {
            "late": (F.col("status") == "F").cast("double"),
            "minimum": (F.col("expense") > F.col("income")).cast("double"),
            "avg_amount": F.when(F.col("client") % 19 != 0, F.col("avg_amount")),
        }
    )


@query(
    "scaled_features",
    with_("clients")
    + """, s AS (SELECT avg(income) AS mi, stddev_samp(income) AS si, avg(expense) AS me, stddev_samp(expense) AS se FROM clients)
    SELECT client, round((income - mi) / si, 6) + 0.0 AS income, round((expense - me) / se, 6) + 0.0 AS expense FROM clients, s""",
)
def scaled_features(spark, d):
    out = scoring.scaled_features(clients(spark, d), ["income", "expense"])
    v = vector_to_array("features")
    return rounded(out.select("client", v[0].alias("income"), v[1].alias("expense")), 6, "income", "expense")


@query(
    "string_index",
    with_("clients")
    + """, n AS (SELECT tier, row_number() OVER (ORDER BY count(*) DESC, tier) - 1 AS i FROM clients GROUP BY tier)
    SELECT client, tier, i::DOUBLE AS tier_index FROM clients JOIN n USING (tier)""",
)
def string_index(spark, d):
    return scoring.string_index(clients(spark, d).select("client", "tier"), "tier")


@query(
    "string_index_many_labels",
    """WITH n AS (SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, l_partkey::VARCHAR) - 1 AS i FROM lineitem GROUP BY l_partkey),
    o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey::VARCHAR) - 1 AS j FROM orders)
    SELECT l_orderkey, l_linenumber, i::DOUBLE AS part_index, j::DOUBLE AS order_index
    FROM lineitem JOIN n USING (l_partkey) JOIN o ON o_orderkey = l_orderkey""",
)
def string_index_many_labels(spark, d):
    """Indices of two columns whose labels grow with the table, one from its own rows and
    one from the labels of another table."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = scoring.label_table(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    out = scoring.string_index(scoring.string_index(lines, "l_partkey", "part_index"), "l_orderkey", "order_index", orders)
    return out.select("l_orderkey", "l_linenumber", "part_index", "order_index")


@query(
    "confusion_table",
    f"""SELECT (o_orderstatus = 'F')::INT AS label, ({md5_fraction("o_orderkey", salt="c")} < 0.4)::INT AS prediction, count(*) AS n
    FROM orders GROUP BY 1, 2""",
)
def confusion_table(spark, d):
    guessed = table(spark, d, "orders").select(
        (F.col("o_orderstatus") == "F").cast("int").alias("late"), (draws.hash_fraction("o_orderkey", salt="c") < 0.4).cast("int").alias("guess")
    )
    return scoring.confusion_table(guessed, "late", "guess")


# The rows of training_frame: those whose average is known, and the side they fall on.
_TRAINING = with_("clients", "history") + f""", frame AS (SELECT clients.*, n_events, client % 19 <> 0 AS known, {md5_fraction("client", salt="split")} < 0.7 AS train
    FROM clients JOIN (SELECT client, count(*) AS n_events FROM history GROUP BY 1) USING (client))"""


@query(
    "feature_assembly",
    _TRAINING + " SELECT client, 5 AS n_features, round(income, 6) AS income, round(expense, 6) AS expense, n_events::DOUBLE AS n_events FROM frame WHERE known",
)
def feature_assembly(spark, d):
    out = scoring.features(training_frame(spark, d), FEATURES, "skip")
    v = vector_to_array("features")
    out = out.select("client", F.size(v).alias("n_features"), v[0].alias("income"), v[1].alias("expense"), v[4].alias("n_events"))
    return rounded(out, 6, "income", "expense")


@query(
    "segment",
    _TRAINING + " SELECT client, known AS has_segment, CASE WHEN known THEN true END AS in_range FROM frame",
)
def segment(spark, d):
    out = scoring.segment(training_frame(spark, d), FEATURES)
    return out.select("client", F.col("segment").isNotNull().alias("has_segment"), F.col("segment").between(0, 4).alias("in_range"))


@query(
    "hash_split",
    f"SELECT c_custkey, {md5_fraction("c_custkey", salt="split")} < 0.7 AS train FROM customer",
)
def hash_split(spark, d):
    train, held_out = scoring.hash_split(table(spark, d, "customer").select("c_custkey"), ["c_custkey"])
    return train.withColumn("train", F.lit(True)).unionByName(held_out.withColumn("train", F.lit(False)))


def _evaluated(spark, d, **configs):
    """Rows on each side of each model, and whether its measures are ones: shares, and an
    area under the curve unless there are several classes."""
    models = scoring.train_models(training_frame(spark, d), configs, ["client"])
    share = [F.col(c).between(0, 1) for c in ("weighted_precision", "weighted_recall", "weighted_f1")]
    frames = [
        m.metrics.select(
            F.lit(name).alias("model"), "n_train", "n_held_out", "n_quarantined", "n_rows",
            (reduce(lambda a, b: a & b, share) & (F.col("auc").isNull() if configs[name].multiclass else F.col("auc").between(0, 1))).alias("measured"),
        )
        for name, m in models.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _rows_of(model: str) -> str:
    return _TRAINING + f""" SELECT '{model}' AS model, count(*) FILTER (WHERE known AND train) AS n_train, count(*) FILTER (WHERE known AND NOT train) AS n_held_out,
    count(*) FILTER (WHERE NOT known) AS n_quarantined, count(*) FILTER (WHERE known AND NOT train) AS n_rows, true AS measured FROM frame"""


@query("train_logistic", _rows_of("logistic"))
def train_logistic(spark, d):
    return _evaluated(spark, d, logistic=scoring.ModelConfig("late", FEATURES, "logistic"))


@query("train_gbt", _rows_of("credit"))
def train_gbt(spark, d):
    return _evaluated(spark, d, credit=scoring.ModelConfig("late", FEATURES, "gbt"))


@query("train_xgboost_alias", _rows_of("liquidity"))
def train_xgboost_alias(spark, d):
    return _evaluated(spark, d, liquidity=scoring.ModelConfig("minimum", FEATURES, "xgboost"))


@query("train_random_forest", _rows_of("status"))
def train_random_forest(spark, d):
    return _evaluated(spark, d, status=scoring.ModelConfig("status", FEATURES, "random_forest", multiclass=True))


@query("train_mlp", _rows_of("network"))
def train_mlp(spark, d):
    return _evaluated(spark, d, network=scoring.ModelConfig("late", FEATURES, "mlp", params={"maxIter": 20}))


@query(
    "blended_models",
    _TRAINING
    + """ SELECT client, CASE WHEN known AND NOT train THEN true END AS in_range, CASE WHEN known AND NOT train THEN 'Score Integral Completo'
    ELSE 'Datos Insuficientes - Requiere Modelo Reducido' END AS routing FROM frame""",
)
def blended_models(spark, d):
    """Two models, their held-out probabilities blended over the full client list."""
    frame = training_frame(spark, d)
    models = scoring.train_models(
        frame,
        {
            "p_credit": scoring.ModelConfig("late", FEATURES, "logistic"),
            "p_liquidity": scoring.ModelConfig("minimum", FEATURES, "logistic"),
        },
        ["client"],
    )
    scores = {n: m.predictions.select("client", scoring.probability().alias(n)) for n, m in models.items()}
    out = scoring.blend_scores(frame, "client", scores)
    return out.select("client", F.col("score").between(0, 1).alias("in_range"), "routing")


@query(
    "train_network",
    f"""WITH l AS (SELECT {md5_fraction("l_orderkey", "l_linenumber", salt="split")} < 0.7 AS train FROM lineitem)
    SELECT count(*) FILTER (WHERE train) AS n_train, count(*) FILTER (WHERE NOT train) AS n_held_out, true AS above_floor, true AS probabilities FROM l""",
)
def train_network(spark, d):
    """The network trained by mini-batches in shards, on a label that is a product of its
    features: its area under the curve on held-out lines must be above 0.9."""
    paid = F.col("l_quantity") * (1 - F.col("l_discount"))
    lines = table(spark, d, "lineitem").withColumn("label", (paid > 20 + 100 * F.col("l_tax")).cast("double"))
    lines = lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "label")
    train, held_out = scoring.hash_split(lines, ["l_orderkey", "l_linenumber"])
    net = network.train_network(train, ["l_quantity", "l_discount", "l_tax"], "label", ["l_orderkey", "l_linenumber"])
    p = network.network_probability(net)
    scored = pin(held_out.select("label", p.alias("p"), (p >= 0.5).cast("double").alias("prediction")))
    measures = scoring.evaluate(scored, "label", "prediction", "p")
    sides = scored.agg(F.count(F.lit(1)).alias("n_held_out"), F.min(F.col("p").between(0, 1)).alias("probabilities"))
    return sides.select(
        F.lit(train.count()).cast("bigint").alias("n_train"), "n_held_out",
        F.lit(measures.first()["auc"] > 0.9).alias("above_floor"), "probabilities",
    )


_RULE = with_("history") + """, p AS (SELECT CASE status WHEN 'F' THEN 0.0 WHEN 'O' THEN 1.0 ELSE 2.0 END::DOUBLE AS a,
      CASE WHEN amount < 150000 THEN 0.0 WHEN amount < 350000 THEN 1.0 ELSE 2.0 END::DOUBLE AS p FROM history)"""


@query(
    "classification_metrics",
    _RULE
    + """, c AS (SELECT c, (SELECT count(*) FROM p WHERE a = c) AS nl, (SELECT count(*) FROM p WHERE p.p = c) AS np, (SELECT count(*) FROM p WHERE a = c AND p.p = c) AS hit
      FROM (SELECT DISTINCT a AS c FROM p)),
    m AS (SELECT *, hit / np AS pr, hit / nl AS re FROM c)
    SELECT sum(nl)::BIGINT AS n_rows, round(sum(pr * nl) / sum(nl), 8) AS weighted_precision, round(sum(re * nl) / sum(nl), 8) AS weighted_recall,
    round(sum(2 * pr * re / (pr + re) * nl) / sum(nl), 8) AS weighted_f1 FROM m""",
)
def classification_metrics(spark, d):
    h = history(spark, d)
    pred = h.select(
        F.when(F.col("status") == "F", 0.0).when(F.col("status") == "O", 1.0).otherwise(2.0).alias("label"),
        F.when(F.col("amount") < 150000, 0.0).when(F.col("amount") < 350000, 1.0).otherwise(2.0).alias("prediction"),
    )
    out = scoring.classification_metrics(pred, "label", "prediction")
    return rounded(out, 8, "weighted_precision", "weighted_recall", "weighted_f1")


@query(
    "score_blend",
    f"""WITH c AS (SELECT DISTINCT o_custkey AS client FROM orders), a AS (SELECT client, {md5_fraction("client", salt="c")} AS p FROM c WHERE client % 5 <> 0),
    b AS (SELECT client, {md5_fraction("client", salt="l")} AS p FROM c WHERE client % 7 <> 0)
    SELECT client, round(a.p * 0.6::DOUBLE + b.p * 0.4::DOUBLE, 8) AS score, CASE WHEN a.p IS NOT NULL AND b.p IS NOT NULL THEN 'Score Integral Completo'
    ELSE 'Datos Insuficientes - Requiere Modelo Reducido' END AS routing FROM c LEFT JOIN a USING (client) LEFT JOIN b USING (client)""",
)
def score_blend(spark, d):
    base = history(spark, d).select("client")
    once = base.distinct()
    credit = once.filter("client % 5 <> 0").withColumn("p_credit", draws.hash_fraction("client", salt="c"))
    liquid = once.filter("client % 7 <> 0").withColumn("p_liquidity", draws.hash_fraction("client", salt="l"))
    out = scoring.blend_scores(base, "client", {"p_credit": credit, "p_liquidity": liquid})
    return rounded(out.select("client", "score", "routing"), 8, "score")
