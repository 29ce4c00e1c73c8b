"""Properties of the physical plans that the operators count on at scale."""

import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as contract
from cuadrante.operators import frames, ranking, relational, territory
from cuadrante.plans.tables import blocks, clients, establishments, table

QUERIES = contract.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def shuffles(df) -> int:
    return len(re.findall(r"^\s*(?:[:+\-| ]*)Exchange \(", plan(df), re.M))


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["scan_parquet"](spark, SF_SMALL))
    assert "LessThan(l_quantity,5.0)" in text
    assert "l_comment" not in text and "l_extendedprice" not in text.split("ReadSchema")[1].splitlines()[0]


@pytest.mark.parametrize(
    "name",
    ["project_rename", "range_grid", "month_grid", "account_grid", "eligible_products", "bulk_try_cast", "noise", "hash_split"],
)
def test_row_local_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, SF_SMALL))


def test_population_frames_shuffle_only_the_chunks(spark):
    d = frames.dwelling_frame(frames.clean_blocks(blocks(spark, SF_SMALL)), ["CVEGEO"])
    people = frames.person_frame(frames.household_frame(d, ["CVEGEO"]), ["CVEGEO"])
    assert shuffles(people) == 1


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if n.startswith(("train", "blended", "stream", "dead"))}))
def test_no_query_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_window_without_partitions_over_rows(spark):
    o = table(spark, SF_SMALL, "orders").select("o_orderkey")
    text = plan(ranking.sequential_id(o, "o_orderkey"))
    # The one window sits over the counts per range, above an aggregate.
    assert text.count("Window (") <= 1 and "HashAggregate" in text


def test_top_k_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["top_k_per_group"](spark, SF_SMALL))


def test_aggregates_hash(spark):
    e = establishments(spark, SF_SMALL)
    for df in (
        territory.entropy_by(e, "cell", F.substring("code", 1, 4), "workers"),
        relational.history_features(table(spark, SF_SMALL, "orders"), "o_custkey", "o_totalprice"),
        territory.territory_index(clients(spark, SF_SMALL), "cell", "income", "client", "expense"),
    ):
        assert "SortAggregate" not in plan(df)


def test_no_python_in_the_plans(spark):
    for name in ("ledger_fold", "renewal_ledger", "nearest_k", "cell_master", "client_lot", "density_clusters", "score_blend"):
        text = plan(QUERIES[name](spark, SF_SMALL))
        assert "Python" not in text and "InPandas" not in text
