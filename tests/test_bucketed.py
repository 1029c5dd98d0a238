"""Candidates are made within a query's row: the same rows as pair by pair, without a shuffle of pairs."""

import random

import pytest
from pyspark.sql import functions as F

from linkwright.operators import blocking, decide, features
from linkwright.operators.views import keyed_views

RAW = "entity_id string, business_name string, business_address string, country string"


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(5)
    names = ["Acme Tools", "Acmé Tools Inc", "acme t00ls", "Tools Acme LLC", "Zenith", "Blue Harbor Co", ""]
    streets = ["12 Newton Street, Dayton 45402", "14 Newton Street, Dayton 45402", "7 Gandhi Nagar, Pune 411001", ""]

    def rows(prefix, n):
        made = [(f"{prefix}-{i}", rng.choice(names), rng.choice(streets), rng.choice(["US", "India"])) for i in range(n)]
        return keyed_views(spark.createDataFrame(made, RAW)).cache()

    return rows("S1", 60), {"S2": rows("S2", 150), "S3": rows("S3", 150)}


def pairs_one_by_one(queries, targets, cap):
    hits = blocking.channel_hits(queries, targets)
    rows = hits.groupBy("source1_entity_id", "candidate_entity_id", "candidate_source", "country").agg(F.min("channel").alias("channel"))
    return blocking._scored(blocking.capped(rows, cap), "channel")


@pytest.mark.parametrize("cap", [5, 80])
def test_block_is_the_same_as_pair_by_pair(sides, cap):
    queries, targets = sides
    again = queries.unionByName(queries.where("entity_id = 'S1-7'"))  # a repeated row changes nothing
    got = [tuple(r) for r in blocking.block(again, targets, cap).collect()]
    want = [tuple(r) for r in pairs_one_by_one(queries, targets, cap).collect()]
    assert want and sorted(got) == sorted(want)


def exchanges_above(plan: str, node: str) -> int:
    """How many exchanges a plan has between its root and the first node of that name."""
    return plan[: plan.index(node)].count("Exchange")


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def test_candidates_are_not_shuffled(sides):
    queries, targets = sides
    assert exchanges_above(plan_of(blocking.block(queries, targets, 80)), "Generate inline") == 0


def test_pairs_stay_in_their_bucket(sides):
    """Features of a pair are made where its candidates are; they and the decisions are those of the plain joins."""
    queries, targets = sides
    both = targets["S2"].unionByName(targets["S3"])
    own, parts = blocking.dealt(queries)
    candidates = blocking.block(own, targets, 80, parts)
    there = features.score_logistic(features.pair_features(candidates, own, both, parts=parts))
    assert exchanges_above(plan_of(there), "Generate inline") == 0
    there = decide.decisions(there)
    plain = decide.decisions(features.score_logistic(features.pair_features(candidates.drop("bucket"), queries, both)))
    assert sorted(map(tuple, there.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))


def test_accepted_rows_of_a_sweep(sides):
    queries, targets = sides
    own, parts = blocking.dealt(queries)
    both = targets["S2"].unionByName(targets["S3"])
    scored = features.score_logistic(features.pair_features(blocking.block(own, targets, 80, parts), own, both, parts=parts)).cache()
    limits = [0.5, 0.75, 0.9]
    got = decide.sweep(scored, limits, accepted=True).select("threshold", "source1_entity_id", "candidate_entity_id", "reason").collect()
    want = [(t, *r) for t in limits for r in decide.decisions(scored, threshold=t).where("accepted").select("source1_entity_id", "candidate_entity_id", "reason").collect()]
    assert want and sorted(map(tuple, got)) == sorted(want)
