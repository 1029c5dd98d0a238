"""Data audits: schemas and identifiers are asserted, the rest is reported."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright import vocab
from linkwright.functions import text as T


def _blank(column: str):
    return T.strip(T.text(F.col(column))) == ""


def audit_source(rows: DataFrame, prefix: str) -> DataFrame:
    """One row: counts of rows, ids, wrong prefixes, blank fields and their percentages."""
    n = F.count("*")
    return rows.agg(
        n.alias("total_rows"),
        F.count_distinct("entity_id").alias("unique_ids"),
        F.count_if(~F.coalesce(F.col("entity_id").startswith(prefix), F.lit(False))).alias("bad_prefixes"),
        F.count_if(_blank("business_name")).alias("empty_names"),
        F.round(100 * F.count_if(_blank("business_name")) / F.greatest(n, F.lit(1)), 4).alias("empty_names_pct"),
        F.count_if(_blank("business_address")).alias("empty_addresses"),
        F.round(100 * F.count_if(_blank("business_address")) / F.greatest(n, F.lit(1)), 4).alias("empty_addresses_pct"),
        F.count_if(_blank("country")).alias("empty_countries"),
    )


def country_distribution(rows: DataFrame) -> DataFrame:
    return rows.groupBy("country").agg(F.count("*").alias("n"))


def check_source(rows: DataFrame, prefix: str) -> dict:
    """audit_source as a dict; raises on another schema, repeated ids or ids of another source."""
    if tuple(rows.columns) != vocab.RAW:
        raise ValueError(f"columns are {rows.columns}, not {list(vocab.RAW)}")
    out = audit_source(rows, prefix).first().asDict()
    if out["unique_ids"] != out["total_rows"]:
        raise ValueError("entity_id is not unique")
    if out["bad_prefixes"]:
        raise ValueError(f"{out['bad_prefixes']} ids do not begin with {prefix}")
    return out


def audit_truth(truth: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
    """One row about a truth table (source1_entity_id, ids as given, repeats included)."""
    ids = truth.select("source1_entity_id", F.explode("ids").alias("id"))
    known = s2.select(F.col("entity_id").alias("id")).unionByName(s3.select(F.col("entity_id").alias("id"))).distinct()
    unknown = ids.join(known, "id", "left_anti").agg(F.count("*").alias("invalid_references"))
    repeated = truth.agg(F.count_if(F.size("ids") > F.size(F.array_distinct("ids"))).alias("rows_with_duplicates"))
    stray = truth.join(s1.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_anti").agg(F.count("*").alias("unknown_s1"))
    missing = s1.join(truth.select(F.col("source1_entity_id").alias("entity_id")), "entity_id", "left_anti").agg(F.count("*").alias("s1_without_truth"))
    split = ids.agg(
        F.count_if(F.col("id").startswith("S2-")).alias("s2_matches"), F.count_if(F.col("id").startswith("S3-")).alias("s3_matches")
    )
    n = F.size("ids")
    some = F.when(n > 0, n)
    base = truth.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("source1_entity_id").alias("unique_s1"),
        F.count_if(n == 0).alias("singletons"),
        F.round(F.coalesce(F.avg(some), F.lit(0.0)), 6).alias("mean_matches"),
        F.coalesce(F.max(some), F.lit(0)).alias("max_matches"),
    )
    for one in (split, unknown, repeated, stray, missing):  # one row each
        base = base.join(F.broadcast(one))
    return base


def shared_candidates(truth: DataFrame) -> DataFrame:
    """Records of S2 or S3 that several S1 claim, and how many."""
    ids = truth.select("source1_entity_id", F.explode(F.array_distinct("ids")).alias("candidate_entity_id"))
    return ids.groupBy("candidate_entity_id").agg(F.count("*").alias("n_s1")).where("n_s1 > 1")


def profile(rows: DataFrame) -> DataFrame:
    """By country: name and address lengths (median, 95th percentile) and share of repeated names."""
    name, address = F.length(T.text(F.col("business_name"))), F.length(T.text(F.col("business_address")))
    return rows.groupBy("country").agg(
        F.count("*").alias("n"),
        F.percentile(name, F.lit(0.5)).alias("name_median"),
        F.percentile(name, F.lit(0.95)).alias("name_p95"),
        F.percentile(address, F.lit(0.5)).alias("address_median"),
        F.percentile(address, F.lit(0.95)).alias("address_p95"),
        F.round(1 - F.count_distinct("business_name") / F.count("*"), 6).alias("repeated_names"),
    )


def submission_violations(results: DataFrame, candidates: DataFrame, s1: DataFrame) -> DataFrame:
    """rule, violations of a result table and a candidate table (source1_entity_id, ids as given)."""
    ids = results.select("source1_entity_id", F.explode("ids").alias("id"))
    known = s1.select(F.col("entity_id").alias("source1_entity_id"))
    cand = candidates.select("source1_entity_id", F.explode("ids").alias("id"))

    def rule(name: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("rule"), "violations")

    rules = [
        rule("missing_s1", known.join(results, "source1_entity_id", "left_anti")),
        rule("unknown_s1", results.join(known, "source1_entity_id", "left_anti")),
        rule("repeated_s1", results.groupBy("source1_entity_id").count().where("count > 1")),
        rule("repeated_match", results.where(F.size("ids") > F.size(F.array_distinct("ids")))),
        rule("bad_prefix", ids.where(~F.col("id").startswith("S2-") & ~F.col("id").startswith("S3-"))),
        rule("bad_candidate_prefix", cand.where(~F.col("id").startswith("S2-") & ~F.col("id").startswith("S3-"))),
        rule("match_not_candidate", ids.join(cand, ["source1_entity_id", "id"], "left_anti")),
    ]
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out


def assert_submission(results: DataFrame, candidates: DataFrame, s1: DataFrame) -> None:
    bad = {r["rule"]: r["violations"] for r in submission_violations(results, candidates, s1).where("violations > 0").collect()}
    if bad:
        raise ValueError(f"Integrity Violation: {bad}")
