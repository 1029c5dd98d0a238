import json
import random

import pytest
from pyspark.sql import functions as F

from linkwright import jobs
from linkwright.operators import decide, evaluate, model, split
from linkwright.plans.registry import Registry
from linkwright.sources import tables

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("parts", [1, 3, 7, 50])
def test_ranges_of_rows(spark, parts):
    """Equal ranges by place; rows of one id stay together, null ids come first, no row is lost."""
    rng = random.Random(parts)
    ids = [None] * 3 + [f"S1-{rng.randrange(40)}" for _ in range(60)] + ["S1-7"] * 30
    rows = spark.createDataFrame([(x, i) for i, x in enumerate(ids)], "entity_id string, row int")
    ranked, size = sorted(ids, key=lambda x: (x is not None, x or "")), -(-len(ids) // parts)
    for part in range(1, parts + 1) if parts < 10 else (1, 2, 25, parts):
        expected = sorted(i for i, x in enumerate(ids) if ranked.index(x) // size == part - 1)
        assert sorted(r["row"] for r in tables.part_of(rows, part, parts).collect()) == expected
    with pytest.raises(ValueError):
        tables.part_of(rows, parts + 1, parts)


def test_ranges_of_no_rows(spark):
    assert tables.part_of(spark.createDataFrame([], "entity_id string"), 1, 3).count() == 0


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """The registry's first records as tab-separated tables."""
    at, r = str(tmp_path_factory.mktemp("registry")), Registry(spark, DIR)
    few = F.regexp_extract("entity_id", "-D?([0-9]+)", 1).cast("int") <= 40
    for name in ("s1", "s2", "s3"):
        tables.write_tsv(getattr(r, name).where(few), f"{at}/{name}")
    truth = r.truth.where(F.substring("source1_entity_id", 4, 9).cast("int") <= 40)
    tables.write_tsv(truth.select("source1_entity_id", F.array_join("ids", ",").alias("matched_entity_ids")), f"{at}/truth")
    return {n: f"{at}/{n}" for n in ("s1", "s2", "s3", "truth")}


def test_link_in_parts(spark, files, tmp_path):
    """Two parts merge to what one job gives that was resumed; the outputs pass the checks."""
    sources, n = {n: files[n] for n in ("s1", "s2", "s3")}, 41
    one, two = (str(tmp_path / n) for n in ("one", "two"))
    assert jobs.link_part(spark, **sources, out=one, part=1, parts=2) == 21
    assert jobs.link_part(spark, **sources, out=one, part=1, parts=2) == 0  # nothing is left
    assert jobs.link_part(spark, **sources, out=two, part=2, parts=2) == 20
    jobs.merge(spark, files["s1"], [one, two], str(tmp_path / "b"))
    assert jobs.link_part(spark, **sources, out=one) == 20
    jobs.merge(spark, files["s1"], [one], str(tmp_path / "a"))
    for name in ("matching_results", "candidate_pairs"):
        columns = tables.RESULTS if name == "matching_results" else tables.CANDIDATES
        a, b = (sorted(map(tuple, tables.read_tsv(spark, f"{tmp_path}/{o}/{name}.tsv", columns).collect())) for o in "ab")
        assert a == b and len(a) == n and any(x[1] for x in a)
    jobs.validate(spark, files["s1"], f"{tmp_path}/b/matching_results.tsv", f"{tmp_path}/b/candidate_pairs.tsv")
    with pytest.raises(ValueError):
        jobs.validate(spark, files["s2"], f"{tmp_path}/b/matching_results.tsv", f"{tmp_path}/b/candidate_pairs.tsv")
    scores = jobs.evaluate_files(spark, files["truth"], f"{tmp_path}/b/matching_results.tsv")
    assert scores["total_entities"] == n and 0 < scores["macro_f05"] <= 1
    assert jobs.evaluate_files(spark, files["truth"], files["truth"])["macro_f05"] == 1


def test_audit_of_files(spark, files, tmp_path):
    got = json.loads(json.dumps(jobs.data_audit(spark, **files)))
    assert set(got) == {"source1", "source2", "source3", "ground_truth"}
    assert got["source1"]["total_rows"] == 41 and sum(got["source1"]["countries"].values()) == 41 and got["source1"]["others"] == 0
    assert got["ground_truth"]["rows_with_duplicates"] == 0
    tables.write_tsv(spark.createDataFrame([("S1-1", "S2-1, S2-1,S9-9")], "source1_entity_id string, matched_entity_ids string"), str(tmp_path / "t"))
    bad = jobs.data_audit(spark, **files | {"truth": str(tmp_path / "t")})["ground_truth"]
    assert (bad["rows_with_duplicates"], bad["invalid_references"], bad["s1_without_truth"]) == (1, 1, 40)
    with pytest.raises(ValueError):
        jobs.data_audit(spark, **files | {"s1": files["s2"]})


def test_folds_and_training(spark, files, tmp_path):
    jobs.make_folds(spark, files["s1"], files["truth"], str(tmp_path))
    columns = ("source1_entity_id", "country", "match_count", "fold")
    assert tables.read_tsv(spark, str(tmp_path / "s1_folds.tsv"), columns).count() == 41
    jobs.train(spark, **files, out=str(tmp_path / "m"), trees=2, depth=2, leaf=1)
    jobs.link_part(spark, **{n: files[n] for n in ("s1", "s2", "s3")}, out=str(tmp_path / "o"), matcher=str(tmp_path / "m"))
    rows = spark.read.parquet(str(tmp_path / "o/decided"))
    assert rows.where("probability IS NULL OR probability NOT BETWEEN 0 AND 1").count() == 0 and rows.count() > 0


def test_word_reach_and_examples(spark):
    one = "source1_entity_id string, ids array<string>"
    truth = spark.createDataFrame([("S1-1", ["S2-1", "S2-2", "S2-9"]), ("S1-2", ["S3-1"]), ("S1-3", []), ("S1-4", [])], one)
    raw = "entity_id string, name_clean string, business_name string, business_address string, country string"
    s1 = spark.createDataFrame([("S1-1", "the acme ltd"), ("S1-2", "of ltd"), ("S1-3", None), ("S1-4", "x")], "entity_id string, name_clean string")
    s1 = s1.select("*", F.col("name_clean").alias("business_name"), F.lit(None).cast("string").alias("business_address"), F.lit("US").alias("country"))
    targets = spark.createDataFrame([("S2-1", "superacme", "Superacme", "a", "US"), ("S2-2", "other", "", "", "US"), ("S3-1", "of ltd", "", "", "US")], raw)
    assert tuple(evaluate.word_reach(truth, s1, targets).first()) == (4, 1, 0.25)
    assert tuple(evaluate.word_reach(truth.limit(0), s1, targets).first()) == (0, 0, 0.0)
    found = spark.createDataFrame([("S1-1", ["S2-1", "S2-2"]), ("S1-4", ["S3-1"])], one)
    rows = evaluate.side_by_side(truth, found, s1, targets, 1).collect()
    got = sorted((r["kind"], r["source1_entity_id"], r["candidate_entity_id"] or "", r["is_true"]) for r in rows)
    assert got == [("matched", "S1-1", "S2-1", True), ("matched", "S1-1", "S2-2", True), ("singleton", "S1-3", "", None)]


def test_hard_negatives(spark):
    rows = [("S1-1", f"S2-{i}", i / 10, 0.0, 0.0) for i in range(6)] + [("S1-1", "S2-9", 0.0, 0.0, 1.0), ("S1-2", "S2-1", 0.0, 0.0, 0.0)]
    made = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, core_jw double, addr_jaccard double, label double")
    got = sorted((r[0], r[1]) for r in split.hard_negatives(made, 2).collect())
    assert got == [("S1-1", "S2-4"), ("S1-1", "S2-5"), ("S1-1", "S2-9"), ("S1-2", "S2-1")]


def test_report_is_json(spark, tmp_path):
    text = model.report(spark.sql("SELECT 1 AS a, 0.5D AS b"), str(tmp_path / "r.json"))
    assert json.loads(text) == {"a": 1, "b": 0.5} == json.loads((tmp_path / "r.json").read_text())


def test_policy_without_dual_anchor(spark):
    """An exact name without any address evidence is vetoed only with the dual anchor."""
    row = {c: 0.0 for c in jobs.features.vocab.FEATURES} | {"exact_compact": 1.0, "exact_core": 1.0, "core_jw": 1.0, "core_jaccard": 1.0}
    rows = spark.createDataFrame([row | {"source1_entity_id": "S1-1", "candidate_entity_id": "S2-1", "probability": 0.99}])
    assert [decide.decisions(rows, dual_anchor=d).first()["reason"] for d in (True, False)] == ["veto", "primary"]
