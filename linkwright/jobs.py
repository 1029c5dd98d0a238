"""The jobs as commands: python -m linkwright.jobs link, merge, evaluate, audit, validate, split, store or train.

All paths are tab-separated tables, files or folders, wherever Spark can read them.
"""

from __future__ import annotations

import argparse
import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.functions import text as T
from linkwright.operators import audit, blocking, evaluate, features, model, split
from linkwright.operators.views import keyed_views
from linkwright.plans.linkage import link
from linkwright.sources import tables
from linkwright.sources.staging import drop, stage

#: Countries that a report names, the commonest first; the rest is counted under `others`.
NAMED_COUNTRIES = 200


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _given(column: str) -> Column:
    """A comma list as it stands, repeats included."""
    return F.filter(F.transform(F.split(column, ","), lambda x: F.trim(x)), lambda x: x != "")


def _results(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_truth(spark, path)


def link_part(spark, s1: str, s2: str, s3: str, out: str, part: int = 1, parts: int = 1, matcher: str | None = None, cap: int = 80, **policy) -> int:
    """Link range `part` of `parts` of s1 and add to out/results and out/candidates; the number of queries that were left to do.

    Queries that out/results has already are not linked again.  Candidates are written before
    results, so a job that failed between the two writes pairs again: merging counts them once.
    out/decided keeps the features and the reason of each pair of the latest run.
    """
    todo = tables.part_of(tables.read_tsv(spark, s1), part, parts)
    if _exists(spark, f"{out}/results"):
        todo = tables.not_done(todo, tables.read_tsv(spark, f"{out}/results", tables.RESULTS))
    left = todo.count()
    if not left:
        return 0
    score = model.EntityMatcher.load(matcher).predict if matcher else features.score_logistic
    _, decided = link(todo, tables.read_tsv(spark, s2), tables.read_tsv(spark, s3), score, cap, **policy)
    decided.write.mode("overwrite").parquet(f"{out}/decided")
    decided = spark.read.parquet(f"{out}/decided")
    tables.write_tsv(decided.select(*tables.PAIRS), f"{out}/candidates", mode="append")
    tables.write_tsv(tables.result_rows(todo, decided.where("accepted")), f"{out}/results", mode="append")
    return left


def merge(spark, s1: str, parts: list[str], out: str) -> None:
    """Outputs of parts as matching_results.tsv and candidate_pairs.tsv under out, checked before they are written."""
    raw = tables.read_tsv(spark, s1)
    merged = tables.merge_parts(raw, [tables.read_tsv(spark, f"{p}/results", tables.RESULTS) for p in parts])
    ids = merged.select("source1_entity_id", F.explode(T.parse_ids(F.col("matched_entity_ids"))).alias("candidate_entity_id"))
    tables.write_outputs(raw, ids, tables.merge_candidates([tables.read_tsv(spark, f"{p}/candidates", tables.PAIRS) for p in parts]), out)


def evaluate_files(spark, truth: str, results: str, beta: float = 0.5) -> dict:
    """The macro scores of a result table against a truth table."""
    return evaluate.evaluate_predictions(_results(spark, truth), _results(spark, results), beta=beta).first().asDict()


def data_audit(spark, s1: str, s2: str, s3: str, truth: str) -> dict:
    """Four sections: each source (checked, with its countries) and the truth.  Raises where a source is not sound."""
    raw = {f"S{k}": tables.read_tsv(spark, path) for k, path in enumerate((s1, s2, s3), 1)}
    out = {}
    for k, (prefix, rows) in enumerate(raw.items(), 1):
        section = audit.check_source(rows, f"{prefix}-")
        named = audit.country_distribution(rows).orderBy(F.desc("n"), "country").limit(NAMED_COUNTRIES).collect()
        section["countries"] = {r["country"]: r["n"] for r in named}
        section["others"] = section["total_rows"] - sum(r["n"] for r in named)
        out[f"source{k}"] = section
    rows = tables.read_tsv(spark, truth, tables.RESULTS).select("source1_entity_id", _given("matched_entity_ids").alias("ids"))
    out["ground_truth"] = audit.audit_truth(rows, raw["S1"], raw["S2"], raw["S3"]).first().asDict()
    return out


def validate(spark, s1: str, results: str, candidates: str) -> None:
    """Raises ValueError if a result table and a candidate table break a rule of the submission."""
    given = [tables.read_tsv(spark, p, c) for p, c in ((results, tables.RESULTS), (candidates, tables.CANDIDATES))]
    lists = [r.select("source1_entity_id", _given(r.columns[1]).alias("ids")) for r in given]
    audit.assert_submission(*lists, tables.read_tsv(spark, s1))


def make_folds(spark, s1: str, truth: str, out: str, folds: int = 5, rapid: int = 2500, seed: int = 42) -> None:
    """out/s1_folds and out/rapid_eval_s1."""
    rows = split.stratified_folds(_results(spark, truth), tables.read_tsv(spark, s1), folds, seed)
    tables.write_tsv(rows, f"{out}/s1_folds.tsv")
    tables.write_tsv(split.rapid_sample(rows, rapid, seed), f"{out}/rapid_eval_s1.tsv")


def train(spark, s1: str, s2: str, s3: str, truth: str, out: str, cap: int = 80, **options) -> None:
    """Fit the matcher on all queries outside fold 0 and save it under out."""
    raw, real = tables.read_tsv(spark, s1), _results(spark, truth)
    queries, targets = keyed_views(raw), {f"S{k}": keyed_views(tables.read_tsv(spark, p)) for k, p in ((2, s2), (3, s3))}
    rows = features.pair_features(blocking.block(queries, targets, cap), queries, targets["S2"].unionByName(targets["S3"]))
    labelled = stage(split.training_pairs(rows, evaluate.truth_pairs(real), split.stratified_folds(real, raw)), "labelled", "zstd")
    model.EntityMatcher(**options).fit(labelled).save(out)
    drop(labelled)


def _parser() -> argparse.ArgumentParser:
    made = argparse.ArgumentParser(prog="linkwright.jobs", description=__doc__)
    commands = made.add_subparsers(dest="command", required=True)

    def command(name: str, *paths: str, **numbers) -> argparse.ArgumentParser:
        one = commands.add_parser(name)
        for p in paths:
            one.add_argument(f"--{p}", required=True)
        for n, default in numbers.items():
            one.add_argument(f"--{n.replace('_', '-')}", type=type(default), default=default)
        return one

    linking = command("link", "s1", "s2", "s3", "out", part=1, parts=1, cap=80, threshold=0.93, strong_threshold=0.89, min_margin=0.05)
    linking.add_argument("--matcher")
    command("merge", "s1", "out").add_argument("--parts", nargs="+", required=True)
    command("evaluate", "truth", "results", beta=0.5)
    command("audit", "s1", "s2", "s3", "truth")
    command("validate", "s1", "results", "candidates")
    command("split", "s1", "truth", "out", folds=5, rapid=2500, seed=42)
    command("store", "table", "source", "out")
    command("train", "s1", "s2", "s3", "truth", "out", cap=80, trees=200, rate=0.07, depth=6, leaf=20)
    return made


def main(args: list[str] | None = None) -> None:
    given = vars(_parser().parse_args(args))
    name = given.pop("command")
    # local workers find the package wherever the command was started
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(Path(__file__).resolve().parent.parent), os.environ.get("PYTHONPATH")]))
    spark = SparkSession.builder.appName(f"linkwright {name}").getOrCreate()
    if name == "link":
        print(json.dumps({"linked": link_part(spark, **given)}))
    elif name == "store":
        tables.store_views(tables.read_tsv(spark, given["table"]), given["out"], given["source"])
    elif name in ("evaluate", "audit"):
        print(json.dumps({"evaluate": evaluate_files, "audit": data_audit}[name](spark, **given), indent=2, default=str))
    else:
        {"merge": merge, "validate": validate, "split": make_folds, "train": train}[name](spark, **given)


if __name__ == "__main__":
    main()
