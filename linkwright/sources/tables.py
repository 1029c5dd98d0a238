"""Tab-separated tables in and out, normalised storage, and partial results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as t

from linkwright import vocab
from linkwright.functions import text as T
from linkwright.operators.views import keyed_views

RESULTS = ("source1_entity_id", "matched_entity_ids")
CANDIDATES = ("source1_entity_id", "candidate_entity_ids")
#: The long form of candidates: one pair a row.
PAIRS = ("source1_entity_id", "candidate_entity_id")


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...] = vocab.RAW) -> DataFrame:
    """All columns as text, quoted fields unquoted, empty fields as empty text; a missing path raises."""
    schema = t.StructType([t.StructField(c, t.StringType()) for c in columns])
    rows = spark.read.schema(schema).options(sep="\t", header=True, quote='"', escape='"', multiLine=True, enforceSchema=False, mode="FAILFAST").csv(path)
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def write_tsv(rows: DataFrame, path: str, single: bool = False, mode: str = "overwrite") -> None:
    (rows.coalesce(1) if single else rows).write.mode(mode).options(
        sep="\t", header=True, quote='"', escape='"', emptyValue="", nullValue=""
    ).csv(path)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """source1_entity_id, ids."""
    rows = read_tsv(spark, path, RESULTS)
    return rows.select("source1_entity_id", T.parse_ids(F.col("matched_entity_ids")).alias("ids"))


def store_views(raw: DataFrame, path: str, source: str, dialect: str = "train", compose: bool = True) -> None:
    """Normalised views as Parquet by country; one row of an id is stored; nothing is done if the path exists.

    That row is the first by line_no, if raw has it, else by content, so that it does not
    depend on how files are split.
    """
    order = ["line_no"] if "line_no" in raw.columns else [c for c in vocab.RAW if c != "entity_id"]
    place = Window.partitionBy("entity_id").orderBy(*order)
    rows = raw.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place", "line_no")
    keyed_views(rows, dialect, compose).withColumn("source", F.lit(source)).write.mode("ignore").partitionBy("country").parquet(path)


def lookup(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose entity_id is asked for."""
    return rows.join(ids.select("entity_id").distinct(), "entity_id", "left_semi")


def part_of(rows: DataFrame, part: int, parts: int, by: str = "entity_id") -> DataFrame:
    """Range `part` (from 1) of `parts` equal ranges of the rows, in order of id.

    Null ids come first.  Rows with one id stay together, in the range that holds the first
    of them.  What is returned is a filter on the id: ids are counted and sorted over all
    executors, and only one range of them at a time is looked into for a cut.
    """
    if not 1 <= part <= parts:
        raise ValueError(f"part must be from 1 to {parts}")
    ids = rows.groupBy(by).agg(F.count("*").alias("n"))
    ranges = ids.where(F.col(by).isNotNull()).repartitionByRange(by).withColumn("_range", F.spark_partition_id())
    ends = ranges.groupBy("_range").agg(F.min(by).alias("low"), F.max(by).alias("high"), F.sum("n").alias("n")).collect()
    ends.sort(key=lambda r: r["_range"])
    nulls = rows.where(F.col(by).isNull()).count()
    size = -(-(nulls + sum(r["n"] for r in ends)) // parts)

    def cut(place: int):
        """The first id that begins at this place or after it; None if no id does."""
        begun = nulls
        for r in ends:
            if place <= begun:
                return r["low"]
            if place < begun + r["n"]:
                inside = ids.where(F.col(by).between(r["low"], r["high"]))
                before = F.sum("n").over(Window.orderBy(by)) - F.col("n")
                found = inside.withColumn("_place", before + begun).where(F.col("_place") >= place).agg(F.min(by)).first()[0]
                if found is not None:
                    return found
            begun += r["n"]
        return None

    low, high = cut((part - 1) * size), cut(part * size)
    inside = F.lit(False) if low is None else F.col(by) >= low
    if high is not None:
        inside = inside & (F.col(by) < high)
    if part == 1 and size:
        inside = F.col(by).isNull() | inside
    return rows.where(inside)


def not_done(rows: DataFrame, done: DataFrame) -> DataFrame:
    """The queries that a partial output does not have yet."""
    return rows.join(done.select(F.col("source1_entity_id").alias("entity_id")), "entity_id", "left_anti")


def numeric_order(rows: DataFrame, prefix: str = "S1-") -> DataFrame:
    return rows.orderBy(F.substring("entity_id", len(prefix) + 1, 40).cast("bigint"))


def result_rows(s1: DataFrame, accepted: DataFrame, column: str = RESULTS[1]) -> DataFrame:
    """One row for each S1 id: its sorted ids joined by commas, empty if none; accepted: pairs."""
    ids = accepted.groupBy("source1_entity_id").agg(F.collect_set("candidate_entity_id").alias("ids"))
    rows = s1.select(F.col("entity_id").alias("source1_entity_id")).join(ids, "source1_entity_id", "left")
    return rows.select("source1_entity_id", T.format_ids(F.col("ids")).alias(column))


def merge_parts(s1: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """Results of several parts as one: the first part that has an id wins, missing ids are empty."""
    rows = None
    for k, part in enumerate(parts):
        one = part.select(*RESULTS).withColumn("_part", F.lit(k))
        rows = one if rows is None else rows.unionByName(one)
    first = rows.groupBy("source1_entity_id").agg(F.min(F.struct("_part", "matched_entity_ids")).alias("first"))
    out = s1.select(F.col("entity_id").alias("source1_entity_id")).join(first, "source1_entity_id", "left")
    return out.select("source1_entity_id", F.coalesce("first.matched_entity_ids", F.lit("")).alias("matched_entity_ids"))


def merge_candidates(parts: list[DataFrame]) -> DataFrame:
    """Candidate pairs of several parts as one; a pair that a part wrote again after a failure counts once."""
    rows = parts[0].select(*PAIRS)
    for part in parts[1:]:
        rows = rows.unionByName(part.select(*PAIRS))
    return rows.distinct()


def write_outputs(s1: DataFrame, accepted: DataFrame, candidates: DataFrame, path: str) -> None:
    """matching_results and candidate_pairs under path, checked before they are written."""
    from linkwright.operators.audit import assert_submission

    results, cands = result_rows(s1, accepted), result_rows(s1, candidates, CANDIDATES[1])
    parsed = [r.select("source1_entity_id", T.parse_ids(F.col(c)).alias("ids")) for r, c in ((results, RESULTS[1]), (cands, CANDIDATES[1]))]
    assert_submission(*parsed, s1)
    write_tsv(results, f"{path}/matching_results.tsv")
    write_tsv(cands, f"{path}/candidate_pairs.tsv")
