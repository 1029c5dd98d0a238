import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkwright.llm import mixing, near_dedup, toxicity

from .helpers import DOCS, frame, words
from .test_filters import toxic_rows


def test_stages_in_turn(spark, tmp_path):
    """Each stage keeps what it should, by plain versions of its rule on its own input."""
    rng = random.Random(3)
    rows, labels = toxic_rows(300)
    docs = [(i, t, "en", f"src{i % 5}", len(t)) for i, t in rows]
    docs += [(1000 + i, docs[i][1] + " end", "de", "src0", 0) for i in range(20)]  # near copies
    docs += [(2000, f"{words(5, 900)} {words(12)} tail", "fr", "src1", 0), (2001, None, None, None, None), (2002, "", "en", "src0", 0)]
    rng.shuffle(docs)
    frame(spark, docs, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    frame(spark, labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frame(spark, [("q", words(12))], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    held = spark.read.parquet(str(tmp_path / "documents.parquet"))
    truth = {d: y for d, _, y in labels} | {1000 + i: labels[i][2] for i in range(20)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, held, str(tmp_path)).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        before, after = {r["doc_id"] for r in held.collect()}, {r["doc_id"] for r in out.collect()}
        assert after <= before
        if name == "toxicity":
            gone = before - after
            assert sum(truth.get(d, 0) for d in gone) >= 0.95 * sum(truth.values()) and sum(not truth.get(d, 0) for d in gone) <= 8
        if name == "near_dedup":
            assert after == {r["doc_id"] for r in near_dedup.near_duplicates(held).where("kept").collect()}
            assert not {d for d in after if 1000 <= d < 1020 and d - 1000 in after}
        if name == "decontamination":
            assert before - after == {2000}
        if name == "mixing":
            assert after == {r["doc_id"] for r in mixing.mixed(held, mixing.ONCE).collect()}
        held = out
    last = corpus_pipeline.STAGES[-1][1](spark, held, str(tmp_path))
    assert sorted(r["doc_id"] for r in last.collect()) == sorted(r["doc_id"] for r in held.collect())
    assert toxicity.THRESHOLD == 0.3


def test_one_row_of_each_group(spark, tmp_path):
    """Rows that repeat ids, rows without ids, texts without words."""
    a, b, c = words(40), words(40, 100), words(40, 200)
    rows = [(1, a), (1, a), (2, a), (2, a), (2, b), (3, None), (3, None), (4, ""), (None, c), (None, c), (None, b), (5, a + " end"), (6, words(40, 300))]
    docs = frame(spark, rows).withColumn("node", F.lit("clash")).withColumn("kept", F.lit(0))
    got = near_dedup.keep_one(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    want = [(1, a), (2, b), (3, None), (3, None), (4, ""), (None, c), (6, words(40, 300))]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 2, [(7, words(30), None, None, None)] * 3])
def test_pipeline_of_little(spark, tmp_path, rows):
    """No documents, nulls only, and one document three times."""
    frame(spark, rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    frame(spark, [], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frame(spark, [("q", words(12, 900))], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(got) <= max(len(rows), 0) and (rows or not got)
    if rows and rows[0][0]:
        assert len(got) <= 1


def test_run_is_the_stages(spark, tmp_path):
    rows, labels = toxic_rows(60)
    frame(spark, [(i, t, "en", "src1", 0) for i, t in rows], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    frame(spark, labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frame(spark, [], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 0 < len(got) <= 60
    assert min(r["start"] for r in got) == 0
