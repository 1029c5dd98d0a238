"""The trained matcher: its trees against plain sums, and how it is fitted."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwright import queries, vocab
from linkwright.operators import evaluate, model, split
from linkwright.plans.registry import Registry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def labelled(spark, n=4000):
    """Rows whose label depends on two features together, some of them alike."""
    numbers = {c: (F.floor(F.rand(i) * 40) / 40 if i % 3 else F.floor(F.rand(i) * 2)).cast("double").alias(c) for i, c in enumerate(vocab.FEATURES)}
    rows = spark.range(0, n, 1, 3).select(F.concat(F.lit("S1-"), (F.col("id") % 500).cast("string")).alias("source1_entity_id"), *numbers.values())
    rows = rows.withColumn("label", ((F.col("core_jw") > 0.5) != (F.col("addr_jaccard") > 0.3)).cast("double"))
    return spark.createDataFrame(rows.collect(), rows.schema)


def test_fit_does_not_take_a_job_for_each_tree(spark):
    rows, context = labelled(spark), spark.sparkContext
    context.setJobGroup("fit", "fit")
    made = model.EntityMatcher(trees=60, depth=3).fit(rows)
    context.setJobGroup("other", "other")
    assert len(context.statusTracker().getJobIdsForGroup("fit")) < 20
    assert [len(m["trees"]) for m in made.models] == [60] * 3
    assert model.EntityMatcher(trees=60, depth=3).fit(rows.repartition(5, "core_jw")).models == made.models
    found = made.predict(rows.withColumn("more", F.lit(1))).select("label", "more", "probability").collect()
    right = np.mean([(r["probability"] > 0.5) == (r["label"] == 1) for r in found])
    assert right > 0.99 and all(0 < r["probability"] < 1 and r["more"] == 1 for r in found)


def test_saved_is_loaded(spark, tmp_path):
    rows = labelled(spark, 900)
    made = model.EntityMatcher(trees=3, depth=2).fit(rows)
    for _ in range(2):
        made.save(str(tmp_path / "m"))
    assert model.EntityMatcher.load(str(tmp_path / "m")).models == made.models
    with pytest.raises(ValueError):
        model.EntityMatcher().fit(rows.where("label = 1"))


@pytest.mark.parametrize("leaf", [1, 20])
def test_splits_are_the_best(leaf):
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 9, (4, 300)).astype(np.uint8)
    g, h, n = rng.normal(size=300) + (bins[1] > 4) * (bins[2] > 2), rng.uniform(0.1, 1, 300), rng.integers(1, 4, 300).astype(float)

    def plain(rows, depth):
        """Leaf values of rows by trying every split."""
        best = (1e-12, None)
        for f in range(4):
            for b in range(9):
                left, right = rows & (bins[f] <= b), rows & (bins[f] > b)
                if min(n[left].sum(), n[right].sum()) >= max(leaf, 1):
                    gain = sum(g[s].sum() ** 2 / h[s].sum() for s in (left, right)) - g[rows].sum() ** 2 / h[rows].sum()
                    best = max(best, (gain, (left, right)), key=lambda x: x[0])
        if depth == 0 or best[1] is None:
            return np.where(rows, -g[rows].sum() / h[rows].sum(), 0.0)
        return sum(plain(s, depth - 1) for s in best[1])

    for depth in (1, 2, 4):
        tree, where = model.grown(bins, g, h, n, depth, leaf)
        assert np.array([t[4] for t in tree])[where] == pytest.approx(plain(np.ones(300, dtype=bool), depth))


def test_bins_follow_the_values():
    assert model.cuts_of(np.array([3.0, 1.0, 1.0]), np.ones(3)).tolist() == [2.0]
    x = np.arange(1000.0)
    cuts = model.cuts_of(x, np.ones(1000))
    assert len(cuts) <= model.BINS - 1 and np.bincount(np.searchsorted(cuts, x)).max() <= 8
    skewed = model.cuts_of(x, np.where(x == 500, 1e6, 1.0))
    assert (x[500] > skewed[skewed < 500]).all() and len(skewed) >= 1


def test_scores_of_the_whole_fold(spark):
    got = queries.QUERIES["gbt_scores"](spark, DIR).cache()
    held = queries.QUERIES["folds"](spark, DIR).where("fold = 0").select("source1_entity_id")
    pairs = queries.QUERIES["block_capped"](spark, DIR).join(held, "source1_entity_id", "left_semi").select("source1_entity_id", "candidate_entity_id")
    keys = got.select(*pairs.columns)
    assert keys.count() == pairs.count() > 0 and keys.exceptAll(pairs).isEmpty() and pairs.exceptAll(keys).isEmpty()
    assert got.where("probability is null or probability not between 0 and 1").isEmpty()


def test_every_query_outside_fold_0_is_trained_on(spark):
    folds = spark.range(0, 4000, 1, 3).select(F.concat(F.lit("S1-"), "id").alias("source1_entity_id"), F.lit("US").alias("country"), (F.col("id") % 5).cast("int").alias("fold"))
    assert split.training_queries(folds).distinct().count() == 3200


def test_training_rows_are_whole_and_rightly_labelled(spark, monkeypatch):
    class Asked(Exception):
        pass

    def fit(self, labelled):
        raise Asked(labelled)

    monkeypatch.setattr(model.EntityMatcher, "fit", fit)
    with pytest.raises(Asked) as found:
        queries.QUERIES["gbt_scores"](spark, DIR)
    key = ["source1_entity_id", "candidate_entity_id"]
    got = found.value.args[0].select(*key, "label").cache()
    train = queries.QUERIES["folds"](spark, DIR).where("fold > 0")
    pairs = queries.QUERIES["block_capped"](spark, DIR).join(train, "source1_entity_id", "left_semi").select(*key)
    real = evaluate.truth_pairs(Registry(spark, DIR).truth).withColumn("label", F.lit(1.0))
    want = pairs.join(real, key, "left").fillna(0.0, ["label"])
    assert got.where("label = 1").count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_models_do_not_depend_on_tasks(spark, monkeypatch):
    rows, made = labelled(spark, 3000), []
    for tasks, block in ((1, model.BLOCK), (4, model.BLOCK), (3, 64)):
        monkeypatch.setattr(model, "_at_once", lambda spark: tasks)
        monkeypatch.setattr(model, "BLOCK", block)
        made.append(model.EntityMatcher(trees=8, depth=4).fit(rows.repartition(5)).models)
    assert made[0] == made[1] == made[2]


def test_bytes_hold_all_bins():
    rng = np.random.default_rng(1)
    widths = [256, 1, 2, 2, 250, 16, 2, 11, 3, 1, 255, 6]
    layout, cuts = model.Layout(widths), [np.arange(w - 1) + 0.5 for w in widths]
    x = [rng.integers(0, w, 2000) for w in widths]
    rows = layout.packed([c.astype(float) for c in x], cuts)
    assert rows.shape[1] < len(widths) and max(layout.sizes) <= 256
    sums = layout.by_feature([np.bincount(rows[:, i], minlength=s).astype(float) for i, s in enumerate(layout.sizes)])
    for f, (byte, _) in enumerate(layout.places):
        assert (layout.bins(f, rows[:, byte]) == x[f]).all() and (sums[layout.spans[f]] == np.bincount(x[f], minlength=widths[f])).all()
