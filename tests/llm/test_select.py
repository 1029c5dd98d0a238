import math
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linkwright.llm import mixing, topk

from .helpers import DOCS, frame


def plain_top(rows, k, every):
    import math

    use = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in use:
        if q % every == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in use if i != q and len(a) == len(b)))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("block,seeds", [(2048, 256), (3, 8)])
def test_top_k_against_brute_force(spark, monkeypatch, block, seeds):
    monkeypatch.setattr(topk, "SEEDS", seeds)
    monkeypatch.setattr(topk, "CANDIDATES", 100)
    rng = random.Random(block)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(40)]) for i in range(300)]
    rows += [(300 + i, list(rows[7][1])) for i in range(20)]  # ties
    rows += [(400, None), (401, [None] * 40), (402, [float("nan")] * 40), (403, [float("inf")] + [0.0] * 39), (404, [1.0, 2.0]), (405, []), (None, rows[3][1])]
    rows = [(i, None if v is None else [None if x is None else float(pd.Series([x], dtype="float32")[0]) for x in v]) for i, v in rows]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash"))
    got = topk.top_k(vectors.select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, block=block)
    assert sorted(map(tuple, got.collect())) == plain_top(rows, 5, 20)


def test_top_k_of_large_components(spark):
    """Sums beyond what doubles hold are exact; beyond 64 bits they are the nearest 64-bit number, and ties."""
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randrange(0, 9) for _ in range(12)]) for i in range(60)]
    rows += [(100, [1e30] * 12), (101, [-1e30] * 12), (102, [1e30] * 11 + [-1e30])]
    most = 2**63 - 1
    want = []
    for q, a in rows:
        if q % 20 == 0:
            a = [math.floor(256 * x) for x in a]
            scores = [(max(-most, min(most, sum(x * math.floor(256 * y) for x, y in zip(a, b)))), i) for i, b in rows if i != q]
            want += [(q, r + 1, i, s) for r, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:5])]
    vectors = spark.createDataFrame(rows + [(103, [1.7e308] * 12)], "vec_id long, embedding array<double>")  # 256 times this isn't finite
    assert sorted(map(tuple, topk.top_k(vectors, F.col("vec_id") % 20 == 0).collect())) == sorted(want)


def test_top_k_of_few(spark):
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(vectors, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 32768)]
    assert topk.top_k(vectors.where("vec_id > 5"), F.col("vec_id") == 0).count() == 0


def mix_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["src0"] * 10 + [f"src{k}" for k in range(9)] + [None, "", "web"])
        lang = rng.choice(["en", "en", "de", "fr", "es", "it", None])
        text = rng.choice([None, "", "a b", "x " * rng.randrange(1, 50)])
        rows.append((i, text, lang, source, 0))
    return rows + [(5, "again and again", "en", "src1", 0), (None, "no id", "de", "src0", 0), (None, "no id", "de", "src0", 0)]


@pytest.mark.parametrize("ordered", [2000, 3])
@pytest.mark.parametrize("share,epochs", [((9, 10), 2), ((1, 2), 1), ((3, 1), 3), ((0, 1), 1)])
def test_mix_against_sql(spark, monkeypatch, ordered, share, epochs):
    monkeypatch.setattr(mixing, "ORDERED", ordered)
    plan = mixing.Plan(share=share, epochs=epochs)
    rows = mix_rows(epochs)
    docs = frame(spark, rows, DOCS).withColumn("domain", F.lit("clash")).withColumn("epoch", F.lit(9))
    got = mixing.mixed(docs, plan).select("doc_id", "domain", "lang", "source", "epoch", "n_tokens")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    rel = con.sql(mixing.sql(plan))
    order = [rel.columns.index(c) for c in got.columns]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=str)


def test_shortage_goes_to_siblings_first(spark):
    plan = mixing.Plan(domain={"domain0": 1, "domain1": 1}, lang={"en": 1, "de": 1}, epochs=1)
    leaves = spark.createDataFrame(
        [("domain0", "en", "src0", 1, 10), ("domain0", "de", "src0", 1, 1000), ("domain1", "en", "src1", 1, 1000), ("domain1", "de", "src1", 1, 1000)],
        "domain string, lang string, source string, docs long, tokens long",
    )
    got = {(r["domain"], r["lang"]): r["share"] for r in mixing.budgets(leaves, mixing.Plan(plan.domain, plan.lang, {}, (100, 301), 1)).collect()}
    assert got == {("domain0", "en"): 10, ("domain0", "de"): 490, ("domain1", "en"): 250, ("domain1", "de"): 250}


def test_mix_of_nothing(spark):
    assert mixing.mixed(frame(spark, [], DOCS)).count() == 0
