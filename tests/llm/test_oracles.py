"""The registered queries give the rows of their SQL on whole tables, and on awkward ones."""

import duckdb
import pytest

from linkwright.llm import registry

from .helpers import AWKWARD, DOCS, frame, words

DIR = "/root/testdata/sf0.001"
TEXTS = [name for name in registry.ORACLES if name.split("_")[0] in ("op2", "op3", "op4", "op5")]


def compared(spark, name, folder, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet{'' if folder == DIR else '/*.parquet'}')")
    rel, got = con.sql(registry.ORACLES[name]), registry.QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    assert columns == sorted(rel.columns)
    order = [rel.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=str)


@pytest.mark.parametrize("name", registry.ORACLES)
def test_same_as_sql(spark, name):
    compared(spark, name, DIR, ("documents", "benchmark", "embeddings"))


@pytest.mark.parametrize("name", TEXTS)
def test_same_as_sql_on_awkward_rows(spark, tmp_path, name):
    """Ids that rows repeat or lack are the brute-force tests' matter."""
    rows = [(i, t, None, "src1", 0) for i, (_, t) in enumerate(AWKWARD)] + [(100, words(55, 3) + "\n" + words(30) + "\n" + words(55, 3), "en", None, 1)]
    frame(spark, rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    items = [("a", words(12, 5)), ("b", "ONE, two"), ("c", None), ("d", "..."), (None, "one two"), ("a", words(12, 40))]
    frame(spark, items, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    compared(spark, name, str(tmp_path), ("documents", "benchmark"))
