import random

import pytest
from pyspark.sql import functions as F

from linkwright.functions import similarity as S
from linkwright.operators import audit, blocking, decide, evaluate
from linkwright.operators.views import keyed_views
from linkwright.plans.linkage import link
from linkwright.sources import tables


def plain_jaro(a, b):
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    w = max(len(a), len(b)) // 2 - 1
    taken, got = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - w), min(len(b), i + w + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                got.append(c)
                break
    if not got:
        return 0.0
    t = sum(x != y for x, y in zip(got, (c for c, k in zip(b, taken) if k)))
    k = len(got)
    return (k / len(a) + k / len(b) + (k - t / 2) / k) / 3


def test_jaro_on_random_pairs(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randrange(0, 12)))
    pairs = [("ab", "ba"), ("", ""), ("", "a"), ("martha", "marhta")] + [(word(), word()) for _ in range(600)]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", S.jaro(F.col("a"), F.col("b")).alias("j")).collect()
    assert len(got) == len(pairs)
    for r in got:
        assert r["j"] == pytest.approx(plain_jaro(r["a"], r["b"]), abs=1e-12), (r["a"], r["b"])


def test_jaro_winkler_has_no_floor(spark):
    got = spark.createDataFrame([("abxxxxxx", "abyyyyyy")], "a string, b string").select(S.jaro_winkler(F.col("a"), F.col("b"))).first()[0]
    j = plain_jaro("abxxxxxx", "abyyyyyy")
    assert j < 0.7 and got == pytest.approx(j + 2 * 0.1 * (1 - j))


RAW = "entity_id string, business_name string, business_address string, country string"


def test_first_channel_by_name_wins(spark):
    q = keyed_views(spark.createDataFrame([("S1-1", "Acme", "1 Newton Road", "US")], RAW))
    t = keyed_views(spark.createDataFrame([("S2-1", "Acme", "2 Newton Road", "US")], RAW))
    got = blocking.block(q, {"S2": t}).collect()
    assert [(r["retrieval_channels"], r["retrieval_score"]) for r in got] == [("addr_token", 5.0)]


def test_cap_counts_s2_first(spark):
    pairs = [("S1-1", f"S2-{i:03}", "S2") for i in range(90)] + [("S1-1", f"S3-{i}", "S3") for i in range(10)]
    rows = spark.createDataFrame(pairs, "source1_entity_id string, candidate_entity_id string, candidate_source string")
    got = {r["candidate_source"]: r["count"] for r in blocking.capped(rows, 80).groupBy("candidate_source").count().collect()}
    assert got == {"S2": 80, "S3": 1}


COLUMNS = ["probability", "core_jw", "addr_jaccard", "addr_jw", "postal_conflict", "postal_match", "nums_conflict", "nums_jaccard"]
COLUMNS += ["exact_compact", "exact_core", "core_jaccard", "name_containment"]


def plain_policy(rows, threshold, strong_at, margin):
    rows = sorted(rows, key=lambda r: (-r["probability"], r["candidate_entity_id"]))
    out, top = [], 0.0
    for r in rows:
        p = r["probability"]
        if r["postal_conflict"] == 1 or (r["nums_conflict"] == 1 and r["addr_jaccard"] < 0.5):
            continue
        if not r["exact_compact"] and not r["exact_core"]:
            if r["core_jw"] < 0.93 or (r["core_jaccard"] < 0.6 and r["core_jw"] < 0.97 and r["name_containment"] < 0.85):
                continue
        if not (r["addr_jaccard"] >= 0.2 or r["addr_jw"] >= 0.7 or r["postal_match"] == 1 or r["nums_jaccard"] > 0):
            continue
        if r["core_jw"] < 0.85 and r["addr_jaccard"] < 0.5:
            continue
        strong = r["addr_jw"] >= 0.85 or r["postal_match"] == 1 or (r["addr_jaccard"] >= 0.35 and r["nums_jaccard"] > 0)
        if p >= (strong_at if strong else threshold):
            out.append(r["candidate_entity_id"])
            top = top or p
        elif top and p >= 0.82 and p >= top - 0.15 and strong:
            out.append(r["candidate_entity_id"])
    if len(rows) > 1 and rows[0]["probability"] < 0.9 and rows[0]["probability"] - rows[1]["probability"] < margin and not rows[0]["exact_compact"]:
        return []
    return out


@pytest.mark.parametrize("threshold", [0.75, 0.88, 0.93])
def test_policy_on_random_groups(spark, threshold):
    rng = random.Random(int(threshold * 100))
    groups = {}
    for g in range(300):
        rows = []
        for k in range(rng.randrange(1, 6)):
            r = {c: rng.choice([0.0, 0.3, 0.5, 0.86, 0.94, 0.98, 1.0]) for c in COLUMNS}
            r |= {c: float(rng.random() < 0.25) for c in ("postal_conflict", "nums_conflict", "exact_compact", "exact_core", "postal_match")}
            r |= {"probability": round(rng.uniform(0.7, 1), 3), "source1_entity_id": f"S1-{g}", "candidate_entity_id": f"S2-{k}"}
            rows.append(r)
        groups[f"S1-{g}"] = rows
    frame = spark.createDataFrame([r for rows in groups.values() for r in rows])
    got = {r["source1_entity_id"]: r["ids"] for r in decide.matches(decide.decisions(frame, threshold=threshold)).collect()}
    assert got == {g: sorted(plain_policy(rows, threshold, 0.89, 0.05)) for g, rows in groups.items()}


@pytest.mark.parametrize(
    "true,found,expected",
    [
        ([], [], (1, 1, 1)),
        ([], ["S2-123"], (0, 0, 0)),
        (["S2-123"], [], (0, 0, 0)),
        (["S2-123"], ["S2-123"], (1, 1, 1)),
        (["S2-A", "S3-B"], ["S2-A"], (1, 0.5, 5 / 6)),
        (["S2-A"], ["S2-A", "S3-B"], (0.5, 1, 5 / 9)),
    ],
)
def test_f_half(spark, true, found, expected):
    rows = spark.createDataFrame([(true, found)], "a array<string>, b array<string>")
    got = rows.select(evaluate.entity_f_beta(F.col("a"), F.col("b")).alias("s")).first()["s"]
    assert tuple(got) == pytest.approx(expected)


def test_macro_counts_singletons(spark):
    truth = spark.createDataFrame([("S1-1", ["S2-1"]), ("S1-2", [])], "source1_entity_id string, ids array<string>")
    found = spark.createDataFrame([("S1-1", ["S2-1"]), ("S1-9", ["S2-9"])], "source1_entity_id string, ids array<string>")
    got = evaluate.evaluate_predictions(truth, found).first()
    assert (got["macro_f05"], got["singleton_accuracy"], got["singleton_count"], got["total_entities"]) == (1, 1, 1, 2)


def test_outputs_round_trip(spark, tmp_path):
    s1 = spark.createDataFrame([(f"S1-{i}", "n", "a", "US") for i in (100, 200, 300)], RAW)
    pairs = "source1_entity_id string, candidate_entity_id string"
    accepted = spark.createDataFrame([("S1-100", "S3-1"), ("S1-100", "S2-1"), ("S1-200", "S2-5")], pairs)
    tables.write_outputs(s1, accepted, accepted, str(tmp_path / "out"))
    rows = tables.read_tsv(spark, str(tmp_path / "out/matching_results.tsv"), tables.RESULTS).collect()
    assert sorted(map(tuple, rows)) == [("S1-100", "S2-1,S3-1"), ("S1-200", "S2-5"), ("S1-300", "")]
    with pytest.raises(ValueError, match="Integrity Violation"):
        tables.write_outputs(s1, accepted, accepted.where("candidate_entity_id <> 'S2-5'"), str(tmp_path / "bad"))


def test_tsv_keeps_text(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-1\tNA\t\t"a ""q"""\n')
    assert tuple(tables.read_tsv(spark, str(tmp_path / "a.tsv")).first()) == ("S2-1", "NA", "", 'a "q"')
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_tsv(spark, str(tmp_path / "none.tsv")).first()


def test_source_checks(spark):
    good = spark.createDataFrame([("S2-1", "", "a", "US"), ("S2-2", "b", "", "US")], RAW)
    assert audit.check_source(good, "S2-")["empty_names_pct"] == 50.0
    for bad in (good.unionByName(good), good.drop("country"), good.withColumn("entity_id", F.lit("S3-1"))):
        with pytest.raises(ValueError):
            audit.check_source(bad, "S2-")


def test_nine_situations(spark):
    s1 = [
        ("S1-1", "Acme Tools Inc", "12 Newton Street, Dayton 45402", "US"),
        ("S1-2", "Lotus Traders Pvt Ltd", "7 Gandhi Nagar, Pune 411001", "India"),
        ("S1-3", "Blue Harbor Cafe", "90 Lake Road, Dayton 45405", "US"),
        ("S1-4", "Zenith", "3 Hill Lane, Oslo 0150", "Norway"),
        ("S1-5", "Nobody Else", "1 Empty Way, Dayton 45499", "US"),
    ]
    s2 = [
        ("S2-1", "Acme Tools", "12 Newton Street, Dayton 45402", "US"),  # abbreviation
        ("S2-2", "Lotus Tradres Pvt Ltd", "7 Gandhi Nagar, Pune 411001", "India"),  # typo
        ("S2-3", "Blue Harbor Cafe", "Dayton 45405, 90 Lake Road", "US"),  # reordered address
        ("S2-4", "Acme Tools Inc", "500 Wayne Avenue, Dayton 99999", "US"),  # same name elsewhere
        ("S2-5", "Zenith", "3 Hill Lane, Oslo 0150", "Norway"),  # unseen country
    ]
    s3 = [("S3-1", "Acme Tools Inc", "12 Newton Street, Dayton 45402", "US"), ("S3-2", "Blue Harbor Cafe", "", "US")]  # several; no address
    make = lambda rows: spark.createDataFrame(rows, RAW)
    candidates, decided = link(make(s1), make(s2), make(s3))
    got = {r["source1_entity_id"]: r["ids"] for r in decide.matches(decided).collect()}
    found = {tuple(r) for r in candidates.select("source1_entity_id", "candidate_entity_id").collect()}
    assert {("S1-2", "S2-2"), ("S1-3", "S3-2")} <= found
    assert got["S1-1"] == ["S2-1", "S3-1"] and got["S1-3"] == ["S2-3"] and got["S1-4"] == ["S2-5"] and "S1-5" not in got


def test_stored_views_keep_one_row_of_an_id(spark, tmp_path):
    rows = [("S2-1", "Zeta Ltd", "1 Lake Road", "US"), ("S2-1", "Alpha Ltd", "1 Lake Road", "US"), ("S2-2", "Ｂｅｔａ", "", "India")]
    raw = spark.createDataFrame(rows, RAW)
    tables.store_views(raw.repartition(3), str(tmp_path / "a"), "S2")
    got = {r["entity_id"]: r for r in spark.read.parquet(str(tmp_path / "a")).collect()}
    assert {k: (r["name_clean"], r["source"], r["country"]) for k, r in got.items()} == {"S2-1": ("alpha ltd", "S2", "US"), "S2-2": ("beta", "S2", "India")}
    numbered = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{RAW}, line_no long")
    tables.store_views(numbered, str(tmp_path / "b"), "S2")
    tables.store_views(raw.where("false"), str(tmp_path / "b"), "S2")  # exists: nothing is done
    assert sorted(r["name_clean"] for r in spark.read.parquet(str(tmp_path / "b")).collect()) == ["beta", "zeta ltd"]


def test_numeric_order(spark):
    ids = ["S1-10", "S1-9", "S1-100", "S1-1"]
    rows = spark.createDataFrame([(i,) for i in ids], "entity_id string")
    assert [r["entity_id"] for r in tables.numeric_order(rows).collect()] == ["S1-1", "S1-9", "S1-10", "S1-100"]
