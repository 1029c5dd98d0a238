"""The twenty-one features of a candidate pair, and a fixed scorer over them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright import vocab
from linkwright.functions import similarity as S
from linkwright.functions import text as T

VIEWS = ("name_clean", "name_compact", "name_no_legal", "name_compact_core", "address_clean", "postal_code", "numbers")

#: Weights of the fixed logistic scorer, by feature, and its intercept.
LOGISTIC = {
    "exact_compact": 2.0, "exact_core": 1.5, "exact_leet": 0.5, "name_jw": 1.0, "core_jw": 2.0,
    "name_jaccard": 1.0, "name_containment": 0.5, "core_jaccard": 0.5, "addr_jaccard": 2.0,
    "addr_containment": 0.5, "addr_jw": 1.5, "postal_match": 1.5, "postal_conflict": -4.0,
    "nums_jaccard": 1.0, "nums_conflict": -2.0, "name_strong_addr_strong": 1.0,
    "name_strong_addr_conflict": -2.0,
}
INTERCEPT = -6.0


def _flag(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


#: Views that are compared as sets of tokens.
TOKENS = ("name_clean", "address_clean")


def _side(rows: DataFrame, letter: str, core: str) -> DataFrame:
    """Views of one side as columns of that letter, with their token sets, which are made once a record."""
    out = rows.withColumnsRenamed({v: f"{letter}_{v}" for v in VIEWS})
    sets = {f"{letter}s_{v}": F.array_distinct(T.tokens(F.col(f"{letter}_{v}"))) for v in {*TOKENS, core}}
    return out.withColumns(sets | {f"{letter}s_numbers": F.array_distinct(f"{letter}_numbers")})


def pair_features(
    candidates: DataFrame,
    queries: DataFrame,
    targets: DataFrame,
    core_view: str = "compact",
    parts: int | None = None,
    only: Column | None = None,
    jaro: Column | None = None,
) -> DataFrame:
    """candidates with the 21 features; queries and targets: normalised views.

    core_view: compact compares core names without spaces, spaced with them, on both sides.
    parts: candidates and queries have a bucket (blocking.dealt) and candidates lie by it.  Then
    each bucket gets the views of its candidates once, and the pairs stay where they are.
    only, jaro: conditions over the features that need no Jaro similarity.  Pairs that don't meet
    only are left out; those that don't meet jaro have null similarities, which are not computed.
    """
    if core_view not in ("compact", "spaced"):
        raise ValueError("core_view must be compact or spaced")
    core = "name_compact_core" if core_view == "compact" else "name_no_legal"
    own = [] if parts is None else ["bucket"]
    a = queries.select(*own, F.col("entity_id").alias("source1_entity_id"), *VIEWS)
    b = targets.select(F.col("entity_id").alias("candidate_entity_id"), *VIEWS)
    if parts is not None:
        a = a.repartition(parts, "bucket")
        b = candidates.select("bucket", "candidate_entity_id").distinct().join(b, "candidate_entity_id").repartition(parts, "bucket")
    a, b = _side(a, "a", core), _side(b, "b", core)
    if parts is not None:
        a, b = a.hint("shuffle_hash"), b.hint("shuffle_hash")
    rows = candidates.join(a, [*own, "source1_entity_id"]).join(b, [*own, "candidate_entity_id"])

    def pair(view: str) -> tuple[Column, Column]:
        return F.col(f"a_{view}"), F.col(f"b_{view}")

    def sets(view: str) -> tuple[Column, Column]:
        return F.col(f"as_{view}"), F.col(f"bs_{view}")

    (nx, ny), (cx, cy), (kx, ky), (ax, ay) = pair("name_clean"), pair("name_compact"), pair(core), pair("address_clean")
    (px, py), nums = pair("postal_code"), sets("numbers")
    both_postal, both_nums = (px != "") & (py != ""), (F.size(nums[0]) > 0) & (F.size(nums[1]) > 0)
    longest = F.greatest(F.length(nx), F.length(ny), F.lit(1))
    rows = rows.withColumns(
        {
            "exact_compact": _flag((cx != "") & (cx == cy)),
            "exact_core": _flag((kx != "") & (kx == ky)),
            "exact_leet": _flag((T.leet(cx) != "") & (T.leet(cx) == T.leet(cy))),
            "name_jaccard": S.token_jaccard(*sets("name_clean")),
            "name_containment": S.token_containment(*sets("name_clean")),
            "core_jaccard": S.token_jaccard(*sets(core)),
            "len_ratio": F.least(F.length(nx), F.length(ny)).cast("double") / longest,
            "addr_jaccard": S.token_jaccard(*sets("address_clean")),
            "addr_containment": S.token_containment(*sets("address_clean")),
            "postal_match": _flag(both_postal & (px == py)),
            "postal_conflict": _flag(both_postal & (px != py)),
            "nums_jaccard": F.when(both_nums, S.token_jaccard(*nums)).otherwise(0.0),
            "nums_conflict": _flag(both_nums & (F.size(F.array_intersect(*nums)) == 0)),
        }
    )
    if only is not None:
        rows = rows.where(only)

    def winkler(x: Column, y: Column) -> Column:
        return S.jaro_winkler(x, y) if jaro is None else S.jaro_winkler(F.when(jaro, x), F.when(jaro, y))

    rows = rows.withColumns(
        {
            "name_jw": winkler(nx, ny),
            "core_jw": winkler(kx, ky),
            "addr_jw": winkler(F.substring(ax, 1, 50), F.substring(ay, 1, 50)),
        }
    )
    rows = rows.withColumns(
        {
            "name_strong_addr_strong": _flag((F.col("core_jw") >= 0.85) & (F.col("addr_jaccard") >= 0.4)),
            "name_strong_addr_conflict": _flag((F.col("core_jw") >= 0.9) & (F.col("postal_conflict") == 1.0)),
            "is_s2": _flag(F.col("candidate_source") == "S2"),
            "retrieval_score": F.coalesce(F.col("retrieval_score").cast("double"), F.lit(0.0)),
            "channel_count": F.coalesce(F.col("channel_count").cast("double"), F.lit(1.0)),
        }
    )
    keep = [c for c in ("country", "candidate_source", "bucket", "label", "fold") if c in candidates.columns]
    return rows.select("source1_entity_id", "candidate_entity_id", *keep, *vocab.FEATURES)


def score_logistic(features: DataFrame) -> DataFrame:
    """features with probability, by fixed weights."""
    z = F.lit(INTERCEPT)
    for name, w in LOGISTIC.items():
        z = z + F.col(name) * F.lit(w)
    return features.withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))


def may_reach(least: float) -> Column:
    """Whether score_logistic may give this probability, whatever the Jaro similarities are, by the other features.

    What needs no sets of tokens is looked at first, so that most pairs need none.
    """
    limit = math.log(least / (1 - least)) - 1e-6
    best = {"name_jw": F.lit(1.0), "core_jw": F.lit(1.0), "addr_jw": F.lit(1.0), "name_strong_addr_conflict": F.lit(0.0)}
    sets = {name: F.lit(1.0) for name in LOGISTIC if name.endswith(("_jaccard", "_containment"))}
    sets |= {"nums_conflict": F.lit(0.0), "name_strong_addr_strong": F.lit(1.0)}

    def most(known: dict[str, Column]) -> Column:
        z = F.lit(INTERCEPT)
        for name, w in LOGISTIC.items():
            z = z + known.get(name, F.col(name)) * F.lit(w)
        return z

    strong = {"name_strong_addr_strong": _flag(F.col("addr_jaccard") >= 0.4)}
    return (most(best | sets) >= limit) & (most(best | strong) >= limit)
