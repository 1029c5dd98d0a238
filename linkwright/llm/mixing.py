"""Mixing sources to target weights by hierarchical budgeting (operator 9, native).

A token budget flows down a tree of domain, language and source.  At each node it is
dealt to the children by weight; a child gets no more than its subtree can supply (the
tokens there, times the epochs allowed), and what it cannot use goes to its siblings by
weight.  Only what a whole subtree cannot use reaches the node above, so shortages move
among siblings before ancestors.

Each leaf then takes its budget as whole epochs of all its documents and a prefix of one
more, in an order seeded per epoch.  The prefix ends at a key, found without sorting the
leaf: tokens are summed by the leading hex digits of the order key, and only documents
under the digits where the budget ends are looked at again, until few are left.

All operations are DataFrame operations.  Budgets are whole tokens, rounded down.
A token here is a word between white space, so that the same count can be had from SQL; it is
not a token of a tokenizer (op10): a long text without spaces counts as one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.llm.common import stage, table

LEAF = ("domain", "lang", "source")
#: Hex digits of the order key by which tokens are summed at each step.
DIGITS = 2
#: Documents of one leaf that are put in order in one task at most, unless their keys are equal.
ORDERED = 2_000
#: Leaves that are broadcast at most (about 200 bytes each).
MOST_LEAVES = 50_000


@dataclass(frozen=True)
class Plan:
    """Weights by name (1 for others), the budget as share of all tokens, epochs, and seed."""

    domain: dict[str, int] = field(default_factory=lambda: {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1})
    lang: dict[str, int] = field(default_factory=lambda: {"en": 5, "de": 2, "fr": 2, "es": 1})
    source: dict[str, int] = field(default_factory=dict)
    share: tuple[int, int] = (9, 10)
    epochs: int = 2
    seed: int = 17


def domain_of(source: Column) -> Column:
    """Four domains by the number that ends a source's name; 'other' without one."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]+)$", 1)
    return F.when(number == "", "other").otherwise(F.concat(F.lit("domain"), (F.substring(number, -4, 4).cast("int") % 4).cast("string")))


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(name: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for key, w in weights.items():
        out = F.when(F.col(name) == key, w).otherwise(out)
    return out.cast("long")


def deal(nodes: DataFrame, over: list[str], child: str, weight: Column) -> DataFrame:
    """Deal `budget` of the nodes above to their children: columns over, child, cap, budget -> share.

    The children that get their whole cap are those with the least cap per weight.
    """
    rows = nodes.withColumn("w", weight)
    group = Window.partitionBy(*over) if over else Window.partitionBy(F.lit(0))
    order = group.orderBy((F.col("cap") / F.when(F.col("w") > 0, F.col("w"))).asc_nulls_last(), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    rows = rows.withColumn("weights", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    rows = rows.withColumn("full", (F.col("w") > 0) & (F.col("cap") * F.col("weights") <= F.col("w") * F.col("left")))
    rows = rows.withColumn("left", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0)))
    rows = rows.withColumn("weights", F.sum(F.when(~F.col("full"), F.col("w"))).over(group))
    part = F.when((F.col("weights") > 0) & (F.col("left") > 0), F.expr("w * left div weights")).otherwise(F.lit(0))
    return rows.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", part)).cast("long")).drop(
        "w", "left", "weights", "full"
    )


def budgets(leaves: DataFrame, plan: Plan) -> DataFrame:
    """LEAF, docs, tokens, share: what each leaf may take; leaves: LEAF, docs, tokens."""
    caps = leaves.withColumn("cap", F.col("tokens") * plan.epochs)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"))
    num, den = plan.share
    top = caps.groupBy("domain").agg(F.sum("cap").alias("cap"))
    top = top.join(F.broadcast(total.select(F.expr(f"all * {num} div {den}").alias("budget"))))  # one row
    dealt = deal(top, [], "domain", _weight("domain", plan.domain)).select("domain", F.col("share").alias("budget"))
    mid = caps.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(dealt, "domain")
    dealt = deal(mid, ["domain"], "lang", _weight("lang", plan.lang)).select("domain", "lang", F.col("share").alias("budget"))
    low = caps.join(dealt, ["domain", "lang"])
    return deal(low, ["domain", "lang"], "source", _weight("source", plan.source)).select(*LEAF, "docs", "tokens", "share")


def order_key(plan: Plan, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(plan.seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))


def cuts(rows: DataFrame, shares: DataFrame, plan: Plan) -> DataFrame:
    """LEAF, whole (epochs taken whole), cut (the last order key of the epoch after them, or null).

    rows: LEAF, doc_id, n_tokens.
    """
    leaf = list(LEAF)
    whole = F.when(F.col("tokens") > 0, F.least(F.expr("share div tokens"), F.lit(plan.epochs))).otherwise(0).cast("int")
    state = shares.select(*leaf, "docs", whole.alias("whole"), F.when(F.col("tokens") > 0, F.expr("share % tokens")).otherwise(0).alias("rest"))
    state = stage(state.withColumn("prefix", F.lit("")), "leaves")
    wide = state.count() > MOST_LEAVES

    def beside(small: DataFrame) -> DataFrame:
        return small if wide else F.broadcast(small)

    keyed = rows.join(beside(state.where(F.col("whole") < plan.epochs).select(*leaf, "whole")), leaf)
    keyed = keyed.select(*leaf, order_key(plan, F.col("whole") + 1).alias("key"), "n_tokens")
    # the last key so far that surely is in the prefix
    state = state.withColumn("cut", F.lit(None).cast("string"))
    while True:
        length = F.length("prefix")
        under = keyed.join(beside(state.where("prefix is not null").select(*leaf, "prefix", "rest")), leaf).where(F.col("key").startswith(F.col("prefix")))
        largest = state.where("prefix is not null").agg(F.max("docs").alias("m")).first()["m"] or 0
        depth = state.where("prefix is not null").agg(F.max(length).alias("m")).first()["m"] or 0
        last = largest <= ORDERED or depth + DIGITS > 32
        step = under.withColumn("bin", F.col("key") if last else F.substring("key", 1, depth + DIGITS))
        sums = step.groupBy(*leaf, "bin").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("docs"), F.max("key").alias("top"), F.max("rest").alias("rest"))
        run = Window.partitionBy(*leaf).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.sum("n").over(run))
        inside = sums.where("upto <= rest").groupBy(*leaf).agg(F.max("top").alias("in_top"), F.max("upto").alias("in_sum"))
        beyond = sums.where("upto > rest").groupBy(*leaf).agg(F.min(F.struct("bin", "docs")).alias("next"))
        new = state.join(beside(inside), leaf, "left").join(beside(beyond), leaf, "left")
        going = F.col("next").isNotNull() & F.lit(not last)
        state = stage(
            new.select(
                *leaf,
                F.when(going, F.col("next.docs")).otherwise(F.lit(0)).cast("long").alias("docs"),
                "whole",
                (F.col("rest") - F.coalesce("in_sum", F.lit(0))).alias("rest"),
                F.when(going, F.col("next.bin")).alias("prefix"),
                F.coalesce("in_top", "cut").alias("cut"),
            ),
            "leaves",
        )
        if last:
            return state.select(*leaf, "whole", "cut")


def mixed(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The columns of docs with domain, n_tokens and epoch added: a row for each time a document is taken.

    Columns of docs with these names are replaced.  A null lang or source is a leaf name
    of its own ('' in the tree); a null or empty text has no tokens and is taken if its key
    comes before the end of its leaf's prefix.  Rows that repeat a doc_id, or have
    none, share an order key: they are taken together or not at all in an unfinished epoch.
    An empty table gives an empty result.
    """
    keep = [c for c in docs.columns if c not in ("domain", "n_tokens", "epoch")]
    named = {"_domain": domain_of(F.col("source")), "_lang": F.coalesce("lang", F.lit("")), "_source": F.coalesce("source", F.lit(""))}
    leafed = docs.select(*keep, *[c.alias(n) for n, c in named.items()], n_tokens(F.col("text")).alias("n_tokens"))
    rows = stage(leafed.select(*[F.col(f"_{n}").alias(n) for n in LEAF], "doc_id", "n_tokens"), "rows")
    leaves = stage(rows.groupBy(*LEAF).agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens")), "leaves")
    ends = cuts(rows, stage(budgets(leaves, plan), "budgets"), plan)
    ends = ends.select(*[F.col(n).alias(f"_{n}") for n in LEAF], F.col("whole").alias("_whole"), F.col("cut").alias("_cut"))
    ends = ends if leaves.count() > MOST_LEAVES else F.broadcast(ends)
    out = leafed.join(ends, [f"_{n}" for n in LEAF])
    more = (F.col("_whole") < plan.epochs) & (order_key(plan, F.col("_whole") + 1) <= F.col("_cut"))
    count = F.col("_whole") + F.when(more, 1).otherwise(0)
    epochs = F.when(count > 0, F.sequence(F.lit(1), count))
    return out.select(*keep, F.col("_domain").alias("domain"), "n_tokens", F.explode(epochs).alias("epoch"))


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    found = mixed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "domain", "lang", "source", "epoch", "n_tokens")


#: For the pipeline: one epoch, so that no document is repeated.
ONCE = Plan(share=(9, 10), epochs=1)


def keep_mixed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the mix takes, with the columns of docs."""
    return mixed(docs, ONCE).select(*docs.columns)


def _case(column: str, weights: dict[str, int]) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {w}" for k, w in weights.items()) + " ELSE 1 END" if weights else "1"


def _deal_sql(name: str, source: str, over: str, child: str, weight: str) -> str:
    by = f"PARTITION BY {over}" if over else ""
    return f"""
{name}_a AS (SELECT *, {weight} AS w FROM ({source})),
{name}_b AS (SELECT *, budget - coalesce(sum(cap) OVER ({by} ORDER BY cap / w, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l,
  sum(w) OVER ({by} ORDER BY cap / w, {child} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM {name}_a),
{name}_c AS (SELECT *, cap * ws <= w * l AS f FROM {name}_b),
{name}_d AS (SELECT * EXCLUDE (l, ws), budget - coalesce(sum(cap) FILTER (WHERE f) OVER ({by}), 0) AS l,
  sum(w) FILTER (WHERE NOT f) OVER ({by}) AS ws FROM {name}_c),
{name} AS (SELECT * EXCLUDE (l, ws, w, f, budget), CAST(CASE WHEN f THEN cap WHEN ws > 0 AND l > 0 THEN least(cap, w * l // ws) ELSE 0 END AS BIGINT) AS share FROM {name}_d)"""


def sql(plan: Plan = Plan()) -> str:
    """The same rows from DuckDB, with one sorted window for each leaf."""
    num, den = plan.share
    return f"""
WITH rows AS (
  SELECT doc_id, lang AS lang0, source AS source0, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' THEN 'other'
      ELSE 'domain' || CAST(CAST(right(regexp_extract(source, '([0-9]+)$', 1), 4) AS INTEGER) % 4 AS VARCHAR) END AS domain,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) AS BIGINT) * {plan.epochs} AS cap FROM rows GROUP BY ALL
),{_deal_sql("d1", f"SELECT domain, CAST(sum(cap) AS BIGINT) AS cap, (SELECT CAST(sum(tokens) AS BIGINT) * {num} // {den} FROM leaves) AS budget FROM leaves GROUP BY domain", "", "domain", _case("domain", plan.domain))},
{_deal_sql("d2", "SELECT l.domain, l.lang, CAST(sum(l.cap) AS BIGINT) AS cap, any_value(d1.share) AS budget FROM leaves l JOIN d1 ON l.domain = d1.domain GROUP BY l.domain, l.lang", "domain", "lang", _case("lang", plan.lang))},
{_deal_sql("d3", "SELECT l.*, d2.share AS budget FROM leaves l JOIN d2 ON l.domain = d2.domain AND l.lang = d2.lang", "domain, lang", "source", _case("source", plan.source))},
ends AS (
  SELECT domain, lang, source, CASE WHEN tokens > 0 THEN least(share // tokens, {plan.epochs}) ELSE 0 END AS whole,
    CASE WHEN tokens > 0 THEN share % tokens ELSE 0 END AS rest FROM d3
), placed AS (
  SELECT r.*, e.whole, e.rest, md5('{plan.seed}:' || CAST(e.whole + 1 AS VARCHAR) || ':' || coalesce(CAST(r.doc_id AS VARCHAR), 'null')) AS key
  FROM rows r JOIN ends e ON r.domain = e.domain AND r.lang = e.lang AND r.source = e.source
), run AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM placed
), taken AS (
  SELECT *, whole + CASE WHEN whole < {plan.epochs} AND upto <= rest THEN 1 ELSE 0 END AS times FROM run
)
SELECT doc_id, domain, lang0 AS lang, source0 AS source, CAST(unnest(range(1, times + 1)) AS INTEGER) AS epoch, n_tokens FROM taken
"""
