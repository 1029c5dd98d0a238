"""Candidate retrieval: equi-joins on derived keys within a country.

Every blocker turns both sides into (country, channel, key) rows and joins once.  A
channel's limit is independent of the query, so each key's list is cut to the limit
before the join: a hot key cannot fan out.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright import vocab
from linkwright.functions import text as T

#: channel: (column of the target's key, limit, score).  Fixed values.
CHANNELS = {
    "exact_compact": ("name_compact", 60, 10.0),
    "exact_core": ("name_compact_core", 60, 10.0),
    "exact_sorted": ("name_sorted", 60, 10.0),
    "addr_anchor": ("addr_anchor", 50, 7.0),
    "name_token": ("tok1", 30, 5.0),
    "addr_token": ("addr_tok1", 30, 5.0),
}
#: Limits of the older retrieval.  Fixed values.
OLD_LIMITS = {"exact_compact": 20, "exact_core": 20, "exact_sorted": 20, "addr_anchor": 25, "name_token": 15, "addr_token": 15}
DEFAULT_CAP = 150
#: Queries whose candidates one partition holds.
QUERIES_A_BUCKET = 2000
#: Queries that one group of block_inverted holds, and ids of a key that one row holds.
QUERIES_A_GROUP = 10_000
PIECE = 4096


def _stacked(rows: DataFrame, keep: list[str], keys: dict[str, Column]) -> DataFrame:
    """keep, channel, key: one row for each entry of the key arrays."""

    def entries_of(channel: str, values: Column) -> Column:
        return F.transform(values, lambda k: F.struct(F.lit(channel).alias("channel"), k.alias("key")))

    entries = [entries_of(c, ks) for c, ks in keys.items()]
    return rows.select(*keep, F.explode(F.concat(*entries)).alias("e")).select(*keep, "e.channel", "e.key")


def target_keys(targets: DataFrame, source: str, limits: dict[str, int]) -> DataFrame:
    """Keys of a target table, each list cut to its channel's limit by entity_id."""
    rows = targets.select("entity_id", "country", *{c for c, _, _ in CHANNELS.values()})
    keys = _stacked(rows, ["entity_id", "country"], {ch: F.array(T.text(F.col(col))) for ch, (col, _, _) in CHANNELS.items()})
    order = Window.partitionBy("country", "channel", "key").orderBy("entity_id")
    most = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    ranked = keys.withColumn("place", F.row_number().over(order)).where(F.col("place") <= max(limits.values()))
    return ranked.where(F.col("place") <= most[F.col("channel")]).select(
        F.col("entity_id").alias("candidate_entity_id"), F.lit(source).alias("candidate_source"), "country", "channel", "key"
    )


def query_keys(queries: DataFrame, accents: bool = True, generic_gate: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keys of the queries: spelling variants on channels 1 and 2, gates on 4 to 6; keep: more columns to keep."""
    compact, core = F.col("name_compact"), F.col("name_compact_core")
    tok, street = F.col("tok1"), F.col("addr_tok1")
    plain = (lambda c: T.strip_accents(c)) if accents else (lambda c: c)
    keys = {
        "exact_compact": F.array_distinct(F.array(compact, plain(compact), T.leet(plain(compact)))),
        "exact_core": F.array_distinct(F.array(core, plain(core), T.leet(plain(core)), T.clean_extra_legal(core))),
        "exact_sorted": F.array(F.col("name_sorted")),
    }

    def gated(value: Column, keep: Column) -> Column:
        return F.when(keep, F.array(value)).otherwise(F.array().cast("array<string>"))

    telling = (F.length(tok) >= 4) & (~tok.isin(*vocab.GENERIC_NAME_TOKENS) if generic_gate else F.lit(True))
    keys["addr_anchor"] = gated(F.col("addr_anchor"), F.col("addr_anchor") != "")
    keys["name_token"] = gated(tok, telling)
    keys["addr_token"] = gated(street, F.length(street) >= 4)
    return _stacked(queries.withColumnRenamed("entity_id", "source1_entity_id"), ["source1_entity_id", "country", *keep], keys)


def channel_hits(queries: DataFrame, targets: dict[str, DataFrame], limits: dict[str, int] | None = None, **gates) -> DataFrame:
    """(query, target, channel) rows within each channel's limit by key, then entity_id."""
    limits = limits or {c: n for c, (_, n, _) in CHANNELS.items()}
    lists = None
    for source, rows in targets.items():
        keys = target_keys(rows, source, limits)
        lists = keys if lists is None else lists.unionByName(keys)
    hits = query_keys(queries, **gates).join(lists, ["country", "channel", "key"])
    order = Window.partitionBy("source1_entity_id", "candidate_source", "channel").orderBy("key", "candidate_entity_id")
    most = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    ranked = hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= max(limits.values()))
    return ranked.where(F.col("place") <= most[F.col("channel")]).drop("place")


def _scored(rows: DataFrame, channel: str) -> DataFrame:
    score = F.lit(5.0)
    for c, (_, _, s) in CHANNELS.items():
        score = F.when(F.col(channel) == c, s).otherwise(score)
    return rows.select(
        "source1_entity_id",
        "candidate_entity_id",
        "candidate_source",
        "country",
        F.col(channel).alias("retrieval_channels"),
        score.alias("retrieval_score"),
        F.lit(1).alias("channel_count"),
        *[c for c in ("bucket",) if c in rows.columns],
    )


def dealt(queries: DataFrame) -> tuple[DataFrame, int]:
    """queries with a bucket, and how many buckets there are.

    Queries of one core name are dealt to one bucket, all rows of an id too.  The candidates
    of a bucket are worked on in one partition, so that there is one for 2,000 queries.
    """
    spark = queries.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-queries.count() // QUERIES_A_BUCKET))
    # rows that lie together by bucket are joined by (bucket, id) where they are
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    bucket = F.pmod(F.hash("country", "name_compact_core"), F.lit(parts))
    return queries.withColumn("bucket", F.min(bucket).over(Window.partitionBy("entity_id"))), parts


def block(queries: DataFrame, targets: dict[str, DataFrame], cap: int = DEFAULT_CAP, parts: int | None = None, **gates) -> DataFrame:
    """Candidates of six channels, one row a pair, with the alphabetically first channel.

    The cap counts S2 first: S3 gets max(1, cap - kept of S2), each by entity_id.  Pairs are
    made within a query's row, from the lists of its keys, and are never shuffled; a list goes
    to a query whole, and to queries of one bucket next to each other.  With parts, from
    dealt(), queries have their bucket, and so have the candidates.
    """
    if parts is None:
        own, n = dealt(queries)
        return block(own, targets, cap, n, **gates).drop("bucket")
    limits = {c: n for c, (_, n, _) in CHANNELS.items()}
    lists = None
    for source, rows in targets.items():
        ids = F.sort_array(F.collect_list("candidate_entity_id")).alias("ids")
        part = target_keys(rows, source, limits).groupBy("country", "channel", "key").agg(ids).withColumn("source", F.lit(source))
        lists = part if lists is None else lists.unionByName(part)
    found = query_keys(queries, keep=("bucket",), **gates).join(lists, ["country", "channel", "key"])
    # explicit parts: what is small here has many pairs, so that partitions must not be merged
    each = found.repartition(parts, "bucket").groupBy("bucket", "source1_entity_id", "country")
    each = each.agg(F.collect_list(F.struct("channel", "source", "key", "ids")).alias("lists"))
    named = F.transform("lists", lambda x: F.struct(x["channel"], x["source"], x["key"]))
    once = F.when(F.size("lists") > F.size(F.array_distinct(named)), F.array_distinct("lists")).otherwise(F.col("lists"))
    each = each.withColumn("lists", F.sort_array(once))
    order = sorted(limits)

    def of(source: str, channel: str) -> Column:
        mine = F.filter("lists", lambda x: (x["source"] == source) & (x["channel"] == channel))
        return F.slice(F.flatten(F.transform(mine, lambda x: x["ids"])), 1, limits[channel])

    for i, source in enumerate(targets):  # the ids of the channels up to the kth are u_i_k, in order of channel
        each = each.withColumn(f"u_{i}_0", F.array_distinct(of(source, order[0])))
        for k in range(1, len(order)):
            each = each.withColumn(f"u_{i}_{k}", F.array_union(f"u_{i}_{k - 1}", of(source, order[k])))
    each = each.drop("lists")
    last = len(order) - 1
    sizes = {source: F.size(f"u_{i}_{last}") for i, source in enumerate(targets)}
    first = F.least(F.lit(cap), sizes["S2"]) if "S2" in sizes else F.lit(0)

    def entries_of(i: int, source: str, k: int) -> Column:
        """What the kth channel is the first to find, up to the last id that is kept."""
        before = F.size(f"u_{i}_{k - 1}") if k else F.lit(0)
        new = F.slice(f"u_{i}_{last}", before + 1, F.size(f"u_{i}_{k}") - before)
        kept = F.filter(new, lambda c: c <= F.col(f"to_{i}"))
        return F.transform(kept, lambda c: F.struct(c.alias("candidate_entity_id"), F.lit(source).alias("candidate_source"), F.lit(order[k]).alias("channel")))

    for i, source in enumerate(targets):
        most = F.lit(cap) if source == "S2" else F.greatest(F.lit(1), F.lit(cap) - first)
        each = each.withColumn(f"to_{i}", F.try_element_at(F.sort_array(f"u_{i}_{last}"), F.greatest(F.lit(1), F.least(most, sizes[source]))))
    entries = [entries_of(i, source, k) for i, source in enumerate(targets) for k in range(len(order))]
    pairs = each.select("bucket", "source1_entity_id", "country", F.inline(F.concat(*entries)))
    return _scored(pairs, "channel")


def capped(pairs: DataFrame, cap: int) -> DataFrame:
    order = Window.partitionBy("source1_entity_id", "candidate_source").orderBy("candidate_entity_id")
    ranked = pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= cap)
    whole = Window.partitionBy("source1_entity_id")
    s2 = F.sum(F.when(F.col("candidate_source") == "S2", 1).otherwise(0)).over(whole)
    most = F.when(F.col("candidate_source") == "S2", cap).otherwise(F.greatest(F.lit(1), cap - s2))
    return ranked.withColumn("most", most).where(F.col("place") <= F.col("most")).drop("place", "most")


def block_old(queries: DataFrame, targets: dict[str, DataFrame], cap: int = DEFAULT_CAP) -> DataFrame:
    """The older retrieval: smaller limits, no variants or generic-word gate, a row for each channel, a cap for each table."""
    keys = query_keys(queries, accents=False, generic_gate=False)
    first = {"exact_compact": "name_compact", "exact_core": "name_compact_core"}
    for channel, column in first.items():  # the spelling as it is only
        own = queries.select(F.col("entity_id").alias("source1_entity_id"), F.lit(channel).alias("channel"), F.col(column).alias("key"))
        keys = keys.join(own, ["source1_entity_id", "channel", "key"], "left_semi").unionByName(keys.where(F.col("channel") != channel))
    lists = None
    for source, rows in targets.items():
        part = target_keys(rows, source, OLD_LIMITS)
        lists = part if lists is None else lists.unionByName(part)
    hits = keys.join(lists, ["country", "channel", "key"])
    rank = F.create_map(*[F.lit(x) for pair in ((c, i) for i, c in enumerate(CHANNELS)) for x in pair])
    order = Window.partitionBy("source1_entity_id", "candidate_source").orderBy(rank[F.col("channel")], "candidate_entity_id")
    return _scored(hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= cap), "channel")


#: channel: (weight, longest list that is used; 0: any).  Fixed values.
INVERTED = {
    "exact_compact": (25.0, 0),
    "exact_core": (20.0, 0),
    "exact_sorted": (18.0, 0),
    "name_token": (4.0, 3000),
    "addr_token": (3.5, 2500),
    "postal_number": (6.0, 300),
    "prefix": (2.0, 1000),
}


def _inverted_keys(rows: DataFrame, as_target: bool) -> DataFrame:
    core, compact = F.col("name_compact_core"), F.col("name_compact")
    none = F.array().cast("array<string>")

    def one(value: Column, keep: Column) -> Column:
        return F.when(keep, F.array(value)).otherwise(none)

    number = F.try_element_at("numbers", F.lit(1))
    postal = F.concat_ws("_", "postal_code", number)
    keys = {
        "exact_compact": one(compact, compact != ""),
        "exact_core": one(core, (core != "") & ((core != compact) if as_target else F.lit(True))),
        "exact_sorted": one(F.col("name_sorted"), F.col("name_sorted") != ""),
        "name_token": F.filter(T.tokens(F.col("name_clean")), lambda t: (F.length(t) >= 3) & ~t.isin(*vocab.COMMON_NAME_STOPS)),
        "addr_token": F.filter(T.tokens(F.col("address_clean")), lambda t: (F.length(t) >= 4) & ~t.isin(*vocab.COMMON_ADDRESS_STOPS)),
        "postal_number": one(postal, (F.col("postal_code") != "") & number.isNotNull()),
        "prefix": one(F.substring(core, 1, 5), F.length(core) >= 5),
    }
    return _stacked(rows, ["entity_id", "country"], keys).groupBy("entity_id", "country", "channel", "key").agg(F.count("*").alias("tf"))


def _best_of_lists(top: int, asked: pa.Table, lists: pa.Table) -> pa.Table:
    """The best candidates of each query of a group, from the lists of all keys that the group asks for."""
    found: tuple[list, ...] = ([], [], [], [], [], [])
    names = sorted(INVERTED)
    if asked.num_rows and lists.num_rows:
        ids, tfts = lists["ids"].combine_chunks(), lists["tfts"].combine_chunks()
        ids, sizes = ids.flatten().dictionary_encode(), ids.value_lengths().to_numpy(zero_copy_only=False)
        words = ids.dictionary.to_pylist()
        order = sorted(range(len(words)), key=lambda i: words[i].encode("utf-8", "surrogatepass"))
        rank = np.empty(len(words), dtype=np.int64)
        rank[order] = np.arange(len(words))
        where = lists["country"].combine_chunks().dictionary_encode()
        lands = where.dictionary.to_pylist()
        code = rank[ids.indices.to_numpy()] * len(lands) + np.repeat(where.indices.to_numpy(), sizes)
        there, code = np.unique(code, return_inverse=True)  # in order of id
        tft, ends = tfts.flatten().to_numpy(), np.cumsum(sizes)
        pieces: dict[tuple, list[tuple[int, int]]] = {}
        for key, end, size in zip(zip(*(lists[c].to_pylist() for c in ("country", "channel", "key"))), ends, sizes):
            pieces.setdefault(key, []).append((end - size, end))
        queries: dict[str, list] = {}
        for who, tf, *key in zip(*(asked[c].to_pylist() for c in ("source1_entity_id", "tf", "country", "channel", "key"))):
            queries.setdefault(who, []).extend((a, b, tf, key[1]) for a, b in pieces.get(tuple(key), ()))
        place = np.full(len(there), -1)
        for who, parts in queries.items():
            if not parts:
                continue
            codes = np.concatenate([code[a:b] for a, b, _, _ in parts])
            hits = np.concatenate([tft[a:b] * tf for a, b, tf, _ in parts])
            long = [b - a for a, b, _, _ in parts]
            score = np.bincount(codes, hits * np.repeat([INVERTED[c][0] for *_, c in parts], long))
            some = np.flatnonzero(score)
            # twice a score is whole, as twice each weight is
            value = (2 * score[some]).astype(np.int64) * len(there) + (len(there) - 1 - some)
            best = np.argpartition(-value, top - 1)[:top] if len(some) > top else np.arange(len(some))
            best = some[best]
            place[best] = np.arange(len(best))
            at = place[codes]
            mine = at >= 0
            place[best] = -1
            bits = np.zeros(len(best), dtype=np.int64)
            np.bitwise_or.at(bits, at[mine], np.repeat([1 << names.index(c) for *_, c in parts], long)[mine])
            count = np.bincount(at[mine], hits[mine], minlength=len(best))
            word, land = np.divmod(there[best], len(lands))
            rows = ([who] * len(best), [words[order[i]] for i in word], [lands[i] for i in land], score[best], count, bits)
            for column, values in zip(found, rows):
                column.extend(values)
    kinds = (pa.string(), pa.string(), pa.string(), pa.float64(), pa.int32(), pa.int32())
    columns = ("source1_entity_id", "candidate_entity_id", "country", "retrieval_score", "channel_count", "bits")
    values = [pa.array(np.array(v, dtype="i4"), k) if k == pa.int32() else pa.array(v, k) for v, k in zip(found, kinds)]
    return pa.table(dict(zip(columns, values)))


def block_inverted(queries: DataFrame, targets: DataFrame, source: str, top: int = 80) -> DataFrame:
    """Additive scores over seven inverted lists; lists over their limit are cut by entity_id.

    The lists go to groups of queries, where a group's pairs are summed; pairs are never shuffled.
    A repeated token counts as often as it occurs on both sides.  retrieval_channels names
    up to five channels hit, in alphabetical order.
    """
    lists = _inverted_keys(targets, True).select(F.col("entity_id").alias("candidate_entity_id"), "country", "channel", "key", F.col("tf").alias("tft"))
    order = Window.partitionBy("country", "channel", "key").orderBy("candidate_entity_id").rowsBetween(Window.unboundedPreceding, -1)
    longest = F.create_map(*[F.lit(x) for c, (_, n) in INVERTED.items() for x in (c, n or 2**31 - 1)])
    before = F.coalesce(F.sum("tft").over(order), F.lit(0))
    lists = lists.withColumn("tft", F.least("tft", longest[F.col("channel")] - before)).where("tft > 0")
    # pieces of bounded length, so that a key of any length is no row of that length
    piece = (F.row_number().over(Window.partitionBy("country", "channel", "key").orderBy("candidate_entity_id")) / PIECE).cast("int")
    entry = F.collect_list(F.struct(F.col("candidate_entity_id").alias("id"), F.col("tft").cast("long").alias("tft"))).alias("e")
    lists = lists.withColumn("piece", piece).groupBy("country", "channel", "key", "piece").agg(entry)
    lists = lists.select("country", "channel", "key", F.col("e.id").alias("ids"), F.col("e.tft").alias("tfts"))
    groups = max(1, -(-queries.count() // QUERIES_A_GROUP))
    asked = _inverted_keys(queries, False).withColumnRenamed("entity_id", "source1_entity_id")
    asked = asked.withColumn("group", F.pmod(F.xxhash64("source1_entity_id"), F.lit(groups)))
    wanted = asked.select("group", "country", "channel", "key").distinct().join(lists, ["country", "channel", "key"])
    wanted = wanted.select(*[F.col(c).alias(c) for c in wanted.columns])  # columns of their own, as asked is in both
    names = sorted(INVERTED)
    schema = "source1_entity_id string, candidate_entity_id string, country string, retrieval_score double, channel_count int, bits int"
    ranked = asked.groupBy("group").cogroup(wanted.groupBy("group")).applyInArrow(partial(_best_of_lists, top), schema)
    hit = F.filter(F.array(*[F.when(F.col("bits").bitwiseAND(F.lit(1 << i)) > 0, c) for i, c in enumerate(names)]), lambda c: c.isNotNull())
    ranked = ranked.withColumn("retrieval_channels", F.array_join(F.slice(hit, 1, 5), "|"))
    return ranked.select(
        "source1_entity_id",
        "candidate_entity_id",
        F.lit(source).alias("candidate_source"),
        "country",
        "retrieval_channels",
        "retrieval_score",
        "channel_count",
    )


def char_ngrams(value: Column, low: int = 3, high: int = 4) -> Column:
    """Character n-grams inside words that are padded by a space on both sides; a word not
    longer than n gives itself once, for the smallest such n only."""
    padded = F.transform(T.tokens(value), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def runs(w: Column, n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - (n - 1), F.lit(1))), lambda i: F.substring(w, i, F.lit(n)))

    def grams(w: Column) -> Column:
        out = None
        for n in range(low, high + 1):
            part = F.when(F.length(w) >= n, runs(w, n))
            part = part.otherwise(F.when(F.lit(n == low), F.array(w)).otherwise(F.array().cast("array<string>")))
            if n > low:  # a word that an n below covered whole is done
                part = F.when(F.length(w) <= n - 1, F.array().cast("array<string>")).otherwise(part)
            out = part if out is None else F.concat(out, part)
        return out

    return F.flatten(F.transform(padded, grams))


def block_tfidf(queries: DataFrame, targets: DataFrame, top: int = 30, least: float = 0.25, most_features: int = 50_000) -> DataFrame:
    """Cosine of TF-IDF vectors of character n-grams of name_clean, joined with equal compact names.

    The vocabulary is the n-grams most frequent in the targets; document frequencies and
    norms are per country.  name_score is the better of 1 for an equal name and the cosine.
    Equal names of a country have one vector, whose name is that of their first id, so that
    the work depends on the distinct names.
    """

    def named(rows: DataFrame) -> DataFrame:
        return rows.groupBy("country", "name_clean").agg(F.min("entity_id").alias("name"), F.count("*").alias("times"))

    def counted(names: DataFrame) -> DataFrame:
        grams = names.select("name", "country", "times", F.explode(char_ngrams(F.col("name_clean"))).alias("g"))
        return grams.groupBy("name", "country", "times", "g").agg(F.count("*").alias("tf"))

    tf = counted(named(targets))
    n = targets.groupBy("country").agg(F.count("*").alias("n"))
    df = tf.groupBy("country", "g").agg(F.sum("times").alias("df"), F.sum(F.col("tf") * F.col("times")).alias("total"))
    rank = Window.partitionBy("country").orderBy(F.desc("total"), "g")
    idf = df.withColumn("place", F.row_number().over(rank)).where(F.col("place") <= most_features).join(n, "country")
    idf = idf.select("country", "g", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))

    def vectors(tfs: DataFrame) -> DataFrame:
        weighed = tfs.join(idf, ["country", "g"]).withColumn("x", F.col("tf") * F.col("idf"))
        norms = weighed.groupBy("name").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
        return weighed.join(norms, "name").select("name", "country", "g", (F.col("x") / F.col("norm")).alias("x"))

    left = vectors(counted(named(queries))).select(F.col("name").alias("qname"), "country", "g", F.col("x").alias("qx"))
    right = vectors(tf).select(F.col("name").alias("tname"), "country", "g", F.col("x").alias("tx"))
    cosine = left.join(right, ["country", "g"]).groupBy("qname", "tname", "country")
    pairs = cosine.agg(F.sum(F.col("qx") * F.col("tx")).alias("cosine")).where(F.col("cosine") >= least)
    # what is among the best ids has a name among the best names, ties included, and is among the name's first ids
    score = F.desc(F.round("cosine", 9))
    pairs = pairs.withColumn("place", F.rank().over(Window.partitionBy("qname").orderBy(score))).where(F.col("place") <= top).drop("place")
    holders = Window.partitionBy("name").orderBy("entity_id")
    first = targets.join(named(targets), ["country", "name_clean"]).select("entity_id", "name")
    first = first.withColumn("place", F.row_number().over(holders)).where(F.col("place") <= top)
    found = pairs.join(first.select(F.col("name").alias("tname"), F.col("entity_id").alias("candidate_entity_id")), "tname")
    order = Window.partitionBy("qname").orderBy(score, "candidate_entity_id")
    found = found.withColumn("tfidf_rank", F.row_number().over(order)).where(F.col("tfidf_rank") <= top)
    askers = queries.join(named(queries), ["country", "name_clean"]).select(F.col("entity_id").alias("source1_entity_id"), F.col("name").alias("qname"))
    near = askers.join(found, "qname").select("source1_entity_id", "candidate_entity_id", "country", "cosine", "tfidf_rank")
    q = queries.where("name_compact <> ''").select(F.col("entity_id").alias("source1_entity_id"), "country", "name_compact")
    t = targets.select(F.col("entity_id").alias("candidate_entity_id"), "country", "name_compact")
    exact = q.join(t, ["country", "name_compact"]).select("source1_entity_id", "candidate_entity_id", "country", F.lit(1).alias("exact_name_match"))
    out = near.join(exact, ["source1_entity_id", "candidate_entity_id", "country"], "full_outer")
    equal, found = F.col("exact_name_match").isNotNull(), F.col("cosine").isNotNull()
    return out.select(
        "source1_entity_id",
        "candidate_entity_id",
        "country",
        F.when(equal, 1).otherwise(0).alias("exact_name_match"),
        F.when(equal, 1.0).otherwise(F.col("cosine")).alias("name_score"),
        "tfidf_rank",
        F.when(equal & found, "exact_name|name_tfidf").when(equal, "exact_name").otherwise("name_tfidf").alias("channel"),
    )
