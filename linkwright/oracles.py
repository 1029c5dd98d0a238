"""For each query of the catalogue, SQL that gives the same rows in DuckDB.

The SQL is written for itself: other engines' functions, no shared expressions.
"""

from __future__ import annotations

from linkwright import vocab
from linkwright.operators.blocking import CHANNELS, INVERTED, OLD_LIMITS
from linkwright.operators.features import INTERCEPT, LOGISTIC
from linkwright.plans.registry import PLAIN, WIDE, statements
from linkwright.queries import CAP, POLICY, THRESHOLDS

_NAMES = statements(customer="customer", supplier="supplier", part="part")
W = r"[\p{L}\p{N}_]"


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _strip_domains(x: str) -> str:
    return rf"regexp_replace({x}, '\.({'|'.join(vocab.DOMAIN_ENDINGS)})\b', '', 'gi')"


def _norm(x: str) -> str:
    inner = f"replace({_strip_domains(f'lower(trim({x}))')}, '&', ' and ')"
    return rf"trim(regexp_replace(regexp_replace({inner}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _compact(x: str) -> str:
    return rf"regexp_replace({_strip_domains(f'lower(trim({x}))')}, '[^\p{{L}}\p{{N}}_]', '', 'g')"


def _tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def _no_legal(x: str) -> str:
    left = f"list_filter(string_split({x}, ' '), lambda t: t <> '' AND t NOT IN {_in(vocab.LEGAL_SUFFIXES)})"
    return f"CASE WHEN len({left}) = 0 THEN {x} ELSE array_to_string({left}, ' ') END"


def _numbers(x: str) -> str:
    return f"list_filter(regexp_extract_all({x}, '{W}+'), lambda w: regexp_full_match(w, '[0-9]+'))"


def _last(numbers: str, form: str) -> str:
    return f"list_filter({numbers}, lambda w: regexp_full_match(w, '{form}'))[-1]"


def _postal(numbers: str, country: str) -> str:
    five, six = _last(numbers, "[0-9]{5}"), _last(numbers, "[1-9][0-9]{5}")
    return f"coalesce(CASE upper(trim({country})) WHEN 'US' THEN {five} WHEN 'FRANCE' THEN {five} WHEN 'INDIA' THEN {six} ELSE coalesce({six}, {five}) END, '')"


def _leet(x: str) -> str:
    return f"translate({x}, '{vocab.LEET_FROM}', '{vocab.LEET_TO}')"


_EXTRA = r"regexp_replace(regexp_replace({x}, '\b(pc|p\.c\.|pllc|p\.l\.l\.c\.|corp|llc|inc|ltd)\b', '', 'gi'), '[^a-zA-Z0-9]', '', 'g')"


def _first(items: str, keep: str) -> str:
    return f"coalesce(list_filter({items}, lambda w: {keep})[1], '')"


def _tok1(dialect: str) -> str:
    if dialect == "train":
        return _first("string_split(name_clean, ' ')", f"length(w) >= 3 AND w NOT IN {_in(vocab.TRAIN_NAME_STOPS)}")
    if dialect == "query":
        return _first("string_split(name_no_legal, ' ')", r"regexp_full_match(w, '\p{L}{3,}')")
    runs = "regexp_extract_all(name_clean, '[a-z0-9]{4,}')"
    return f"coalesce(list_filter({runs}, lambda w: w NOT IN {_in(vocab.GENERIC_NAME_TOKENS)} AND NOT regexp_full_match(w, '[0-9]+'))[1], {runs}[1], '')"


def _addr_tok1(dialect: str) -> str:
    if dialect == "train":
        keep = f"regexp_full_match(w, '[a-zA-Z]{{4,}}') AND lower(w) NOT IN {_in(vocab.TRAIN_ADDRESS_STOPS)}"
        return _first(f"regexp_extract_all(address_clean, '{W}+')", keep)
    if dialect == "query":
        return _first("string_split(address_clean, ' ')", r"regexp_full_match(w, '\p{L}{3,}')")
    runs = "regexp_extract_all(address_clean, '[a-z]{4,}')"
    return f"coalesce(list_filter({runs}, lambda w: w NOT IN {_in(vocab.TEST_ADDRESS_STOPS)})[1], {runs}[1], '')"


def _anchor(dialect: str) -> str:
    if dialect == "test":
        return r"regexp_replace(regexp_extract(address_clean, '\b([0-9]+)\s+([a-z]{3,})\b', 0), '\s+', ' ', 'g')"
    return "CASE WHEN len(numbers) > 0 AND addr_tok1 <> '' THEN numbers[1] || '_' || addr_tok1 ELSE '' END"


def _nfkc(x: str) -> str:
    """As far as the registry needs it."""
    return f"translate({x}, '{WIDE}', '{PLAIN}')"


def _views(name: str, raw: str, dialect: str = "train") -> str:
    return f"""{name}_0 AS (SELECT *, {_nfkc('business_name')} AS n0, {_nfkc('business_address')} AS a0 FROM {raw}),
{name}_a AS (SELECT *, {_norm('n0')} AS name_clean, {_compact('n0')} AS name_compact,
  {_norm('a0')} AS address_clean, {_compact('a0')} AS address_compact, {_numbers('a0')} AS numbers FROM {name}_0),
{name}_b AS (SELECT *, {_no_legal('name_clean')} AS name_no_legal, {_postal('numbers', 'country')} AS postal_code FROM {name}_a),
{name}_c AS (SELECT *, array_to_string(list_sort({_tokens('name_no_legal')}), ' ') AS name_sorted, {_compact('name_no_legal')} AS name_compact_core,
  {_tok1(dialect)} AS tok1, {_addr_tok1(dialect)} AS addr_tok1 FROM {name}_b),
{name} AS (SELECT *, {_anchor(dialect)} AS addr_anchor FROM {name}_c)"""


def _base(dialect: str = "train") -> str:
    return f"""WITH s1 AS ({_NAMES['s1']}), s2 AS ({_NAMES['s2']}), s3 AS ({_NAMES['s3']}),
truth_pairs AS ({_NAMES['truth_pairs']}),
truth AS (SELECT s.entity_id AS source1_entity_id, s.country, list_sort(coalesce(list(p.id) FILTER (WHERE p.id IS NOT NULL), [])) AS ids
  FROM s1 s LEFT JOIN truth_pairs p ON p.source1_entity_id = s.entity_id GROUP BY 1, 2),
every AS (SELECT 'S2' AS source, * FROM s2 UNION ALL SELECT 'S3' AS source, * FROM s3),
{_views('q', 's1', dialect)},
{_views('t', 'every', dialect)}"""


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


_GATES = {
    "addr_anchor": "addr_anchor <> ''",
    "name_token": f"length(tok1) >= 4 AND tok1 NOT IN {_in(vocab.GENERIC_NAME_TOKENS)}",
    "addr_token": "length(addr_tok1) >= 4",
}


def _hits(limits: dict[str, int], old: bool = False) -> str:
    asked = []
    for channel, (column, _, _) in CHANNELS.items():
        variants = [column]
        if not old and channel in ("exact_compact", "exact_core"):
            variants += [f"strip_accents({column})", _leet(f"strip_accents({column})")]
            if channel == "exact_core":
                variants.append(_EXTRA.format(x=column))
        gate = _GATES.get(channel, "true") if not (old and channel == "name_token") else "length(tok1) >= 4"
        asked.append(f"SELECT DISTINCT entity_id AS source1_entity_id, country, '{channel}' AS channel, unnest([{', '.join(variants)}]) AS key FROM q WHERE {gate}")
    have = [f"SELECT entity_id AS candidate_entity_id, source AS candidate_source, country, '{c}' AS channel, {col} AS key FROM t" for c, (col, _, _) in CHANNELS.items()]
    limit = "CASE channel " + " ".join(f"WHEN '{c}' THEN {n}" for c, n in limits.items()) + " END"
    return f"""asked AS ({_union(asked)}), have AS ({_union(have)}),
hit_rows AS (SELECT a.source1_entity_id, h.candidate_entity_id, h.candidate_source, h.country, h.channel, h.key,
  row_number() OVER (PARTITION BY a.source1_entity_id, h.candidate_source, h.channel ORDER BY h.key, h.candidate_entity_id) AS place
  FROM asked a JOIN have h ON a.country = h.country AND a.channel = h.channel AND a.key = h.key),
hits AS (SELECT * EXCLUDE (place) FROM hit_rows WHERE place <= {limit})"""


_LIMITS = {c: n for c, (_, n, _) in CHANNELS.items()}
_SCORE = "CASE " + " ".join(f"WHEN channel = '{c}' THEN CAST({s} AS DOUBLE)" for c, (_, _, s) in CHANNELS.items()) + " END"


def _block() -> str:
    return f"""{_base()}, {_hits(_LIMITS)},
once AS (SELECT source1_entity_id, candidate_entity_id, candidate_source, country, min(channel) AS channel FROM hits GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, candidate_source ORDER BY candidate_entity_id) AS place,
  least({CAP}, count(*) FILTER (WHERE candidate_source = 'S2') OVER (PARTITION BY source1_entity_id)) AS n2 FROM once),
block AS (SELECT source1_entity_id, candidate_entity_id, candidate_source, country, channel AS retrieval_channels, {_SCORE} AS retrieval_score,
  CAST(1 AS INTEGER) AS channel_count FROM placed WHERE place <= CASE WHEN candidate_source = 'S2' THEN {CAP} ELSE greatest(1, {CAP} - n2) END)"""


def _jaro(a: str, b: str) -> str:
    """Characters of a in turn take the first free equal one of b within the window.

    State: b with taken characters as chr(1), then chr(2), then the characters of a that matched.
    """
    win = f"(greatest(length({a}), length({b})) // 2 - 1)"
    low = f"greatest(1, i - {win})"
    seg = f"substr(string_split(s, chr(2))[1], {low}, greatest(0, least(length({b}), i + {win}) - {low} + 1))"
    c = f"substr({a}, i, 1)"
    at = f"strpos({seg}, {c})"
    step = f"CASE WHEN {at} > 0 THEN substr(s, 1, {low} + {at} - 2) || chr(1) || substr(s, {low} + {at}) || {c} ELSE s END"
    fold = f"list_reduce(list_transform(range(1, length({a}) + 1), lambda n: CAST(n AS VARCHAR)), lambda s, m: {step.replace('i - ', 'CAST(m AS BIGINT) - ').replace('i + ', 'CAST(m AS BIGINT) + ').replace(', i, 1', ', CAST(m AS BIGINT), 1')}, {b} || chr(2))"
    return fold


def _jaro_columns(pairs: list[tuple[str, str, str]], source: str, keep: str) -> str:
    """A chain of CTEs that ends in `jw_done` with, for each (name, a, b), name_j and name_w."""
    folds = ", ".join(f"{_jaro(a, b)} AS {n}_s" for n, a, b in pairs)
    parts = []
    for n, a, b in pairs:
        got = f"string_split({n}_s, chr(2))[2]"
        taken = f"list_filter(range(1, length({b}) + 1), lambda i: substr({n}_s, i, 1) = chr(1))"
        parts.append(f"{got} AS {n}_g, array_to_string(list_transform({taken}, lambda i: substr({b}, i, 1)), '') AS {n}_o")
    rates = []
    for n, a, b in pairs:
        k = f"CAST(length({n}_g) AS DOUBLE)"
        swaps = f"len(list_filter(range(1, length({n}_g) + 1), lambda i: substr({n}_g, i, 1) <> substr({n}_o, i, 1)))"
        value = f"({k} / length({a}) + {k} / length({b}) + ({k} - {swaps} / 2.0) / {k}) / 3.0"
        rates.append(
            f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0 WHEN {a} = {b} THEN 1.0 WHEN length({n}_g) = 0 THEN 0.0 ELSE CAST({value} AS DOUBLE) END AS {n}_j"
        )
    wins = []
    for n, a, b in pairs:
        same = " ".join(
            f"WHEN length({a}) >= {k} AND length({b}) >= {k} AND substr({a}, 1, {k}) = substr({b}, 1, {k}) THEN {k}" for k in (4, 3, 2, 1)
        )
        wins.append(f"{n}_j + (CASE {same} ELSE 0 END) * CAST(0.1 AS DOUBLE) * (1.0 - {n}_j) AS {n}_w")
    return f"""jw_1 AS (SELECT {keep}, {folds} FROM {source}), jw_2 AS (SELECT *, {', '.join(parts)} FROM jw_1),
jw_3 AS (SELECT *, {', '.join(rates)} FROM jw_2), jw_done AS (SELECT *, {', '.join(wins)} FROM jw_3)"""


def _sets(x: str, y: str) -> tuple[str, str, str, str]:
    both = f"len(list_intersect({x}, {y}))"
    n, m = f"len(list_distinct({x}))", f"len(list_distinct({y}))"
    none = f"len({x}) = 0 OR len({y}) = 0"
    return both, n, m, none


def _jaccard(x: str, y: str) -> str:
    both, n, m, none = _sets(x, y)
    return f"CASE WHEN {none} THEN 0.0 ELSE CAST({both} AS DOUBLE) / ({n} + {m} - {both}) END"


def _containment(x: str, y: str) -> str:
    both, n, m, none = _sets(x, y)
    return f"CASE WHEN {none} THEN 0.0 ELSE CAST({both} AS DOUBLE) / least({n}, {m}) END"


def _features() -> str:
    views = ("name_clean", "name_compact", "name_compact_core", "address_clean", "postal_code", "numbers")
    left = ", ".join(f"q.{v} AS a_{v}" for v in views)
    right = ", ".join(f"t.{v} AS b_{v}" for v in views)
    lists = ", ".join(f"{_tokens(f'{s}_{v}')} AS {s}t_{v}" for s in "ab" for v in ("name_clean", "name_compact_core", "address_clean"))
    flag = lambda c: f"CASE WHEN {c} THEN 1.0 ELSE 0.0 END"
    jaro = _jaro_columns(
        [("name", "a_name_clean", "b_name_clean"), ("core", "a_name_compact_core", "b_name_compact_core"), ("addr", "a_addr50", "b_addr50")],
        "sides_2",
        "*",
    )
    both_p, both_n = "a_postal_code <> '' AND b_postal_code <> ''", "len(a_numbers) > 0 AND len(b_numbers) > 0"
    return f"""{_block()},
sides AS (SELECT block.*, {left}, {right}, substr(q.address_clean, 1, 50) AS a_addr50, substr(t.address_clean, 1, 50) AS b_addr50
  FROM block JOIN q ON q.entity_id = block.source1_entity_id JOIN t ON t.entity_id = block.candidate_entity_id),
sides_2 AS (SELECT *, {lists} FROM sides),
{jaro},
feats_1 AS (SELECT *, {flag("a_name_compact <> '' AND a_name_compact = b_name_compact")} AS exact_compact,
  {flag("a_name_compact_core <> '' AND a_name_compact_core = b_name_compact_core")} AS exact_core,
  {flag(f"a_name_compact <> '' AND {_leet('a_name_compact')} = {_leet('b_name_compact')}")} AS exact_leet,
  name_w AS name_jw, core_w AS core_jw, addr_w AS addr_jw,
  {_jaccard('at_name_clean', 'bt_name_clean')} AS name_jaccard, {_containment('at_name_clean', 'bt_name_clean')} AS name_containment,
  {_jaccard('at_name_compact_core', 'bt_name_compact_core')} AS core_jaccard,
  CAST(least(length(a_name_clean), length(b_name_clean)) AS DOUBLE) / greatest(length(a_name_clean), length(b_name_clean), 1) AS len_ratio,
  {_jaccard('at_address_clean', 'bt_address_clean')} AS addr_jaccard, {_containment('at_address_clean', 'bt_address_clean')} AS addr_containment,
  {flag(f'{both_p} AND a_postal_code = b_postal_code')} AS postal_match, {flag(f'{both_p} AND a_postal_code <> b_postal_code')} AS postal_conflict,
  CASE WHEN {both_n} THEN {_jaccard('a_numbers', 'b_numbers')} ELSE 0.0 END AS nums_jaccard,
  {flag(f'{both_n} AND len(list_intersect(a_numbers, b_numbers)) = 0')} AS nums_conflict, {flag("candidate_source = 'S2'")} AS is_s2 FROM jw_done),
feats AS (SELECT *, {flag('core_jw >= 0.85 AND addr_jaccard >= 0.4')} AS name_strong_addr_strong,
  {flag('core_jw >= 0.9 AND postal_conflict = 1')} AS name_strong_addr_conflict FROM feats_1),
scored AS (SELECT *, 1.0 / (1.0 + exp(-(CAST({INTERCEPT} AS DOUBLE) + {' + '.join(f'CAST({w} AS DOUBLE) * {n}' for n, w in LOGISTIC.items())}))) AS probability FROM feats)"""


def _policy(threshold: str, by: str = "source1_entity_id", rows: str = "scored", tail: str = "") -> str:
    return f"""
judged{tail} AS (SELECT *, (postal_conflict = 1 OR (nums_conflict = 1 AND addr_jaccard < 0.5)
    OR (exact_compact = 0 AND exact_core = 0 AND (core_jw < 0.93 OR (core_jaccard < 0.6 AND core_jw < 0.97 AND name_containment < 0.85)))
    OR NOT (addr_jaccard >= 0.2 OR addr_jw >= 0.7 OR postal_match = 1 OR nums_jaccard > 0) OR (core_jw < 0.85 AND addr_jaccard < 0.5)) AS veto,
  (addr_jw >= 0.85 OR postal_match = 1 OR (addr_jaccard >= 0.35 AND nums_jaccard > 0)) AS strong FROM {rows}),
first{tail} AS (SELECT *, NOT veto AND probability >= CASE WHEN strong THEN CAST({POLICY['strong_threshold']} AS DOUBLE) ELSE {threshold} END AS prim FROM judged{tail}),
seen{tail} AS (SELECT *, max(CASE WHEN prim THEN probability END) OVER (PARTITION BY {by} ORDER BY probability DESC, candidate_entity_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top,
  row_number() OVER w AS place, lead(probability) OVER w AS nxt FROM first{tail} WINDOW w AS (PARTITION BY {by} ORDER BY probability DESC, candidate_entity_id)),
close{tail} AS (SELECT *, max(CASE WHEN place = 1 AND probability < 0.9 AND probability - nxt < {POLICY['min_margin']} AND exact_compact = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {by}) = 1 AS unsure,
  coalesce(NOT veto AND NOT prim AND top > 0 AND probability >= 0.82 AND probability >= top - CAST(0.15 AS DOUBLE) AND strong, false) AS resc FROM seen{tail}),
decided{tail} AS (SELECT *, CASE WHEN veto THEN 'veto' WHEN NOT prim AND NOT resc THEN 'below_threshold' WHEN unsure THEN 'margin' WHEN prim THEN 'primary' ELSE 'rescue' END AS reason FROM close{tail})"""


_DECIDED = f"{_features()}, {_policy('CAST(' + str(POLICY['threshold']) + ' AS DOUBLE)')}, accepted AS (SELECT * FROM decided WHERE reason IN ('primary', 'rescue'))"
_SWEPT = (
    f"{_features()}, swept AS (SELECT *, unnest([{', '.join(f'CAST({x} AS DOUBLE)' for x in THRESHOLDS)}]) AS threshold FROM scored), "
    + _policy("threshold", "threshold, source1_entity_id", "swept")
    + """, rates AS (SELECT d.threshold, count(*) AS accepted_pairs, count(p.id) AS true_positives, round(CAST(count(p.id) AS DOUBLE) / count(*), 6) AS pair_precision
  FROM decided d LEFT JOIN truth_pairs p ON p.source1_entity_id = d.source1_entity_id AND p.id = d.candidate_entity_id
  WHERE d.reason IN ('primary', 'rescue') GROUP BY d.threshold)"""
)
_ENTITIES = f"""{_DECIDED}, found AS (SELECT source1_entity_id, list(DISTINCT candidate_entity_id) AS got FROM accepted GROUP BY 1),
counted AS (SELECT t.*, len(ids) AS n, coalesce(len(got), 0) AS m, coalesce(len(list_intersect(ids, got)), 0) AS k FROM truth t LEFT JOIN found f ON f.source1_entity_id = t.source1_entity_id),
entities AS (SELECT country, n, CASE WHEN n = 0 AND m = 0 THEN 1.0 WHEN n = 0 OR m = 0 THEN 0.0 ELSE CAST(k AS DOUBLE) / m END AS p,
  CASE WHEN n = 0 AND m = 0 THEN 1.0 WHEN n = 0 OR m = 0 THEN 0.0 ELSE CAST(k AS DOUBLE) / n END AS r,
  CASE WHEN n = 0 AND m = 0 THEN 1.0 WHEN n = 0 OR m = 0 OR k = 0 THEN 0.0 ELSE 1.25 * (CAST(k AS DOUBLE) / m) * (CAST(k AS DOUBLE) / n) / (0.25 * k / m + CAST(k AS DOUBLE) / n) END AS f FROM counted)"""
_MACRO = """round(avg(f), 6) AS macro_f05, round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall,
  round(coalesce(avg(f) FILTER (WHERE n = 0), 1.0), 6) AS singleton_accuracy, count(*) FILTER (WHERE n = 0) AS singleton_count,
  round(coalesce(avg(f) FILTER (WHERE n > 0), 0.0), 6) AS non_singleton_f05, count(*) AS total_entities"""


def _pair(*columns: str, source: str = "feats") -> str:
    return f"SELECT source1_entity_id, candidate_entity_id, {', '.join(f'round(CAST({c} AS DOUBLE), 6) AS {c}' for c in columns)} FROM {source}"


def _inverted() -> str:
    def side(table: str, who: str, target: bool) -> str:
        rows = [
            f"SELECT entity_id AS {who}, country, 'exact_compact' AS channel, name_compact AS key FROM {table} WHERE name_compact <> ''",
            f"SELECT entity_id, country, 'exact_core', name_compact_core FROM {table} WHERE name_compact_core <> ''" + (" AND name_compact_core <> name_compact" if target else ""),
            f"SELECT entity_id, country, 'exact_sorted', name_sorted FROM {table} WHERE name_sorted <> ''",
            f"SELECT entity_id, country, 'name_token', unnest(list_filter(string_split(name_clean, ' '), lambda t: length(t) >= 3 AND t NOT IN {_in(vocab.COMMON_NAME_STOPS)})) FROM {table}",
            f"SELECT entity_id, country, 'addr_token', unnest(list_filter(string_split(address_clean, ' '), lambda t: length(t) >= 4 AND t NOT IN {_in(vocab.COMMON_ADDRESS_STOPS)})) FROM {table}",
            f"SELECT entity_id, country, 'postal_number', postal_code || '_' || numbers[1] FROM {table} WHERE postal_code <> '' AND len(numbers) > 0",
            f"SELECT entity_id, country, 'prefix', substr(name_compact_core, 1, 5) FROM {table} WHERE length(name_compact_core) >= 5",
        ]
        return _union(rows)

    limit = "CASE channel " + " ".join(f"WHEN '{c}' THEN {n}" for c, (_, n) in INVERTED.items() if n) + " ELSE 2147483647 END"
    weight = "CASE l.channel " + " ".join(f"WHEN '{c}' THEN CAST({w} AS DOUBLE)" for c, (w, _) in INVERTED.items()) + " END"
    return f"""{_base()},
lists AS (SELECT *, row_number() OVER (PARTITION BY substr(candidate_entity_id, 1, 2), country, channel, key ORDER BY candidate_entity_id) AS place FROM ({side('t', 'candidate_entity_id', True)})),
asked AS ({side('q', 'source1_entity_id', False)}),
hits AS (SELECT a.source1_entity_id, l.candidate_entity_id, l.country, l.channel, {weight} AS w FROM asked a
  JOIN (SELECT * FROM lists WHERE place <= {limit}) l ON a.country = l.country AND a.channel = l.channel AND a.key = l.key),
sums AS (SELECT source1_entity_id, candidate_entity_id, country, sum(w) AS retrieval_score, CAST(count(*) AS INTEGER) AS channel_count,
  array_to_string(list_sort(list(DISTINCT channel))[1:5], '|') AS retrieval_channels FROM hits GROUP BY 1, 2, 3),
best AS (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, substr(candidate_entity_id, 1, 2) ORDER BY retrieval_score DESC, candidate_entity_id) AS place FROM sums)
SELECT source1_entity_id, candidate_entity_id, substr(candidate_entity_id, 1, 2) AS candidate_source, country, retrieval_channels, retrieval_score, channel_count FROM best WHERE place <= 80"""


def _tfidf() -> str:
    def grams(table: str) -> str:
        three = "CASE WHEN length(w) <= 3 THEN [w] ELSE list_transform(range(1, length(w) - 1), lambda i: substr(w, i, 3)) END"
        four = "CASE WHEN length(w) <= 3 THEN [] ELSE list_transform(range(1, length(w) - 2), lambda i: substr(w, i, 4)) END"
        words = f"SELECT entity_id, country, ' ' || unnest({_tokens('name_clean')}) || ' ' AS w FROM {table}"
        return f"SELECT entity_id, country, g, count(*) AS tf FROM (SELECT entity_id, country, unnest(list_concat({three}, {four})) AS g FROM ({words})) GROUP BY 1, 2, 3"

    def vectors(name: str, tf: str, k: str) -> str:
        return f"""{name}_x{k} AS (SELECT f.entity_id, f.country, f.g, f.tf * i.idf AS x FROM {tf} f JOIN idf{k} i ON i.country = f.country AND i.g = f.g),
{name}{k} AS (SELECT *, x / sqrt(sum(x * x) OVER (PARTITION BY entity_id)) AS y FROM {name}_x{k})"""

    def one(source: str) -> tuple[str, str]:
        k = source[1]
        rows = f"""t{k} AS (SELECT * FROM t WHERE source = '{source}'), tt{k} AS ({grams(f't{k}')}),
n{k} AS (SELECT country, count(*) AS n FROM t{k} GROUP BY 1),
df{k} AS (SELECT country, g, count(*) AS df, sum(tf) AS total FROM tt{k} GROUP BY 1, 2),
idf{k} AS (SELECT d.country, g, ln((1 + n) / (1 + CAST(df AS DOUBLE))) + 1 AS idf FROM df{k} d JOIN n{k} n ON n.country = d.country),
{vectors('vt', f'tt{k}', k)}, {vectors('vq', 'tq', k)},
cos{k} AS (SELECT a.entity_id AS s, b.entity_id AS c, a.country, sum(a.y * b.y) AS cosine FROM vq{k} a JOIN vt{k} b ON a.country = b.country AND a.g = b.g GROUP BY 1, 2, 3),
near{k} AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY s ORDER BY round(cosine, 9) DESC, c) AS INTEGER) AS tfidf_rank FROM cos{k}) WHERE tfidf_rank <= 30 AND cosine >= 0.25),
exact{k} AS (SELECT q.entity_id AS s, x.entity_id AS c, q.country FROM q JOIN t{k} x ON q.country = x.country AND q.name_compact = x.name_compact WHERE q.name_compact <> '')"""
        out = f"""SELECT coalesce(n.s, e.s) AS source1_entity_id, coalesce(n.c, e.c) AS candidate_entity_id, '{source}' AS candidate_source, coalesce(n.country, e.country) AS country,
  CAST(CASE WHEN e.s IS NULL THEN 0 ELSE 1 END AS INTEGER) AS exact_name_match, round(CASE WHEN e.s IS NULL THEN cosine ELSE 1.0 END, 6) AS name_score, tfidf_rank,
  CASE WHEN e.s IS NULL THEN 'name_tfidf' WHEN n.s IS NULL THEN 'exact_name' ELSE 'exact_name|name_tfidf' END AS channel
FROM near{k} n FULL JOIN exact{k} e ON n.s = e.s AND n.c = e.c"""
        return rows, out

    (two, out_two), (three, out_three) = one("S2"), one("S3")
    return f"{_base()}, tq AS ({grams('q')}),\n{two},\n{three}\n{out_two}\nUNION ALL {out_three}"


_K = "CAST(substr(source1_entity_id, 4) AS BIGINT)"
_FOLDS = f"""{_base()}, fold_rows AS (SELECT source1_entity_id, country, CAST(len(ids) AS INTEGER) AS match_count FROM truth),
folds AS (SELECT *, CAST((row_number() OVER (PARTITION BY country, CASE WHEN match_count = 0 THEN '0' WHEN match_count = 1 THEN '1' WHEN match_count <= 3 THEN '2_3' ELSE '4_plus' END
  ORDER BY md5('42:' || source1_entity_id), source1_entity_id) - 1) % 5 AS INTEGER) AS fold FROM fold_rows)"""
_FLAWED = f"""{_base()}, good AS (SELECT source1_entity_id, ids FROM truth), bad AS (
  SELECT CASE WHEN {_K} % 10 = 1 THEN source1_entity_id || 'x' ELSE source1_entity_id END AS source1_entity_id, ids, {_K} AS k FROM good WHERE {_K} % 10 <> 3
  UNION ALL SELECT source1_entity_id, ids, {_K} FROM good WHERE {_K} % 10 = 2),
results AS (SELECT source1_entity_id, CASE WHEN k % 10 = 4 THEN list_concat(ids, ['S9-1']) WHEN k % 10 = 5 THEN list_concat(ids, ids[1:1]) ELSE ids END AS ids
  FROM (SELECT *  REPLACE (CASE WHEN source1_entity_id LIKE '%x' THEN -1 ELSE k END AS k) FROM bad)),
rids AS (SELECT source1_entity_id, unnest(ids) AS id FROM results), cids AS (SELECT source1_entity_id, unnest(ids) AS id FROM good)"""
_RECALL = f"""{_block()}, caught AS (SELECT p.source1_entity_id, count(*) AS n, count(b.candidate_entity_id) AS k FROM truth_pairs p
  LEFT JOIN block b ON b.source1_entity_id = p.source1_entity_id AND b.candidate_entity_id = p.id GROUP BY 1)"""
_RESULT = "SELECT s1.entity_id AS source1_entity_id, coalesce(array_to_string(list_sort(list(DISTINCT x.candidate_entity_id)), ','), '') AS {c} FROM s1 LEFT JOIN {t} x ON x.source1_entity_id = s1.entity_id GROUP BY 1"

ORACLES: dict[str, str] = {
    "norm_text": f"{_base()} SELECT entity_id, name_clean, address_clean, name_clean || ' ' || address_clean AS combined_text FROM t",
    "norm_compact": f"{_base()} SELECT entity_id, name_compact, address_compact FROM t",
    "legal_core": f"{_base()} SELECT entity_id, name_no_legal, name_compact_core FROM t",
    "sorted_core": f"{_base()} SELECT entity_id, name_sorted FROM t",
    "leet": f"{_base()} SELECT entity_id, {_leet('name_compact')} AS leet, {_EXTRA.format(x='name_compact')} AS extra FROM t",
    "domain_strip": f"{_base()} SELECT entity_id, {_strip_domains('lower(business_name)')} AS name FROM every",
    "numbers": f"{_base()} SELECT entity_id, coalesce(array_to_string(numbers, ','), '') AS numbers FROM t",
    "postal_code": f"{_base()} SELECT entity_id, postal_code FROM t",
    "keys_train": f"{_base('train')} SELECT entity_id, addr_anchor, tok1, addr_tok1 FROM t",
    "keys_test": f"{_base('test')} SELECT entity_id, addr_anchor, tok1, addr_tok1 FROM t",
    "keys_query": f"{_base('query')} SELECT entity_id, addr_anchor, tok1, addr_tok1 FROM t",
    "accent_strip": "SELECT doc_id, sha256(strip_accents(coalesce(text, ''))) AS stripped FROM documents",
    "doc_norm_text": f"SELECT doc_id, sha256({_norm('coalesce(text, chr(32))')}) AS clean FROM documents",
    "format_ids": f"{_base()} SELECT source1_entity_id, coalesce(array_to_string(ids, ','), '') AS matched_entity_ids FROM truth",
    "parse_ids": f"{_base()} SELECT source1_entity_id, id FROM truth_pairs",
    "block_channels": f"{_base()}, {_hits(_LIMITS)} SELECT source1_entity_id, candidate_entity_id, candidate_source, channel, key FROM hits",
    "block_exact": f"{_base()}, {_hits(_LIMITS)} SELECT DISTINCT source1_entity_id, candidate_entity_id FROM hits WHERE channel LIKE 'exact%'",
    "block_capped": f"{_block()} SELECT * FROM block",
    "block_old": f"""{_base()}, {_hits(OLD_LIMITS, old=True)}, ranked AS (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, candidate_source
  ORDER BY CASE channel {' '.join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CHANNELS))} END, candidate_entity_id) AS place FROM hits)
SELECT source1_entity_id, candidate_entity_id, candidate_source, country, channel AS retrieval_channels, {_SCORE} AS retrieval_score, CAST(1 AS INTEGER) AS channel_count FROM ranked WHERE place <= {CAP}""",
    "block_inverted_topk": _inverted(),
    "block_tfidf_topk": _tfidf(),
    "feat_token": f"{_features()} {_pair('name_jaccard', 'name_containment', 'core_jaccard', 'addr_jaccard', 'addr_containment', 'len_ratio')}",
    "feat_postal_nums": f"{_features()} {_pair('postal_match', 'postal_conflict', 'nums_jaccard', 'nums_conflict')}",
    "feat_jaro": f"{_features()} {_pair('name_jw', 'core_jw', 'addr_jw')}",
    "feat_exact": f"{_features()} {_pair('exact_compact', 'exact_core', 'exact_leet', 'name_strong_addr_strong', 'name_strong_addr_conflict', 'is_s2')}",
    "jaro_plain": f"""{_base()}, xy AS (SELECT substr(s1.entity_id, 4) AS k, lower(s1.business_name) AS a, lower(s3.business_name) AS b FROM s1 JOIN s3 ON substr(s1.entity_id, 4) = substr(s3.entity_id, 4)),
{_jaro_columns([('x', 'a', 'b')], 'xy', '*')} SELECT k, round(CAST(x_j AS DOUBLE), 6) AS jaro FROM jw_done""",
    "score_logistic": f"{_features()} {_pair('probability', source='scored')}",
    "decide_policy": f"{_DECIDED} SELECT source1_entity_id, candidate_entity_id, reason IN ('primary', 'rescue') AS accepted, reason FROM decided",
    "decide_sweep": f"{_SWEPT} SELECT * FROM rates",
    "best_threshold": f"{_SWEPT} SELECT min(threshold) AS threshold FROM rates WHERE pair_precision >= 0.5",
    "matching_results": f"{_DECIDED} {_RESULT.format(c='matched_entity_ids', t='accepted')}",
    "candidate_pairs": f"{_block()} {_RESULT.format(c='candidate_entity_ids', t='block')}",
    "submission_violations": f"""{_FLAWED}
SELECT 'missing_s1' AS rule, count(*) AS violations FROM s1 WHERE entity_id NOT IN (SELECT source1_entity_id FROM results)
UNION ALL SELECT 'unknown_s1', count(*) FROM results WHERE source1_entity_id NOT IN (SELECT entity_id FROM s1)
UNION ALL SELECT 'repeated_s1', count(*) FROM (SELECT source1_entity_id FROM results GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'repeated_match', count(*) FROM results WHERE len(ids) > len(list_distinct(ids))
UNION ALL SELECT 'bad_prefix', count(*) FROM rids WHERE id NOT LIKE 'S2-%' AND id NOT LIKE 'S3-%'
UNION ALL SELECT 'bad_candidate_prefix', count(*) FROM cids WHERE id NOT LIKE 'S2-%' AND id NOT LIKE 'S3-%'
UNION ALL SELECT 'match_not_candidate', count(*) FROM rids r WHERE NOT EXISTS (SELECT 1 FROM cids c WHERE c.source1_entity_id = r.source1_entity_id AND c.id = r.id)""",
    "merge_parts": f"""{_base()} SELECT source1_entity_id, CASE {_K} % 3 WHEN 0 THEN coalesce(array_to_string(ids, ','), '')
  WHEN 1 THEN 'S2-second,' || coalesce(array_to_string(ids, ','), '') ELSE '' END AS matched_entity_ids FROM truth""",
    "anti_resume": f"{_base()} SELECT entity_id FROM s1 WHERE CAST(substr(entity_id, 4) AS BIGINT) % 3 = 0",
    "part_range": f"{_base()}, p AS (SELECT entity_id, row_number() OVER (ORDER BY entity_id) AS i, count(*) OVER () AS n FROM s1) SELECT entity_id FROM p WHERE i > (n + 3) // 4 AND i <= 2 * ((n + 3) // 4)",
    "id_lookup": f"{_base()} SELECT entity_id, business_name, business_address, country FROM every WHERE entity_id IN (SELECT id FROM truth_pairs WHERE id LIKE '%7')",
    "eval_macro": f"{_ENTITIES} SELECT {_MACRO} FROM entities",
    "eval_by_country": f"{_ENTITIES} SELECT country, {_MACRO} FROM entities GROUP BY country",
    "eval_pairs": f"""{_DECIDED}, c AS (SELECT (SELECT count(*) FROM accepted a WHERE EXISTS (SELECT 1 FROM truth_pairs p WHERE p.source1_entity_id = a.source1_entity_id AND p.id = a.candidate_entity_id)) AS tp,
  (SELECT count(*) FROM accepted) AS n, (SELECT count(*) FROM truth_pairs) AS m)
SELECT tp AS true_positives, n - tp AS false_positives, m - tp AS false_negatives, round(CASE WHEN n > 0 THEN CAST(tp AS DOUBLE) / n ELSE 1.0 END, 6) AS pair_precision,
  round(CASE WHEN m > 0 THEN CAST(tp AS DOUBLE) / m ELSE 1.0 END, 6) AS pair_recall FROM c""",
    "fp_report": f"""{_DECIDED} SELECT source1_entity_id, candidate_entity_id, round(probability, 6) AS probability, reason FROM decided a
WHERE probability >= 0.5 AND NOT EXISTS (SELECT 1 FROM truth_pairs p WHERE p.source1_entity_id = a.source1_entity_id AND p.id = a.candidate_entity_id)""",
    "blocking_recall": f"""{_RECALL} SELECT round(CAST(sum(k) AS DOUBLE) / sum(n), 6) AS candidate_recall, CAST(sum(n) AS BIGINT) AS total_true_pairs, CAST(sum(k) AS BIGINT) AS captured_true_pairs,
  CAST(sum(n) - sum(k) AS BIGINT) AS missed_true_pairs, round(CAST(count(*) FILTER (WHERE n = k) AS DOUBLE) / count(*), 6) AS entity_all_matches_coverage,
  round(CAST(count(*) FILTER (WHERE k > 0) AS DOUBLE) / count(*), 6) AS entity_any_match_coverage, (SELECT count(*) FROM block) AS total_candidates_generated,
  round((SELECT CAST(count(*) AS DOUBLE) FROM block) / (SELECT count(*) FROM truth), 6) AS avg_candidates_per_s1 FROM caught""",
    "candidate_volume": f"""{_block()}, v AS (SELECT s1.entity_id, count(b.candidate_entity_id) AS n FROM s1 LEFT JOIN block b ON b.source1_entity_id = s1.entity_id GROUP BY 1)
SELECT round(avg(n), 6) AS mean_candidates, round(quantile_cont(n, 0.95), 6) AS p95_candidates, max(n) AS max_candidates FROM v""",
    "audit_source": f"""{_base()} SELECT count(*) AS total_rows, count(DISTINCT entity_id) AS unique_ids, count(*) FILTER (WHERE entity_id NOT LIKE 'S2-%') AS bad_prefixes,
  count(*) FILTER (WHERE trim(business_name) = '') AS empty_names, round(100.0 * count(*) FILTER (WHERE trim(business_name) = '') / count(*), 4) AS empty_names_pct,
  count(*) FILTER (WHERE trim(business_address) = '') AS empty_addresses, round(100.0 * count(*) FILTER (WHERE trim(business_address) = '') / count(*), 4) AS empty_addresses_pct,
  count(*) FILTER (WHERE trim(country) = '') AS empty_countries FROM s2""",
    "audit_truth": f"""{_base()}, i AS (SELECT source1_entity_id, unnest(ids) AS id FROM truth)
SELECT count(*) AS total_rows, count(DISTINCT source1_entity_id) AS unique_s1, count(*) FILTER (WHERE len(ids) = 0) AS singletons,
  round(coalesce(avg(len(ids)) FILTER (WHERE len(ids) > 0), 0.0), 6) AS mean_matches, CAST(coalesce(max(len(ids)), 0) AS INTEGER) AS max_matches,
  (SELECT count(*) FROM i WHERE id LIKE 'S2-%') AS s2_matches, (SELECT count(*) FROM i WHERE id LIKE 'S3-%') AS s3_matches,
  (SELECT count(*) FROM i WHERE id NOT IN (SELECT entity_id FROM every)) AS invalid_references, count(*) FILTER (WHERE len(ids) > len(list_distinct(ids))) AS rows_with_duplicates,
  count(*) FILTER (WHERE source1_entity_id NOT IN (SELECT entity_id FROM s1)) AS unknown_s1, (SELECT count(*) FROM s1 WHERE entity_id NOT IN (SELECT source1_entity_id FROM truth)) AS s1_without_truth FROM truth""",
    "country_hist": f"{_base()} SELECT country, count(*) AS n FROM s2 GROUP BY country",
    "profile": f"""{_base()} SELECT country, count(*) AS n, quantile_cont(length(business_name), 0.5) AS name_median, quantile_cont(length(business_name), 0.95) AS name_p95,
  quantile_cont(length(business_address), 0.5) AS address_median, quantile_cont(length(business_address), 0.95) AS address_p95,
  round(1 - CAST(count(DISTINCT business_name) AS DOUBLE) / count(*), 6) AS repeated_names FROM s3 GROUP BY country""",
    "shared_candidates": f"{_base()} SELECT id AS candidate_entity_id, CAST(2 AS BIGINT) AS n_s1 FROM truth_pairs WHERE source1_entity_id LIKE '%1'",
    "folds": f"{_FOLDS} SELECT * FROM folds",
    "folds_balance": f"""{_FOLDS} SELECT country, CASE WHEN match_count = 0 THEN '0' WHEN match_count = 1 THEN '1' WHEN match_count <= 3 THEN '2_3' ELSE '4_plus' END AS bucket,
  fold, count(*) AS n FROM folds GROUP BY ALL""",
    "channel_diagnosis": f"""{_base()}, words AS (SELECT entity_id, list_filter(string_split(name_clean, ' '), lambda w: length(w) >= 3 AND w NOT IN {_in(vocab.PROBE_STOPS)})[1] AS word FROM q)
SELECT count(*) AS total_true_pairs, count(*) FILTER (WHERE contains(t.name_clean, w.word)) AS reached_pairs,
  round(CAST(count(*) FILTER (WHERE contains(t.name_clean, w.word)) AS DOUBLE) / count(*), 6) AS share
FROM (SELECT DISTINCT source1_entity_id, id FROM truth_pairs) p LEFT JOIN words w ON w.entity_id = p.source1_entity_id LEFT JOIN t ON t.entity_id = p.id""",
    "proof_samples": f"""{_DECIDED}, found AS (SELECT source1_entity_id, list(DISTINCT candidate_entity_id) AS got FROM accepted GROUP BY 1),
kinds AS (SELECT t.*, got, CASE WHEN len(got) > 0 THEN 'matched' WHEN len(ids) = 0 THEN 'singleton' END AS kind FROM truth t LEFT JOIN found f ON f.source1_entity_id = t.source1_entity_id),
samples AS (SELECT *, row_number() OVER (PARTITION BY country, kind ORDER BY source1_entity_id) AS i FROM kinds WHERE kind IS NOT NULL),
proof AS (SELECT kind, source1_entity_id, ids, unnest(CASE WHEN kind = 'matched' THEN got ELSE [CAST(NULL AS VARCHAR)] END) AS candidate_entity_id FROM samples WHERE i <= 3)
SELECT p.kind, p.source1_entity_id, s1.country, s1.business_name, s1.business_address, p.candidate_entity_id, e.business_name AS matched_name,
  e.business_address AS matched_address, CASE WHEN p.candidate_entity_id IS NOT NULL THEN list_contains(p.ids, p.candidate_entity_id) END AS is_true
FROM proof p JOIN s1 ON s1.entity_id = p.source1_entity_id LEFT JOIN every e ON e.entity_id = p.candidate_entity_id""",
    "rapid_sample": f"{_FOLDS} SELECT source1_entity_id, country, match_count FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY md5('42:' || source1_entity_id), source1_entity_id) AS i FROM folds WHERE fold = 0) WHERE i <= 50",
}
