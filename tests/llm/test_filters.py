import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwright.llm import decontaminate, toxicity, url_filter

from .helpers import ALNUM, AWKWARD, frame, lower, words


def plain_hits(docs, items, width):
    windows = {}
    for item, text in items:
        w = ALNUM.findall(lower(text)) if item is not None else []
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w = ALNUM.findall(lower(text))
        hit, who = [0] * len(w), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit[k : k + n] = [1] * n
                    who |= windows[tuple(w[k : k + n])]
        out.append((doc, len(w), sum(hit), sorted(who)))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [200_000, 7])
def test_contamination_against_brute_force(spark, most):
    rng = random.Random(8)
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 9)))) for i in range(12)]
    items += [(50, None), (51, "..."), (None, "a b"), (3, "b, B! a"), ("x", "W3 w4-w5 w6 w7")]
    items = [(None if i is None else str(i), t) for i, t in items]
    docs = AWKWARD + [(100 + i, " ".join(rng.choice("abcc") for _ in range(rng.randrange(0, 30)))) for i in range(40)]
    table = frame(spark, docs).withColumn("items", F.lit("clash")).withColumn("n_words", F.lit(0.5))
    got = decontaminate.contamination(table, frame(spark, items, "item_id string, text string"), width=4, most=most)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()), key=str) == plain_hits(docs, items, 4)


def test_contamination_without_items_or_documents(spark):
    none = frame(spark, [], "item_id string, text string")
    assert {r["n_hit"] for r in decontaminate.contamination(frame(spark, AWKWARD), none).collect()} == {0}
    assert decontaminate.contamination(frame(spark, []), none).count() == 0


def test_clean_stage_keeps_columns(spark, tmp_path):
    frame(spark, [("a", words(12))], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = frame(spark, [(1, "en", words(12, 3)), (2, "en", words(40)), (3, None, None)], "doc_id long, lang string, text string")
    got = decontaminate.keep_clean(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 3]


RULES = [("com/", "com", "/", "allow"), ("example.com/en/", "example.com", "/en/", "block"), ("net/es/", "net", "/es/", "block")]


@pytest.mark.parametrize(
    "url,host,path,rule",
    [
        ("http://A.Example.COM/en/1?x=/q#f", "a.example.com", "/en/1", "example.com/en/"),
        ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/"),
        ("https://x.www.example.com/en/", "x.www.example.com", "/en/", "www.example.com/en/"),
        ("https://notexample.com/en/1", "notexample.com", "/en/1", "com/"),
        ("https://example.com", "example.com", "", None),
        ("https://example.com?x=1", "example.com", "", None),
        ("ftp://com/", "com", "/", "com/"),
        ("http://a.net/es/://b.com/", "a.net", "/es/://b.com/", "net/es/"),
        ("http://a.net/esp", "a.net", "/esp", None),
        ("no scheme", "", "", None),
        (None, "", "", None),
        ("http://É.com/é\nx", "É.com", "/é\nx", "com/"),
    ],
)
def test_rules(spark, url, host, path, rule):
    rows = spark.createDataFrame([(1, url)], "page_id long, url string")
    got = url_filter.ruled(url_filter.located(rows)).first()
    assert (got["host"], got["path"], got["rule"]) == (host, path, rule)


def test_trees_learn_what_rules_say(spark):
    rng = random.Random(6)
    urls = [f"http://{rng.choice(['a', 'b', 'www'])}{rng.randrange(50)}.{rng.choice(['example.com', 'x.net', 'y.org'])}/{rng.choice(['en', 'es', 'fr'])}/{i}" for i in range(3000)]
    pages = spark.createDataFrame([(i, u, "extra") for i, u in enumerate(urls)] + [(9000, None, ""), (9001, "x", "")], "page_id long, url string, host string")
    found = url_filter.ruled(url_filter.located(pages))
    rows = [(r["url"], r["action"]) for r in found.where("action is not null").collect()]
    known, trees = url_filter.fitted(found.where("action is not null"), 1500)
    p = trees.predict(np.array([known.features(u) for u, _ in rows]))
    assert np.mean((p >= 0.5) == np.array([a == "block" for _, a in rows])) > 0.97
    got = url_filter.judged(pages, sample=1500).collect()
    assert len(got) == 3002 and {r["verdict"] for r in got} == {"allow", "block"}
    again = {r["page_id"]: r["verdict"] for r in url_filter.judged(pages.repartition(5), sample=1500).collect()}
    assert again == {r["page_id"]: r["verdict"] for r in got}


def plain_verdict(known, trees, url):
    """Host, path, rule and verdict of one url, a rule and a tree at a time."""
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    host = lower(host)
    best = None
    for act, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[1])):
            best = act, h + p
    if best:
        return host, path, best[1], best[0]
    x, score = known.features(url), trees.base
    for feature, cut, value in trees.trees:
        node = 0
        while 2 * node + 2 < len(feature) and feature[node] >= 0:
            node = 2 * node + 1 + (x[feature[node]] > cut[node])
        score += value[node]
    return host, path, None, "block" if score >= 0 else "allow"


def test_verdicts_against_one_at_a_time(spark):
    rng = random.Random(16)
    hosts = ["a.example.com", "example.com", "www.example.com", "WWW.Example.com", "x.net", "net", "y.org", "z.io:80", "com", ""]
    urls = [f"{rng.choice(['http', 'https', 'ftp'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/es/', '/fr/x', '/q'])}{rng.choice(['', '?a=1&b', '#f', '/9'])}" for _ in range(1500)]
    urls += [None, "", "no scheme", "://", "a://b://c.com/", "http://é.com/漢/" + "x" * 5000]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(3, urls[3])], "page_id long, url string")
    known, trees = url_filter.fitted(url_filter.ruled(url_filter.located(pages)).where("action is not null"))
    got = url_filter.judged(pages).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_verdict(known, trees, urls[r["page_id"]])


def test_pages_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    assert [r["verdict"] for r in url_filter.judged(pages).collect()] == ["allow", "allow"]
    assert url_filter.judged(pages.where("page_id > 5")).count() == 0


def plain_marginals(model, odds, first):
    """Sums over all label sequences of each text."""
    n = len(odds)
    ends = [*first[1:], n]
    out = []
    for i, j in zip(first, ends):
        total = np.zeros((j - i, 2))
        for code in range(1 << (j - i)):
            s = [code >> k & 1 for k in range(j - i)]
            score = model.start[s[0]] + sum(odds[i + k] * v for k, v in enumerate(s)) + sum(model.move[a, b] for a, b in zip(s, s[1:]))
            for k, v in enumerate(s):
                total[k, v] += np.exp(score)
        out += (total[:, 1] / total.sum(axis=1)).tolist()
    return out


def test_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    model = toxicity.Crf(weights=rng.normal(0, 1, (toxicity.KINDS, toxicity.BUCKETS)), bias=-0.5, move=rng.normal(0, 1, (2, 2)), start=rng.normal(0, 1, 2))
    f = rng.integers(0, toxicity.BUCKETS, (23, 4))
    first = np.array([0, 1, 9, 14])
    got = model.marginals(f, first)
    assert got == pytest.approx(plain_marginals(model, model.odds(f), first.tolist()), abs=1e-9)


def plain_likelihood(model, f, y, first):
    """Log-likelihood of the labels y, summed over all labellings of each text, less the prior."""
    odds, value = model.odds(f), 0.0
    for i, j in zip(first, [*first[1:], len(f)]):
        scores = {}
        for code in range(1 << (j - i)):
            s = tuple(code >> k & 1 for k in range(j - i))
            scores[s] = model.start[s[0]] + sum(odds[i + k] * v for k, v in enumerate(s)) + sum(model.move[a, b] for a, b in zip(s, s[1:]))
        value += scores[tuple(y[i:j].tolist())] - np.log(sum(np.exp(v) for v in scores.values()))
    used = sum((model.weights[k][np.unique(f[:, k])] ** 2).sum() for k in range(toxicity.KINDS))
    return value - toxicity.SHRINK / 2 * (used + (model.move**2).sum() + (model.start**2).sum())


def test_fit_is_the_likeliest(monkeypatch):
    monkeypatch.setattr(toxicity, "DROPPED", 0)
    rng = np.random.default_rng(2)
    f = rng.integers(0, 6, (40, 4)).astype(np.int32)
    y = ((f[:, 0] < 2) ^ (rng.random(40) < 0.2)).astype(np.int64)
    first = np.arange(0, 40, 5)
    known = np.zeros((toxicity.KINDS, toxicity.BUCKETS), dtype=bool)
    known[:, :6] = True
    model = toxicity.Crf().fit([(f, y, first)], known)
    best = plain_likelihood(model, f, y, first.tolist())
    for _ in range(40):
        other = toxicity.Crf(model.weights.copy(), model.bias + rng.normal(0, 0.05), model.move + rng.normal(0, 0.05, (2, 2)), model.start + rng.normal(0, 0.05, 2))
        other.weights[:, :6] += rng.normal(0, 0.05, (toxicity.KINDS, 6))
        assert plain_likelihood(other, f, y, first.tolist()) < best


def test_scores_against_enumeration(spark):
    """Scores and spans of short texts from the model's weights alone, by sums over all labellings."""
    rows, labels = toxic_rows(300)
    marked = frame(spark, labels, "doc_id long, quality int, toxic int")
    docs = rows + [(5000 + i, t) for i, t in enumerate([None, "", "...", "vileword", "hus talen snargh, mor VILEWORD end", "new words only, here", "Grimbold grimble unheard"])]
    table = frame(spark, docs)
    model = toxicity.fitted(table, marked)
    got = {r["doc_id"]: r for r in toxicity.scored(table, marked).collect()}
    for i, text in docs[-7:]:
        w = ALNUM.findall(lower(text))
        p = []
        if w:
            (f, *_), = toxicity._prepared([text], np.zeros(1, dtype=np.int64))
            assert len(f) == len(w)
            odds = [sum(float(model.weights[k][f[t, k]]) for k in range(toxicity.KINDS)) + model.bias for t in range(len(w))]
            p = plain_marginals(model, np.clip(odds, -30, 30), [0])
        top = min(max(max(p), 1e-6), 1 - 1e-6) if p else None
        x = [np.log(top / (1 - top)) if p else -12, np.log(sum(q for q in p if q > 1e-3) + 1e-3) if p else -7, np.log1p(len(w))]
        want = 1 / (1 + np.exp(-np.clip(np.dot(x, model.slopes) + model.offset, -30, 30)))
        assert got[i]["score"] == pytest.approx(want, abs=1e-6)
        assert [k for s in got[i]["spans"] for k in range(s["first"], s["last"] + 1)] == [k for k, q in enumerate(p) if q > 0.5]


def test_unseen_words_are_clean(spark):
    """Words that the fit has not seen don't make a clean document toxic."""
    rng = random.Random(12)
    rows, labels = toxic_rows(600)
    marked = frame(spark, labels, "doc_id long, quality int, toxic int")
    fresh = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10)))
    more = [(10_000 + i, t + " " + " ".join(fresh() for _ in range(n))) for (i, t), (_, _, y) in zip(rows, labels) if not y for n in (1, 5)]
    got = toxicity.scored(frame(spark, rows + [(d + 10_000 * k, t) for k, (d, t) in enumerate(more)]), marked).where("doc_id >= 10000").collect()
    assert len(got) == len(more) and sum(r["score"] >= toxicity.THRESHOLD for r in got) <= 0.02 * len(got)


def test_copies_count_once():
    text = words(60)
    assert toxicity._alone([text, text + " end", words(60, 500), "", "a b", "a b", text]).tolist() == [True, False, True, True, True, False, False]


def toxic_rows(n=600, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        text = [f"{rng.choice(['hus', 'tal', 'mor', 'ven'])}{rng.choice(['en', 'et', 'lig', 's'])}{rng.randrange(40)}" for _ in range(rng.randrange(20, 60))]
        y = int(rng.random() < 0.2)
        if y:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(["Grimbold", "grimble", "snargh,", "vileword"])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, y))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_rows()
    docs = frame(spark, rows).withColumn("score", F.lit("clash"))
    marked = frame(spark, labels, "doc_id long, quality int, toxic int")
    got = toxicity.scored(docs, marked).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    truth = {d: y for d, _, y in labels}
    held = [r for r in got if r["held"]]
    assert len(held) > 100
    assert np.mean([(r["score"] >= 0.3) == truth[r["doc_id"]] for r in held]) > 0.97
    for r in held:
        if truth[r["doc_id"]]:
            w = r["text"].lower().replace(",", "").split()
            found = [k for s in r["spans"] for k in range(s["first"], s["last"] + 1)]
            assert any(w[k].startswith(("grimb", "snargh", "vile")) for k in found)
    flipped = frame(spark, [(d, q, 1 - y) if r else (d, q, y) for (d, q, y), r in zip(labels, [x["held"] for x in sorted(got, key=lambda x: x["doc_id"])])], "doc_id long, quality int, toxic int")
    again = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, flipped).collect()}
    assert again == {r["doc_id"]: r["score"] for r in got}  # held-out labels change nothing


def test_toxicity_awkward(spark):
    rows, labels = toxic_rows(200)
    marked = frame(spark, [*labels, (None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows + [(d + 1000 if d else None, t) for d, t in AWKWARD])
    got = toxicity.scored(docs, marked).collect()
    assert len(got) == len(rows) + len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.scored(docs, marked.where("doc_id < 0")).collect()
    assert {r["score"] < 0.3 for r in none} == {True}
    assert toxicity.scored(frame(spark, []), marked).count() == 0
