import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkwright.llm import line_dedup, near_dedup, nearlinks, substring_dedup
from linkwright.llm.automaton import SuffixAutomaton
from linkwright.llm.components import components
from linkwright.llm.words import SPACED as TABLE
from linkwright.llm.words import chunks, sliding_min

from .helpers import AWKWARD, SPACED, frame, lower, words


def test_words_agree_with_regex():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab é\t\n漢 X") for _ in range(rng.randrange(0, 40))) for _ in range(400)] + [None, "", " "]
    seen = {}
    for w in chunks(pa.array(texts, pa.string()), TABLE, lower=False):
        for t, row in enumerate(w.rows):
            got = [w.text(k, k + 1).decode() for k in range(w.first[t], w.first[t + 1])]
            assert got == SPACED.findall(texts[row] or "")
            for word, h in zip(got, w.hash[w.first[t] : w.first[t + 1]].tolist()):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("width", [1, 2, 3, 7, 43])
def test_sliding_min(width):
    a = np.random.default_rng(1).integers(0, 1000, 200)
    assert sliding_min(a, width).tolist() == [a[i : i + width].min() for i in range(len(a) - width + 1)]


def test_automaton_against_brute_force():
    rng = random.Random(2)
    for _ in range(150):
        known = [[rng.randrange(3) for _ in range(rng.randrange(0, 9))] for _ in range(4)]
        asked = [rng.randrange(3) for _ in range(12)]
        automaton = SuffixAutomaton()
        for k in known:
            automaton.add(k)
        runs = {tuple(k[i:j]) for k in known for i in range(len(k)) for j in range(i + 1, len(k) + 1)}
        want = [max([n for n in range(1, e + 2) if tuple(asked[e + 1 - n : e + 1]) in runs], default=0) for e in range(12)]
        assert automaton.matching_statistics(asked) == want


def plain_repeats(rows, width):
    seen, out = {}, []
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = SPACED.findall(text or "")
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if seen.setdefault(tuple(w[k : k + width]), doc) < doc:
                gone[k : k + width] = [True] * width
        out.append((doc, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    for doc, text in rows:
        if doc is None:
            w = SPACED.findall(text or "")
            out.append((None, len(w), 0, " ".join(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("crowd", [2, 200])
def test_repeats_against_brute_force(spark, crowd):
    rng = random.Random(4)
    passage = [str(rng.randrange(10**6)) for _ in range(30)]
    rows = list(AWKWARD)
    for i in range(40):
        noise = lambda: [str(rng.randrange(10**6)) for _ in range(rng.randrange(0, 25))]
        lo = rng.randrange(0, 12)
        rows.append((100 + i, " ".join(noise() + passage[lo : lo + rng.randrange(8, 30)] + noise() + rng.choice([[], ["a"] * 40]))))
    got = substring_dedup.remove_repeats(frame(spark, rows), width=10, crowd=crowd)
    assert sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got.collect()], key=str) == plain_repeats(rows, 10)


def test_repeats_of_nothing(spark):
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0
    one = substring_dedup.remove_repeats(frame(spark, [(1, words(60))])).first()
    assert (one["n_removed"], one["spans"]) == (0, [])


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(1, 60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(path + star + [(7, 7), (None, 3)], "a long, b long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100}
    assert {got[i] for i in [*range(1, 60), 500]} == {1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_near(rows):
    def shingles(text):
        w = SPACED.findall(lower(text))
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in ids)


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(1, None), (2, ""), (3, "one two"), (4, "ONE two"), (5, "one two three four five six"), (6, words(12_000))]
    base = [str(rng.randrange(10**6)) for _ in range(60)]
    for i in range(60):  # a group of near copies, some too far from the middle
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            text[rng.randrange(60)] = str(rng.randrange(10**6))
        rows.append((100 + i, " ".join(text)))
    chain = [str(rng.randrange(10**6)) for _ in range(100)]
    for i in range(8):  # each like the one before only
        rows.append((300 + i, " ".join(chain[5 * i : 5 * i + 60])))
    got = near_dedup.near_duplicates(frame(spark, rows))
    assert sorted(map(tuple, got.collect())) == plain_near(rows)


def test_near_duplicates_awkward(spark):
    docs = frame(spark, AWKWARD).withColumn("node", F.lit("clash")).withColumn("n_shingles", F.lit(1.5))
    rows = near_dedup.near_duplicates(docs).collect()
    assert len(rows) == len(AWKWARD)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["component_id"] == 1 and by[1][0]["kept"] and by[1][0]["n_shingles"] == 0
    assert {r["component_id"] for r in by[5]} == {4} and not any(r["kept"] for r in by[5])
    assert by[7][0]["component_id"] == 6 and by[None][0]["component_id"] == 6 and not by[None][0]["kept"]
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_packed_estimates(spark):
    rng = np.random.default_rng(3)
    mins = rng.integers(0, 1 << 63, (2, near_dedup.PERMS), dtype=np.uint64)
    mins[1, :64] = mins[0, :64]
    low = (mins >> np.uint64(40)) & np.uint64(15)
    sig = near_dedup.packed(mins)
    rows = spark.createDataFrame([(sig[0].tolist(), sig[1].tolist())], "x array<long>, y array<long>")
    assert rows.select(near_dedup.matching_bits(F.col("x"), F.col("y"))).first()[0] == int((low[0] == low[1]).sum())


def test_leftover_pairs_are_found(spark, monkeypatch):
    """Two texts that are not like the hub of their bucket, but like each other, are linked."""
    items = {1: range(100), 2: range(0, 97), 3: [*range(60), *range(200, 240)], 4: [*range(60), *range(200, 239)]}
    sets = spark.createDataFrame([(k, list(v)) for k, v in items.items()], "node long, items array<long>").cache()
    bands = spark.createDataFrame([(77, k) for k in items] + [(78, 1), (78, 2)], "key long, node long")
    for small, exact in ((16, False), (1, False), (16, True), (1, True)):
        monkeypatch.setattr(nearlinks, "SMALL_BUCKET", small)
        labels = nearlinks.link(nearlinks.members(bands), lambda _: sets, 75, 100, exact=exact)
        assert {r["node"]: r["component"] for r in labels.collect()} == {1: 1, 2: 1, 3: 3, 4: 3}


def plain_lines(rows):
    """Lines by the method's own words: 8-character shingles at every character of the lower-cased line with white space collapsed."""
    lines, out = [], []
    for doc, text in rows:
        for n, line in enumerate(text.split("\n") if text is not None else []):
            norm = re.sub(r"[ \t\r\x0b\x0c]+", " ", line.lower()).strip(" ")
            if norm:
                lines.append((doc, n, frozenset(norm[i : i + 8] for i in range(max(len(norm) - 7, 1)))))
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, _, a) in enumerate(lines):
        for j in range(i):
            b = lines[j][2]
            if 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    first = {}
    for i, (doc, n, _) in enumerate(lines):
        first[find(i)] = min(first.get(find(i), (doc, n)), (doc, n))
    return sorted((doc, n, *first[find(i)], (doc, n) == first[find(i)]) for i, (doc, n, _) in enumerate(lines))


def test_lines_against_brute_force(spark):
    rng = random.Random(11)
    base = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(1000)) for _ in range(30)) for _ in range(6)]
    rows = [(1, None), (2, ""), (3, "\n \n"), (4, "short"), (5, "Short \n\nshort"), (6, "long " * 3000)]
    cjk = "".join(chr(0x4E00 + i) for i in range(90))
    rows += [(7, f"{cjk}\n{cjk[:50]}\n{cjk[:1] + cjk}\r\n\t{cjk[:10]}\t{cjk[10:]}"), (8, "x" * 100 + "\n" + "x" * 101 + "\n" + "xy" * 50)]
    rows += [(9, "https://example.com/a/first\nhttps://example.com/zzz/quite-another\ntransaction-000001\ntransaction-999999\ntab\tone  two\x0bthree\ntab one two three")]
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(1, 4)):
            w = rng.choice(base).split()
            if rng.random() < 0.5:
                w[rng.randrange(30)] = "Changed"
            lines.append(rng.choice([" ", " ", "  ", ""]).join(w))
        rows.append((10 + i, "\n".join(lines)))
    docs = frame(spark, rows).withColumn("node", F.lit(1)).withColumn("line", F.lit("clash"))
    got = line_dedup.line_components(docs)
    assert sorted(map(tuple, got.collect())) == plain_lines(rows)
    kept = {r["doc_id"]: r["text"] for r in line_dedup.cleaned(docs).collect()}
    assert kept[5] == "" and kept[1] is None and kept[4] == "short"
    assert line_dedup.line_components(frame(spark, [])).count() == 0


def test_line_query_has_every_document(spark, tmp_path):
    rows = [(1, None), (2, " \n"), (3, "same line\nother one"), (4, "same line"), (4, "same line"), (None, "x"), (None, None)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, line_dedup.op4_line_dedup(spark, str(tmp_path)).collect()), key=str)
    assert got == [(1, 0, 0, ""), (2, 0, 0, ""), (3, 2, 0, ""), (4, 2, 2, "0,0"), (None, 1, 0, "")]


def test_lines_of_one_fingerprint(spark, monkeypatch):
    """Different lines stay two even if their first fingerprints are equal."""
    monkeypatch.setattr(line_dedup, "node", lambda norm: F.length(norm).cast("long"))
    got = line_dedup.line_components(frame(spark, [(1, "abcdefghij"), (2, "0123456789"), (3, "abcdefghij"), (4, "another")]))
    assert {r["doc_id"]: r["kept"] for r in got.collect()} == {1: True, 2: True, 3: False, 4: True}


def every_shingle(text):
    n = line_dedup.SHINGLE
    return {text[i : i + n] for i in range(max(len(text) - n + 1, 1))}


def test_line_ends_count(spark):
    """Lines without spaces and long words that differ past their beginnings are other lines."""
    cjk = "".join(chr(0x4E00 + i) for i in range(60))
    texts = ["https://example.com/a", "https://example.org/totally/other", "see https://example.com/1", "see https://example.com/2"]
    texts += [cjk[:30], cjk[:10] + cjk[30:50], "0123456789" + "ab" * 20, "0123456789" + "cd" * 20, cjk + "\U0001F600", cjk + "\U0001F601"]
    got = line_dedup.line_components(frame(spark, list(enumerate(texts))))
    kept = {r["doc_id"]: r["kept"] for r in got.collect()}
    want = {}
    for i, x in enumerate(map(every_shingle, texts)):
        want[i] = not any(line_dedup.DEN * len(x & y) >= line_dedup.NUM * len(x | y) for y in map(every_shingle, texts[:i]))
    assert kept == want and [i for i in want if not want[i]] == [3, 9]


def test_edited_lines_are_linked(spark):
    """One edit in a line of a dozen words, pairs between 0.80 and 0.85, and other white space are no other line."""
    rng = random.Random(4)
    rows, alone = [], set()
    for i in range(60):
        w = ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(12)]
        changed = w[:5] + ["x" + w[5][1:]] + w[6:]
        rows += [(3 * i, " ".join(w)), (3 * i + 1, " ".join(changed)), (3 * i + 2, " \t ".join(w) + " ")]
        alone.add(3 * i)
    a, b = (every_shingle(t) for t in (rows[0][1], rows[1][1]))
    assert 0.80 <= len(a & b) / len(a | b) < 0.85
    got = line_dedup.line_components(frame(spark, rows))
    assert {r["doc_id"] for r in got.where("kept").collect()} == alone


def test_query_columns(spark, tmp_path):
    frame(spark, AWKWARD).write.parquet(str(tmp_path / "documents.parquet"))
    row = substring_dedup.op2_substring_dedup(spark, str(tmp_path)).where("doc_id = 4").first()
    assert row["kept_sha256"] == hashlib.sha256(b"one two three").hexdigest()
