"""Substring dedup with suffix automata (operator 2).

A window is a run of `width` words.  A word goes if it is in a window whose words also
start, as a window, in a document with a smaller doc_id.

The reference of each document is all documents before it, which no executor could hold
as one automaton.  So the reference is cut into shards by content: every window has a
key, the least fingerprint of the 32-word runs in it, and equal windows have equal keys.
Runs of windows with one key (a segment, 59 words on average) go to the shard of that
key, and only if texts that differ share the key.  Within a shard segments come in order
of their first document: each is streamed through the automaton of the segments of
smaller documents, its matching statistics give the maximal runs of at least `width`
words, and then it is added to that automaton.  The automaton lives as long as its
shard is read, instead of being broadcast: the reference grows with the corpus, so a
broadcast of it has no size bound.

Equal texts are compared once (their first document stands for them), and so are equal
segments.  Keys that very many segments share (`crowd`) would make a shard of unbounded
size from segments that differ only in what surrounds a passage.  Their segments are
streamed through the automata of the key's first few segments, wherever they are; of what
these do not explain only the windows that two documents have go on to a shard, after
which equal content collapses.

Words are compared as 32-bit fingerprints within windows of `width` words, texts as
64-bit fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkwright.llm.automaton import SuffixAutomaton
from linkwright.llm.common import documents, drop, stage
from linkwright.llm.words import SPACED, U64, Words, chunks, rolling, sliding_min, starts_inside

WIDTH = 50
#: Longer keys give more and shorter segments, and fewer windows that straddle the ends of a passage.
KEY_WORDS = 32
#: Documents that share a key from which on it counts as crowded.
CROWD = 200
#: Segments of a crowded key that its others are compared with first.
REFS = 4


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _digests(w: Words) -> np.ndarray:
    h = w.hash.tobytes()
    return np.array([_hash(h[8 * i : 8 * j]) for i, j in zip(w.first[:-1].tolist(), w.first[1:].tolist())], dtype=np.int64)


def _runs(w: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, first window (a word position) and number of windows of each run of one key in a text."""
    if len(w.hash) < width:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    key_words = min(KEY_WORDS, width)
    least = sliding_min(rolling(w.hash, key_words), width - key_words + 1)
    inside = starts_inside(w, width)
    own = w.owner()[: len(inside)]
    fresh = np.ones(len(least), dtype=bool)
    fresh[1:] = (least[1:] != least[:-1]) | (own[1:] != own[:-1]) | (inside[1:] != inside[:-1])
    at = np.flatnonzero(fresh)
    n = np.diff(np.append(at, len(least)))
    use = inside[at]
    return least[at][use], at[use], n[use]


def _scan(width: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in chunks(batch.column(1), SPACED, lower=False):
                key, at, _ = _runs(w, width)
                own = np.searchsorted(w.first, at, side="right") - 1
                order = np.lexsort((key, own))
                key, own = key[order], own[order]
                fresh = np.ones(len(key), dtype=bool)
                fresh[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
                key, own = key[fresh], own[fresh]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(own, np.arange(len(w.rows) + 1)), pa.int32()), pa.array(key.view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(w.rows.start, len(w.rows)), pa.array(_digests(w)), lists],
                    ["doc_id", "digest", "keys"],
                )

    return scan


SEGMENT = "key long, crowded boolean, doc_id long, digest long, start int, windows int, content binary, same long"


def _segment(key, crowded, doc_id, digest, start, windows, content: bytes) -> tuple:
    return key, crowded, doc_id, digest, start, windows, content, _hash(content)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


_SEGMENT = pa.schema(
    [("key", pa.int64()), ("crowded", pa.bool_()), ("doc_id", pa.int64()), ("digest", pa.int64())]
    + [("start", pa.int32()), ("windows", pa.int32()), ("content", pa.binary()), ("same", pa.int64())]
)


def _cut(width: int):
    """Texts with the keys they share (doc_id, text, digest, keys, crowded) to segments."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, asked = batch.column(0).to_pylist(), batch.column(2).to_numpy()
            lists, flags = batch.column(3), batch.column(4)
            for w in chunks(batch.column(1), SPACED, lower=False):
                key, at, n = _runs(w, width)
                key = key.view(np.int64)
                symbols = (w.hash >> U64(32)).astype(np.uint32)
                own = np.searchsorted(w.first, np.append(at, len(w.hash)), side="right") - 1
                bounds = np.searchsorted(own[:-1], np.arange(len(w.rows) + 1))
                found = _digests(w)
                rows = []
                for t, row in enumerate(w.rows):
                    if found[t] != asked[row]:
                        continue
                    wanted = lists[row].values.to_numpy()
                    crowded = flags[row].values.to_numpy(zero_copy_only=False)
                    i, j = bounds[t], bounds[t + 1]
                    spot = np.minimum(np.searchsorted(wanted, key[i:j]), len(wanted) - 1)
                    for k in np.flatnonzero(wanted[spot] == key[i:j]).tolist():
                        first, many = int(at[i + k]), int(n[i + k])
                        content = symbols[first : first + many + width - 1].tobytes()
                        start = first - int(w.first[t])
                        rows.append(
                            _segment(int(key[i + k]), bool(crowded[spot[k]]), ids[row], int(asked[row]), start, many, content)
                        )
                if rows:
                    yield _batch(rows, _SEGMENT)

    return cut


def _runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and after-last position of each run of set flags."""
    return [tuple(r) for r in np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0)).reshape(-1, 2).tolist()]


def _first_look(width: int):
    """Crowded segments by key (key, same, doc_id, content, refs) with their windows that a
    segment of refs, of a smaller document, has; the other windows are left open."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, automata = None, []
        for batch in batches:
            hits, left = [], []
            for k, doc, content, refs in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "content", "refs"))):
                if k != key:
                    key, automata = k, []
                    for r in refs:
                        automata.append((r["doc_id"], SuffixAutomaton()))
                        automata[-1][1].add(np.frombuffer(r["content"], dtype=np.uint32).tolist())
                symbols = np.frombuffer(content, dtype=np.uint32).tolist()
                known = np.zeros(len(symbols) - width + 1, dtype=bool)
                for of, automaton in automata:
                    if of < doc and not known.all():
                        known |= np.array(automaton.matching_statistics(symbols))[width - 1 :] >= width
                hits.append([{"lo": i, "hi": j} for i, j in _runs_of(known)])
                left.append([{"lo": i, "hi": j} for i, j in _runs_of(~known)])
            kind = _HITS.field("hits").type
            columns = [batch.column(c) for c in ("key", "same", "doc_id", "content")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(hits, kind), pa.array(left, kind)], ["key", "same", "doc_id", "content", "hits", "open"]
            )

    return look


def _open_windows(width: int):
    """Fingerprints of the open windows of crowded segments."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(*(batch.column(c).to_pylist() for c in ("key", "same", "doc_id", "content", "open")))
            for key, same, doc, content, runs in columns:
                if not runs:
                    continue
                f = rolling(np.frombuffer(content, dtype=np.uint32).astype(U64), width).view(np.int64)
                at = np.concatenate([np.arange(r["lo"], r["hi"]) for r in runs])
                fixed = [pa.array(np.full(len(at), v, dtype=np.int64)) for v in (key, same, doc)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f[at]), *fixed, pa.array(at.astype(np.int32))], ["print", "key", "same", "doc_id", "offset"]
                )

    return windows


def _pieces(width: int):
    """Crowded segments with the offsets of open windows that another document has, to the runs of these."""
    names = ["key", "parent", "doc_id", "shift", "windows", "content", "same"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for m in batch.to_pylist():
                at = np.sort(np.array(m["offsets"], dtype=np.int64))
                for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                    i, n = int(run[0]), len(run)
                    content = m["content"][4 * i : 4 * (i + n + width - 1)]
                    rows.append((m["key"], m["same"], m["doc_id"], i, n, content, _hash(content)))
            if rows:
                types = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return pieces


_HITS = pa.schema(
    [("key", pa.int64()), ("same", pa.int64()), ("hits", pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))]
)


def shard_hits(segments: list[tuple[int, int, bytes]], width: int) -> list[tuple[int, list[dict]]]:
    """Runs of windows of each distinct segment that occur in a segment of a smaller document.

    segments: (document, id, content), by document.  Segments of one document are
    looked up before any of them is added.
    """
    out = []
    if len(segments) < 2:
        return out
    automaton, waiting = SuffixAutomaton(), []
    for doc, same, content in segments:
        if waiting and waiting[0][0] != doc:
            for _, symbols in waiting:
                automaton.add(symbols)
            waiting = []
        symbols = np.frombuffer(content, dtype=np.uint32).tolist()
        if len(automaton.size) > 1:
            long = np.array(automaton.matching_statistics(symbols)) >= width
            ends = np.flatnonzero(long)
            if len(ends):
                runs = np.split(ends, np.flatnonzero(np.diff(ends) > 1) + 1)
                out.append((same, [{"lo": int(r[0]) - width + 1, "hi": int(r[-1]) - width + 2} for r in runs]))
        waiting.append((doc, symbols))
    return out


def _match(width: int):
    """Distinct segments sorted by key and document (key, doc_id, same, content) to their hits."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []

        def hits() -> list[tuple]:
            return [(group, same, h) for same, h in shard_hits(held, width)]

        for batch in batches:
            rows = []
            for key, doc, same, content in zip(*(c.to_pylist() for c in batch.columns)):
                if key != group:
                    rows += hits()
                    group, held = key, []
                held.append((doc, same, content))
            if rows:
                yield _batch(rows, _HITS)
        if rows := hits():
            yield _batch(rows, _HITS)

    return match


def _apply(width: int):
    """Texts with decisions (doc_id, text, decisions) to what is left of them."""
    span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            decisions = batch.column(2).to_pylist()
            for w in chunks(batch.column(1), SPACED, lower=False):
                n, found = w.counts(), _digests(w)
                gone = np.zeros(len(w.hash) + 1, dtype=np.int32)
                for t, row in enumerate(w.rows):
                    at, to = int(w.first[t]), int(w.first[t + 1])
                    for d in decisions[row] or ():
                        if d["digest"] != found[t]:
                            continue
                        if d["copy"] and to - at >= width:
                            gone[at] += 1
                            gone[to] -= 1
                        for r in d["hits"] or ():
                            gone[at + r["lo"]] += 1
                            gone[at + r["hi"] + width - 1] -= 1
                removed = np.cumsum(gone[:-1]) > 0
                spans, texts = [], []
                for t in range(len(w.rows)):
                    i, j = int(w.first[t]), int(w.first[t + 1])
                    if i == j:
                        spans.append([])
                        texts.append("")
                        continue
                    edge = np.flatnonzero(np.diff(removed[i:j].astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                    spans.append([{"first": int(a), "last": int(b) - 1} for a, b in edge])
                    keep = np.flatnonzero(~removed[i:j]) + i
                    texts.append(b" ".join([w.data[a:b].tobytes() for a, b in zip(w.begin[keep].tolist(), w.end[keep].tolist())]).decode())
                total = np.concatenate([[0], np.cumsum(removed)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(w.rows.start, len(w.rows)),
                        pa.array(n.astype(np.int64)),
                        pa.array(total[w.first[1:]] - total[w.first[:-1]], pa.int64()),
                        pa.array(spans, span),
                        pa.array(texts, pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "spans", "kept_text"],
                )

    return apply


def _segments(docs: DataFrame, scanned: DataFrame, first: DataFrame, width: int, crowd: int) -> DataFrame:
    """Segments of the first document of each text whose keys other texts have too."""
    keys = scanned.select("doc_id", "digest", F.explode("keys").alias("key"))
    shared = (
        keys.groupBy("key")
        .agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"), F.count("*").alias("n"))
        .where("lo <> hi")
        .select("key", (F.col("n") > crowd).alias("crowded"))
    )
    stand = keys.join(shared, "key").join(first, ["doc_id", "digest"], "left_semi")
    wanted = stand.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set(F.struct("key", "crowded"))).alias("k"))
    texts = docs.join(wanted.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "digest", "k.key", "k.crowded")
    return stage(texts.mapInArrow(_cut(width), SEGMENT), "segments")


def _hits(distinct: DataFrame, width: int) -> DataFrame:
    """key, same, hits of distinct segments (key, doc_id, same, content), shard by shard."""
    shards = distinct.select("key", "doc_id", "same", "content").repartition("key").sortWithinPartitions("key", "doc_id", "same")
    return shards.mapInArrow(_match(width), "key long, same long, hits array<struct<lo: int, hi: int>>")


def _decided(places: DataFrame, owners: DataFrame, hits: DataFrame, at: str) -> DataFrame:
    """places (key, same, doc_id, windows and where they begin) with runs, the windows known before.

    All of them in documents after the first with this content, else the hits.
    """
    known = owners.join(hits, ["key", "same"], "left")
    begin = F.col(at)
    whole = F.array(F.struct(begin.alias("lo"), (begin + F.col("windows")).alias("hi")))
    part = F.transform("hits", lambda h: F.struct((h["lo"] + begin).alias("lo"), (h["hi"] + begin).alias("hi")))
    runs = F.when(F.col("doc_id") > F.col("owner"), whole).otherwise(part)
    return places.join(known, ["key", "same"]).withColumn("runs", runs).where("runs is not null")


def _crowded_hits(crowded: DataFrame, width: int) -> DataFrame:
    """key, same, hits of distinct segments whose keys very many share.

    First each goes through the automata of the key's REFS first segments.  What these do
    not explain is mostly unique to its document; only runs of windows that two documents
    have go on, and these collapse into few.
    """
    order = Window.partitionBy("key").orderBy("doc_id", "same")
    first = crowded.withColumn("place", F.row_number().over(order)).where(F.col("place") <= REFS)
    refs = first.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("doc_id", "content"))).alias("refs"))
    hits = "array<struct<lo: int, hi: int>>"
    joined = crowded.join(refs, "key").select("key", "same", "doc_id", "content", "refs")
    looked = stage(joined.mapInArrow(_first_look(width), f"key long, same long, doc_id long, content binary, hits {hits}, open {hits}"), "looked")
    seen = looked.mapInArrow(_open_windows(width), "print long, key long, same long, doc_id long, offset int")
    twice = seen.groupBy("print").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("print")
    offsets = seen.join(twice, "print").groupBy("key", "same").agg(F.collect_list("offset").alias("offsets"))
    cut = looked.select("key", "same", "doc_id", "content").join(offsets, ["key", "same"])
    pieces = stage(
        cut.mapInArrow(_pieces(width), "key long, parent long, doc_id long, shift int, windows int, content binary, same long"), "pieces"
    )
    distinct = pieces.groupBy("key", "same").agg(F.min("doc_id").alias("doc_id"), F.first("content").alias("content"))
    owners = pieces.groupBy("key", "same").agg(F.min("doc_id").alias("owner"))
    more = _decided(pieces.drop("content"), owners, _hits(distinct, width), "shift")
    both = looked.select("key", "same", "hits").unionByName(more.select("key", F.col("parent").alias("same"), F.col("runs").alias("hits")))
    return both.groupBy("key", "same").agg(F.flatten(F.collect_list("hits")).alias("hits"))


def remove_repeats(docs: DataFrame, width: int = WIDTH, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_words, n_removed, spans (first and last word removed), kept_text.

    A null text has no words, as has one of white space; texts of fewer than `width` words
    stay whole.  Rows that repeat a doc_id never remove words from each other.  A row
    without doc_id stays whole and removes nothing.  An empty table gives an empty
    result; other columns are ignored.
    """
    texts = documents(docs)
    scanned = stage(texts.where("doc_id is not null").mapInArrow(_scan(width), "doc_id long, digest long, keys array<long>"), "scanned")
    owners = scanned.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    segments = _segments(texts, scanned, owners, width, crowd)
    distinct = segments.groupBy("key", "same", "crowded").agg(F.min("doc_id").alias("doc_id"), F.first("content").alias("content"))
    distinct = stage(distinct, "distinct")
    hits = _hits(distinct.where("not crowded"), width).unionByName(_crowded_hits(distinct.where("crowded"), width))
    decided = _decided(
        segments.select("key", "same", "doc_id", "digest", "start", "windows"),
        distinct.select("key", "same", F.col("doc_id").alias("owner")),
        hits,
        "start",
    )
    runs = (
        decided.groupBy("doc_id", "digest")
        .agg(F.flatten(F.collect_list("runs")).alias("hits"))
        .withColumn("copy", F.lit(False))
    )
    copies = (
        scanned.select("doc_id", "digest")
        .join(owners.select("digest", F.col("doc_id").alias("owner")), "digest")
        .where("doc_id > owner")
        .select("doc_id", "digest", F.lit(None).cast("array<struct<lo: int, hi: int>>").alias("hits"), F.lit(True).alias("copy"))
    )
    decisions = runs.unionByName(copies).groupBy("doc_id").agg(F.collect_set(F.struct("digest", "copy", "hits")).alias("decisions"))
    decisions = stage(decisions, "decisions")
    drop(scanned, segments, distinct)
    joined = texts.join(decisions.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "decisions")
    return joined.mapInArrow(
        _apply(width), "doc_id long, n_words long, n_removed long, spans array<struct<first: int, last: int>>, kept_text string"
    )


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
