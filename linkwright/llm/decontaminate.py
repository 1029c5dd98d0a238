"""Benchmark decontamination by a broadcast hash set of test n-grams (operator 5).

Windows of `width` normalised words of each benchmark item (an item of fewer words is one
window) are fingerprinted and sent to all tasks; each document's windows are looked up
vectorised, and every hit is verified on the words themselves before it counts.

A broadcast holds about MOST_WINDOWS windows at most.  A larger benchmark is split by
fingerprint into blocks of that size.  The documents are scanned once for each block; what
they hit is written to the shared folder, and a block's broadcast is destroyed before the
next one is read, so that driver and workers hold one block at a time.  Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import drop, stage, table
from linkwright.llm.words import ALNUM, U64, Words, chunks, rolling

WIDTH = 10
#: Windows in one broadcast: about 150 bytes each.
MOST_WINDOWS = 200_000
_BITS = 20


def _item_windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for w in chunks(batch.column(1), ALNUM, lower=True):
                rows = []
                for t, row in enumerate(w.rows):
                    i, j = int(w.first[t]), int(w.first[t + 1])
                    size = min(width, j - i)
                    if size:
                        prints = rolling(w.hash[i:j], size).view(np.int64).tolist()
                        rows += [(ids[row], size, p, _words(w, i + k, size)) for k, p in enumerate(prints)]
                if rows:
                    item, size, prints, words = zip(*rows)
                    columns = [pa.array(item), pa.array(size, pa.int32()), pa.array(prints, pa.int64()), pa.array(words, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["item_id", "size", "print", "words"])

    return run


def _words(w: Words, at: int, size: int) -> bytes:
    return b" ".join(w.text(k, k + 1) for k in range(at, at + size))


class WindowSet:
    """Windows by size and fingerprint, with the items each occurs in."""

    def __init__(self, rows) -> None:
        found: dict[int, dict[int, dict[bytes, set[str]]]] = {}
        for item, size, print_, words in rows:
            found.setdefault(size, {}).setdefault(print_ & (1 << 64) - 1, {}).setdefault(bytes(words), set()).add(item)
        self.sizes = {}
        for size, prints in found.items():
            keys = np.array(sorted(prints), dtype=U64)
            maybe = np.zeros(1 << _BITS, dtype=bool)
            maybe[keys >> U64(64 - _BITS)] = True
            self.sizes[size] = keys, maybe, [prints[k] for k in keys.tolist()]

    def hits(self, w: Words) -> list[tuple[int, int, set[str]]]:
        """(first word position, size, items) of each verified window in the texts of w."""
        out = []
        for size, (keys, maybe, items) in self.sizes.items():
            prints = rolling(w.hash, size)
            at = np.flatnonzero(maybe[prints >> U64(64 - _BITS)])
            spot = np.minimum(np.searchsorted(keys, prints[at]), len(keys) - 1)
            same = keys[spot] == prints[at]
            at, spot = at[same], spot[same]
            own = np.searchsorted(w.first, at, side="right")
            inside = at + size <= w.first[np.minimum(own, len(w.first) - 1)]
            for a, s in zip(at[inside].tolist(), spot[inside].tolist()):
                if who := items[s].get(_words(w, a, size)):
                    out.append((a, size, who))
        return out


_HITS = pa.list_(pa.struct([("at", pa.int32()), ("size", pa.int32()), ("items", pa.list_(pa.string()))]))
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _look(windows, last: bool, as_text: int):
    """Add the hits of one block of windows; after the last, put together what is known.

    Columns: what to keep..., then text at as_text and hits at the end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = windows.value
        for batch in batches:
            before = batch.column(batch.num_columns - 1)
            for w in chunks(batch.column(as_text), ALNUM, lower=True):
                hits = before.slice(w.rows.start, len(w.rows)).to_pylist()
                for at, size, who in use.hits(w):
                    t = int(np.searchsorted(w.first, at, side="right")) - 1
                    hits[t] = (hits[t] or []) + [{"at": at - int(w.first[t]), "size": size, "items": sorted(who)}]
                part = batch.slice(w.rows.start, len(w.rows))
                columns, names = part.columns[:-1], part.schema.names[:-1]
                if last:
                    new = [pa.array(c, k) for c, k in zip(_summed(w, hits), (pa.int64(), pa.int64(), _SPANS, pa.list_(pa.string())))]
                    yield pa.RecordBatch.from_arrays(columns + new, [*names, "n_words", "n_hit", "spans", "items"])
                else:
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(hits, _HITS)], [*names, "hits"])

    return run


def _summed(w: Words, hits: list) -> tuple[list, list, list, list]:
    counts = w.counts().tolist()
    n_hit, spans, items = [], [], []
    for n, found in zip(counts, hits):
        runs: list[list[int]] = []
        for at, to in sorted((h["at"], h["at"] + h["size"]) for h in found or ()):
            if runs and at <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], to)
            else:
                runs.append([at, to])
        n_hit.append(sum(b - a for a, b in runs))
        spans.append([{"first": a, "last": b - 1} for a, b in runs])
        items.append(sorted({i for h in found or () for i in h["items"]}))
    return counts, n_hit, spans, items


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, most: int = MOST_WINDOWS) -> DataFrame:
    """The columns of docs with n_words, n_hit, spans (word positions hit) and items added.

    Columns of docs that have one of these names are replaced.  A null text has no words
    and no hits; items without words, text or item_id take no part; rows that repeat a
    doc_id or item_id count each, and an item counts once for a document.  Without items
    nothing is hit, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    windows = stage(items.mapInArrow(_item_windows(width), "item_id string, size int, print long, words binary").distinct(), "windows")
    blocks = max(1, -(-windows.count() // most))
    keep = [c for c in docs.columns if c not in ("n_words", "n_hit", "spans", "items", "hits")]
    out = docs.select(*keep).withColumn("hits", F.lit(None).cast("array<struct<at: int, size: int, items: array<string>>>"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.drop("hits").schema)
    held = []
    for k in range(blocks):
        block = windows if blocks == 1 else windows.where(F.pmod(F.shiftrightunsigned("print", 20), F.lit(blocks)) == k)
        sent = spark.sparkContext.broadcast(WindowSet(block.collect()))  # at most about `most` rows
        last = k == blocks - 1
        more = (
            "n_words long, n_hit long, spans array<struct<first: int, last: int>>, items array<string>"
            if last
            else "hits array<struct<at: int, size: int, items: array<string>>>"
        )
        out = out.mapInArrow(_look(sent, last, keep.index("text")), f"{fields}, {more}")
        if not last:
            out = stage(out, "hits")
            sent.destroy()
            drop(*held)
            held = [out]
    drop(windows)
    return out


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Each document's hits; see contamination() for nulls, empty texts, repeated rows and empty tables."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = contamination(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def keep_clean(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents in which no benchmark window occurs, with the columns of docs.

    Rows are judged each by its own text; null and empty texts stay, as do all documents
    if the benchmark is empty; an empty table gives an empty result.
    """
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where("n_hit = 0").select(*docs.columns)
