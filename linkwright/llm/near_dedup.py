"""Near-duplicate documents by b-bit MinHash (operator 3).

One scan computes, for the set of word shingles of each text, 128 minima.  Of each
minimum only the low 4 bits are kept, 16 to a 64-bit integer; whole minima only go
into the keys of 32 bands of 4 rows.  Texts with equal sets collapse into one node
first.  Candidates from the bands are dropped if the similarity estimated from the
signatures by bit counts, corrected for the 1 in 16 chance of equal low bits, is six
standard deviations under the threshold; the rest are confirmed on full sets.

At a similarity of exactly 0.75 a pair misses all 32 bands with probability 5e-6.
Shingles and sets are held as 64-bit fingerprints.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm import nearlinks
from linkwright.llm.common import documents, drop, release, stage
from linkwright.llm.words import SPACED, U64, Words, chunks, mix

SHINGLE = 5
NUM, DEN = 75, 100
BANDS, ROWS = 32, 4
PERMS = BANDS * ROWS
BITS = 4
LANES = 64 // BITS
#: Estimates under this are six standard deviations below the threshold of 0.75.
LEAST_ESTIMATE = 0.75 - 6 * (0.75 * 0.25 / PERMS) ** 0.5 / (1 - 2.0**-BITS)

_RNG = np.random.default_rng(20240601)
_MUL = _RNG.integers(1, 1 << 63, PERMS, dtype=np.uint64) * U64(2) + U64(1)
_ADD = _RNG.integers(0, 1 << 63, PERMS, dtype=np.uint64)


def shingle_sets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle fingerprints of each text, concatenated, and their offsets."""
    counts, own = w.counts(), w.owner()
    width = np.minimum(counts, SHINGLE)  # a shorter text is one shingle of all its words
    n = np.where(counts > 0, counts - width + 1, 0)
    total = int(n.sum())
    which = np.repeat(np.arange(len(counts)), n)
    start = w.first[:-1][which] + np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    size = width[which]
    h = np.zeros(total, dtype=U64)
    padded = np.concatenate([w.hash, np.zeros(SHINGLE, dtype=U64)])
    for i in range(SHINGLE):
        use = i < size
        h = np.where(use, h * U64(0xA0761D6478BD642F) + padded[start + i], h)
    h = mix(h + size.astype(U64))
    order = np.lexsort((h, which))
    h, which = h[order], which[order]
    fresh = np.ones(total, dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (which[1:] != which[:-1])
    h, which = h[fresh], which[fresh]
    return h, np.searchsorted(which, np.arange(len(counts) + 1))


def minima(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(sets, PERMS) least values; no set may be empty."""
    out = np.empty((PERMS, len(bounds) - 1), dtype=U64)
    for p in range(PERMS):
        x = h * _MUL[p]
        x ^= x >> U64(29)
        x *= U64(0xBF58476D1CE4E5B9)
        x += _ADD[p]
        out[p] = np.minimum.reduceat(x, bounds[:-1])
    return np.ascontiguousarray(out.T)


def packed(mins: np.ndarray) -> np.ndarray:
    """Low BITS bits of (mixed) minima, LANES to an int64."""
    low = ((mins >> U64(40)) & U64((1 << BITS) - 1)).reshape(len(mins), PERMS // LANES, LANES)
    shift = (np.arange(LANES, dtype=U64) * U64(BITS))[None, None, :]
    return np.bitwise_or.reduce(low << shift, axis=2).view(np.int64)


def band_keys(mins: np.ndarray) -> np.ndarray:
    rows = mins.reshape(len(mins), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=U64) + U64(1), rows.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key * U64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return key.view(np.int64)


def digest(items: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(items.tobytes(), digest_size=8).digest(), "little", signed=True)


SIGNED = "doc_id long, n_shingles long, node long, sig array<long>, bands array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_shingles", "node", "sig", "bands"]
    for batch in batches:
        for w in chunks(batch.column(1), SPACED, lower=True):
            h, bounds = shingle_sets(w)
            n = np.diff(bounds)
            full = np.flatnonzero(n)
            # few texts at a time, so that their shingles stay in the cache
            parts, at = [], 0
            while at < len(full):
                to = at + 1
                while to < len(full) and bounds[full[to] + 1] - bounds[full[at]] <= 1 << 15:
                    to += 1
                b = np.append(bounds[full[at:to]], bounds[full[to - 1] + 1])
                parts.append(minima(h[b[0] : b[-1]], b - b[0]))
                at = to
            mins = np.concatenate(parts) if parts else np.zeros((0, PERMS), dtype=U64)
            sigs, keys = packed(mins), band_keys(mins)
            where = np.concatenate([[0], np.cumsum(n > 0)])
            nodes = pa.array([digest(h[bounds[t] : bounds[t + 1]]) if n[t] else None for t in range(len(n))], pa.int64())
            lists = [
                pa.ListArray.from_arrays(pa.array(where * m.shape[1], pa.int32()), pa.array(m.reshape(-1)))
                for m in (sigs, keys)
            ]
            ids = batch.column(0).slice(w.rows.start, len(w.rows))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), nodes, *lists], names)
    release()


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, node (fingerprint of the shingle set; null if empty), sig, bands."""
    return documents(docs).mapInArrow(_sign, SIGNED)


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = batch.column(2).to_numpy()
        for w in chunks(batch.column(1), SPACED, lower=True):
            h, bounds = shingle_sets(w)
            found = np.array([digest(h[bounds[t] : bounds[t + 1]]) for t in range(len(w.rows))], dtype=np.int64)
            asked = nodes[w.rows.start : w.rows.stop]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(h.view(np.int64)))
            both = pa.RecordBatch.from_arrays([pa.array(asked, pa.int64()), lists], ["node", "items"])
            yield both.filter(pa.array(found == asked))  # rows that repeat an id may hold another text


def sets_of(docs: DataFrame, holders: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, items (full shingle set); holders: node, doc_id of one document that has this set."""
    wanted = holders.join(nodes, "node").hint("shuffle_hash")
    texts = documents(docs).join(wanted, "doc_id").select("doc_id", "text", "node")
    return texts.mapInArrow(_shingles, "node long, items array<long>").dropDuplicates(["node"])


def matching_bits(x, y):
    """Equal lanes of two packed signatures, by exclusive or and bit counts."""
    ones = int("1" * (64 // BITS), 16)

    def unequal(a, b):
        d = a.bitwiseXOR(b)
        d = d.bitwiseOR(F.shiftright(d, 1))
        d = d.bitwiseOR(F.shiftright(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(ones)))

    return F.lit(PERMS) - F.aggregate(F.zip_with(x, y, unequal), F.lit(0), lambda s, v: s + v)


def estimated(x, y):
    """Similarity estimate from two packed signatures, corrected for chance collisions."""
    chance = 2.0**-BITS
    return (matching_bits(x, y) / F.lit(float(PERMS)) - chance) / (1 - chance)


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, node, root (a node of its component), component_id and kept of each row."""
    signed = stage(signatures(docs), "signed")
    full = signed.where("node is not null")
    holders = full.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n"))
    nodes = stage(full.select("node", "sig", "bands").dropDuplicates(["node"]), "nodes")
    bands = nodes.select("node", F.explode("bands").alias("key"))
    found = stage(nearlinks.members(bands), "members")

    held = [nodes, found]

    def sets(asked: DataFrame) -> DataFrame:
        held.append(stage(sets_of(docs, holders.select("node", "doc_id"), asked), "sets"))
        return held[-1]

    labels = nearlinks.link(
        found,
        sets,
        NUM,
        DEN,
        nodes.select("node", "sig"),
        lambda x, y: estimated(x, y) >= LEAST_ESTIMATE,
        sizes=holders.select("node", "n"),
    )
    labels = stage(labels, "labels")
    drop(*held)
    rooted = holders.join(labels, "node", "left").withColumn("root", F.coalesce("component", "node"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(least, "root").select("node", "root", "component_id")
    out = signed.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, component.isNull())
    return out.select("doc_id", "n_shingles", "node", "root", component.alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable over links), kept.

    Null, empty and all-space texts have an empty set and are linked with nothing.  Rows
    that repeat a doc_id are judged each by its own text.  A row without doc_id keeps a
    null component_id, or its component's least doc_id, and is kept only if it has none.
    An empty table gives an empty result; other columns are ignored.
    """
    return judged(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op3_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Each document's component; see near_duplicates() for nulls, empty texts, repeated rows and an empty table."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def keep_one(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group, a row of its least doc_id, with the columns of docs.

    Rows without words or text are in no group and all stay.  Rows that repeat a doc_id,
    or have none, are judged each by its own text, and one row of a group stays even if
    several have its least doc_id.  An empty table gives an empty result.
    """
    found = stage(judged(docs), "judged")
    again = found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias("_again"))
    again = stage(again, "again")
    kept = found.where("kept and doc_id is not null").join(again, F.col("doc_id") == F.col("_again"), "left_anti").select(F.col("doc_id").alias("_kept"))
    once = docs.join(kept, docs["doc_id"] == kept["_kept"], "left_semi")
    if again.isEmpty():
        return once
    row = f"_row_{uuid.uuid4().hex}"
    rows = docs.join(again, docs["doc_id"].eqNullSafe(again["_again"]), "left_semi")
    rows = stage(rows.withColumn(row, F.monotonically_increasing_id()), "rows")
    own = signatures(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "node")
    own = stage(rows.select(row, F.col("doc_id").cast("long").alias("doc_id")).join(own, row), "own")
    groups = found.where("node is not null").select("node", "root", "component_id").distinct()
    first = own.join(groups, "node").where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(row).alias(row))
    stay = first.select(row).unionByName(own.where("node is null").select(row))
    return once.unionByName(rows.join(stay, row, "left_semi").select(*docs.columns))
