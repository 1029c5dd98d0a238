"""Toxicity by a linear-chain conditional random field (operator 7).

Documents are labelled, tokens are not, so token labels come first: in documents marked
toxic, a token is toxic if its word, or its first 4 to 6 letters, is found in toxic
training documents and (nearly) never in clean ones.  On these tokens a two-state CRF is
trained by L-BFGS on the exact conditional log-likelihood with a Gaussian prior on all
weights but the bias, so that the optimum is unique and a feature that tells nothing
weighs nothing.  The features are hashes of the word and of its beginnings.  Those that
fewer than two training documents have are one unknown feature of their kind, and so are
all features of some tokens drawn at random: a word that the training has not seen is
judged as such words were.  Forward-backward marginals give each token's chance to be
toxic; the highest one of a document, their sum and the document's length, through a
logistic calibration on documents that the fit has not seen, give its score, and runs of
tokens above one half the offending offsets.

The forward and backward passes run over all tokens of a chunk of texts at once: a text's
first token forgets the state before it, so texts can stand in one chain, and the chain
is cut into blocks whose products of 2 x 2 matrices are computed side by side.  The fit
runs in one task, on a sample that is bounded in documents and in characters; only the
model goes to the driver.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import release, table
from linkwright.llm.words import ALNUM, U64, Words, _powers, chunks, mix, rolling

#: Labelled documents the model is fitted on, at most, chosen by a hash of doc_id; longer ones are not chosen.
SAMPLE = 5_000
SAMPLE_CHARACTERS = 50_000
#: Characters of the sample, at most; the documents after it take no part.
SAMPLE_TOTAL = 8_000_000
THRESHOLD = 0.3
BUCKETS = 1 << 18
PREFIXES = (4, 5, 6)
KINDS = 1 + len(PREFIXES)
#: Evaluations of the likelihood at most, share of tokens whose features are dropped, and the prior's precision.
STEPS, DROPPED, SHRINK = 60, 0.1, 0.5
#: Minima by which near copies are told in the sample.
COPIES = 4


def features(w: Words) -> np.ndarray:
    """(tokens, 1 + len(PREFIXES)) hashed features: the word, and its first bytes if it has more."""
    up, down = _powers(len(w.data) + 1)
    total = np.zeros(len(w.data) + 1, dtype=U64)
    np.cumsum((w.data.astype(U64) + U64(1)) * up[: len(w.data)], out=total[1:])
    out = np.empty((len(w.hash), KINDS), dtype=np.int32)
    out[:, 0] = w.hash >> U64(64 - 18)
    for k, n in enumerate(PREFIXES):
        cut = np.minimum(w.begin + n, w.end)
        h = mix((total[cut] - total[w.begin]) * down[w.begin] + U64(n * 0xD6E8FEB86659FD93 % (1 << 64)))
        out[:, 1 + k] = h >> U64(64 - 18)
    return out


def _products(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Running products of 2 x 2 matrices inside blocks, scaled, the last of each block, and the sum of the scales' logarithms."""
    n = len(m)
    size = max(1, int(np.sqrt(n)))
    count = -(-n // size)
    padded = np.zeros((count * size, 2, 2))
    padded[:, 0, 0] = padded[:, 1, 1] = 1
    padded[:n] = m
    padded = padded.reshape(count, size, 2, 2)
    run = np.empty_like(padded)
    run[:, 0] = padded[:, 0]
    a, b, c, d = (padded[:, 0, i, j] for i in (0, 1) for j in (0, 1))
    scale = np.ones(count)
    logs = 0.0
    for i in range(1, size):
        p, q, r, s = (padded[:, i, k, j] for k in (0, 1) for j in (0, 1))
        a, b, c, d = a * p + b * r, a * q + b * s, c * p + d * r, c * q + d * s
        total = a + b + c + d
        a, b, c, d = a / total, b / total, c / total, d / total
        scale *= total
        if i % 8 == 0:
            logs, scale = logs + np.log(scale).sum(), np.ones(count)
        run[:, i, 0, 0], run[:, i, 0, 1], run[:, i, 1, 0], run[:, i, 1, 1] = a, b, c, d
    return run, run[:, -1], logs + np.log(scale).sum()


def _chain(m: np.ndarray) -> tuple[np.ndarray, float]:
    """Row vectors (1/2, 1/2) m[0] m[1] ... m[t], each scaled to sum 1, and the logarithm of the sum of the last."""
    run, ends, logs = _products(m)
    before = np.empty((len(ends), 2))
    x = y = 0.5
    for k, ((a, b), (c, d)) in enumerate(ends.tolist()):
        before[k] = x, y
        x, y = x * a + y * c, x * b + y * d
        total = x + y
        logs += math.log(total)
        x, y = x / total, y / total
    out = np.einsum("bi,btij->btj", before, run).reshape(-1, 2)[: len(m)]
    return out / out.sum(axis=1, keepdims=True), logs


@dataclass
class Crf:
    """Weights of state 1 against state 0 by kind and feature; transition and start scores."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros((KINDS, BUCKETS), dtype=np.float32))
    bias: float = -4.0
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    slopes: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 0.0]))
    offset: float = 0.0

    def odds(self, f: np.ndarray) -> np.ndarray:
        return sum(self.weights[k][f[:, k]].astype(np.float64) for k in range(KINDS)) + self.bias

    def marginals(self, f: np.ndarray, first: np.ndarray) -> np.ndarray:
        """P(state 1) of each token; first: positions of the first tokens of texts."""
        return passes(self.odds(f), self.move, self.start, first)[0]

    def fit(self, parts: list[tuple], known: np.ndarray) -> "Crf":
        """The likeliest weights under the prior, by L-BFGS.

        parts: (features, token labels, first tokens of texts) of some texts at a time, so that
        the passes need memory for one part only; known: which features have a weight of their
        own, by kind.
        """
        place = np.full((KINDS, BUCKETS), -1, dtype=np.int32)
        place[known] = np.arange(known.sum()) + KINDS
        place = np.where(place < 0, np.arange(KINDS, dtype=np.int32)[:, None], place)  # the first are the unknown ones
        size = int(known.sum()) + KINDS
        rng = np.random.default_rng(5)
        held = []
        for f, y, first in parts:
            at = np.stack([place[k][f[:, k]] for k in range(KINDS)])
            at[:, rng.random(len(y)) < DROPPED] = np.arange(KINDS, dtype=np.int32)[:, None]
            held.append((at, y, first))

        def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
            w, bias, move, start = x[:size], x[size], x[size + 1 : size + 5].reshape(2, 2), x[size + 5 :]
            value, grad = SHRINK / 2 * (x @ x - bias * bias), SHRINK * x
            grad[size] = 0
            for at, y, first in held:
                odds = np.clip(sum(w[a] for a in at) + bias, -30, 30)
                p, xi, t, logs = passes(odds, move, start, first, pairs=True)
                pairs = np.bincount(2 * y[t - 1] + y[t], minlength=4)
                value += logs - odds @ y - pairs @ move.ravel() - start @ np.bincount(y[first], minlength=2)
                diff = p - y
                for a in at:
                    grad[:size] += np.bincount(a, diff, size)
                grad[size] += diff.sum()
                grad[size + 1 : size + 5] += xi.ravel() - pairs
                grad[size + 5 :] += diff[first].sum() * np.array([-1, 1])
            return value, grad

        x = np.zeros(size + 7)
        x[size] = self.bias
        x = least(loss, x, STEPS)
        self.weights = x[:size].astype(np.float32)[place]
        self.bias, self.move, self.start = float(x[size]), x[size + 1 : size + 5].reshape(2, 2), x[size + 5 :]
        return self

    def summary(self, p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each text the log-odds that a token is toxic, of the likeliest (-12 without tokens),
        the logarithm of the expected number of toxic tokens, and that of the number of tokens."""
        n = np.diff(bounds)
        out = np.stack([np.full(len(n), -12.0), np.full(len(n), -7.0), np.log1p(n)], axis=1)
        full = np.flatnonzero(n)
        if len(full):
            q = np.clip(np.maximum.reduceat(p, bounds[:-1][full]), 1e-6, 1 - 1e-6)
            out[full, 0] = np.clip(np.log(q / (1 - q)), -12, 12)
            out[full, 1] = np.log(np.add.reduceat(np.where(p > 1e-3, p, 0), bounds[:-1][full]) + 1e-3)
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> "Crf":
        """Logistic fit of document labels on summaries, by Newton steps with a prior on (1, 0, 0) and 0."""
        rows, prior = np.column_stack([x, np.ones(len(x))]), np.array([1.0, 0, 0, 0])
        w = prior.copy()
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
            slope = rows.T @ (y - p) - 0.1 * (w - prior)
            bend = (rows * (p * (1 - p) + 1e-9)[:, None]).T @ rows + 0.1 * np.eye(4)
            w = w + np.clip(np.linalg.solve(bend, slope), -1, 1)
        self.slopes, self.offset = w[:3], float(w[3])
        return self

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.slopes + self.offset, -30, 30)))


def passes(odds: np.ndarray, move: np.ndarray, start: np.ndarray, first: np.ndarray, pairs: bool = False):
    """P(state 1) of each token by forward and backward passes; first: positions of the first tokens of texts.

    With pairs also the expected transitions, the positions they lead to (all but the first
    tokens), and the logarithm of the sum over all labellings.
    """
    n = len(odds)
    e = np.stack([np.ones(n), np.exp(np.clip(odds, -30, 30))], axis=1)
    m = np.exp(move)[None] * e[:, None, :]
    begins = np.exp(start)[None, :] * e[first]
    m[first] = begins[:, None, :]  # rows alike: what was before is forgotten
    alpha, logs = _chain(m)
    # backward: beta[t] = m[t + 1] beta[t + 1]; across texts the rows are alike, so beta is flat
    back = np.empty((n, 2, 2))
    back[0] = 1
    back[1:] = m[:0:-1].transpose(0, 2, 1)
    back[0] = np.eye(2)
    beta = _chain(back)[0][::-1]
    both = alpha * beta
    p = both[:, 1] / both.sum(axis=1)
    if not pairs:
        return (p,)
    inner = np.ones(n, dtype=bool)
    inner[first] = False
    t = np.flatnonzero(inner)
    xi = alpha[t - 1][:, :, None] * m[t] * beta[t][:, None, :]
    xi /= xi.sum(axis=(1, 2), keepdims=True)
    return p, xi.sum(axis=0), t, logs


def least(loss, x: np.ndarray, most: int, kept: int = 6) -> np.ndarray:
    """Where loss (value and gradient) is least, by L-BFGS with halved steps, after `most` evaluations at most."""
    value, grad = loss(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    used = 1
    while used < most and np.abs(grad).max() > 1e-2:
        way, told = grad.copy(), []
        for s, y, r in reversed(past):
            told.append(r * (s @ way))
            way -= told[-1] * y
        if past:
            s, y, r = past[-1]
            way /= r * (y @ y)
        else:
            way /= max(1.0, float(np.linalg.norm(grad)))
        for (s, y, r), told_ in zip(past, reversed(told)):
            way += (told_ - r * (y @ way)) * s
        step, slope = 1.0, grad @ way
        while used < most:
            new = x - step * way
            new_value, new_grad = loss(new)
            used += 1
            if new_value <= value - 1e-4 * step * slope:
                break
            step /= 2
        else:
            return x
        s, y = new - x, new_grad - grad
        if s @ y > 1e-10:
            past = [*past[1 - kept :], (s, y, 1 / float(s @ y))]
        done = value - new_value < 1e-5 * abs(new_value)
        x, value, grad = new, new_value, new_grad
        if done:
            break
    return x


def telling_features(parts: list[tuple]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each kind of feature, which of its values tell toxic documents, and which two documents have; parts: (features, owner, toxic)."""
    docs = sum(len(toxic) for _, _, toxic in parts)
    share = sum(int(toxic.sum()) for _, _, toxic in parts) / max(1, docs)
    out, known = [], []
    for k in range(KINDS):
        bad, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for f, own, toxic in parts:
            pair = np.unique(own * BUCKETS + f[:, k])  # once for each document
            marked = toxic[pair // BUCKETS] == 1
            bad += np.bincount(pair[marked] % BUCKETS, minlength=BUCKETS)
            good += np.bincount(pair[~marked] % BUCKETS, minlength=BUCKETS)
        # found in 3 toxic documents at least, and 20 times as often in toxic as in clean ones
        out.append((bad >= 3) & (bad * (1 - share) >= 20 * (good + 0.25) * share))
        known.append(bad + good >= 2)
    return out, np.stack(known)


def token_labels(f: np.ndarray, own: np.ndarray, toxic: np.ndarray, telling: list[np.ndarray]) -> np.ndarray:
    """1 for tokens of toxic documents with a feature that tells toxic documents."""
    y = np.zeros(len(f), dtype=bool)
    for k, values in enumerate(telling):
        y |= values[f[:, k]]
    return (y & (toxic[own] == 1)).astype(np.int64)


def _prepared(texts: list[str], toxic: np.ndarray) -> list[tuple]:
    """(features, owner, toxic, first tokens of texts with tokens, first) of some texts at a time."""
    out = []
    for w in chunks(pa.array(texts, pa.large_string()), ALNUM, lower=True):
        out.append((features(w), w.owner(), toxic[w.rows.start : w.rows.stop], w.first[:-1][w.counts() > 0], w.first))
    return out


def _alone(texts: list[str]) -> np.ndarray:
    """Which texts share none of COPIES minima of their runs of five words with an earlier one: of a group of near copies, one."""
    seen: list[set[int]] = [set() for _ in range(COPIES)]
    out = np.zeros(len(texts), dtype=bool)
    for w in chunks(pa.array(texts, pa.large_string()), ALNUM, lower=True):
        for t, row in enumerate(w.rows):
            h = w.hash[w.first[t] : w.first[t + 1]]
            runs = rolling(h, min(5, len(h))) if len(h) else np.zeros(1, dtype=U64)
            least_ = [int(mix(runs + U64(k)).min()) for k in range(COPIES)]
            out[row] = not any(x in s for x, s in zip(least_, seen))
            for x, s in zip(least_, seen):
                s.add(x)
    return out


def fit(texts: list[str], toxic: np.ndarray) -> Crf:
    """A calibrated model from documents and their labels; without any of one kind, the prior.

    Of near copies one takes part, so that words count by texts that have them, not by
    copies.  Every fifth document of either label is for the calibration alone, if there
    are ten at least.
    """
    model = Crf()
    alone = _alone(texts)
    texts, toxic = [t for t, a in zip(texts, alone) if a], toxic[alone]
    if not len(texts) or toxic.min() == toxic.max():
        model.offset = 4.0 if len(texts) and toxic.max() else -4.0
        model.slopes = np.zeros(3)
        return model
    rank = np.empty(len(texts), dtype=np.int64)
    for label in (0, 1):
        which = np.flatnonzero(toxic == label)
        rank[which] = np.arange(len(which)) if len(which) >= 10 else 1
    apart = rank % 5 == 0
    seen = _prepared([t for t, a in zip(texts, apart) if not a], toxic[~apart])
    telling, known = telling_features([x[:3] for x in seen])
    model.fit([(f, token_labels(f, own, marks, telling), first) for f, own, marks, first, _ in seen if len(f)], known)
    if len(set(toxic[apart].tolist())) == 2:
        seen = _prepared([t for t, a in zip(texts, apart) if a], toxic[apart])
    known = [model.summary(model.marginals(f, first) if len(f) else np.zeros(0), b) for f, _, _, first, b in seen]
    return model.calibrate(np.concatenate(known), np.concatenate([x[2] for x in seen]).astype(float))


def training(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text and toxic of at most `sample` labelled documents that are not held out, and place, their order by hash."""
    use = labels.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    use = use.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("place", F.xxhash64("doc_id", F.lit(7)))
    many = labels.count()
    if many > 8 * sample:  # so that what tasks send to be put in order is bounded in all
        use = use.where(F.pmod("place", F.lit(1_000_003)) < int(1_000_003 * 8 * sample / many))
    chosen = use.orderBy("place", "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.where(F.length("text") <= SAMPLE_CHARACTERS).join(F.broadcast(chosen), "doc_id").select("text", "toxic", "place")


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, toxic, total = [], [], 0
    for batch in batches:
        for text, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total += len(text)
            if total <= SAMPLE_TOTAL:
                texts.append(text)
                toxic.append(mark)
        if total > SAMPLE_TOTAL:
            break
    model = fit(texts, np.array(toxic, dtype=np.int64))
    del texts
    release()
    yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(pickle.dumps(model), 1)], pa.binary())], ["model"])


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Crf:
    """The model, fitted in one task on the sample in the order of its hashes."""
    rows = training(docs, labels, sample).repartition(1).sortWithinPartitions("place", "text", "toxic")
    made = rows.select("text", "toxic").mapInArrow(_fitted, "model binary").first()
    return pickle.loads(zlib.decompress(made["model"])) if made else fit([], np.zeros(0, dtype=np.int64))  # nothing is labelled


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _score(sent, as_text: int, spans: bool):
    span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for w in chunks(batch.column(as_text), ALNUM, lower=True):
                p = np.zeros(0)
                if len(w.hash):
                    p = model.marginals(features(w), w.first[:-1][w.counts() > 0])
                scores = model.scores(model.summary(p, w.first))
                part = batch.slice(w.rows.start, len(w.rows))
                new = [pa.array(scores)]
                if spans:
                    new.append(pa.array([_offsets(w, p, t) for t in range(len(w.rows))], span))
                yield pa.RecordBatch.from_arrays(part.columns + new, [*part.schema.names, "score", "spans"][: part.num_columns + len(new)])
        release()

    return run


def _offsets(w: Words, p: np.ndarray, t: int) -> list[dict]:
    """First and last word of each run of tokens that are likelier toxic than not."""
    i, j = w.first[t], w.first[t + 1]
    edge = np.flatnonzero(np.diff((p[i:j] > 0.5).astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
    return [{"first": int(a), "last": int(b) - 1} for a, b in edge]


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The columns of docs with score (0 to 1) and spans (first and last toxic word) added.

    Columns of docs with these names are replaced.  A null or empty text gets the score of
    a text without tokens; rows that repeat a doc_id are scored each; a row without doc_id
    is scored, and trains nothing; without labels of both kinds all scores are alike.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in ("score", "spans")]
    out = docs.select(*keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    sent = spark.sparkContext.broadcast(fitted(docs, labels, sample))
    return out.mapInArrow(_score(sent, keep.index("text"), True), f"{fields}, score double, spans array<struct<first: int, last: int>>")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Each document's score; see scored() for nulls, empty texts, repeated rows and missing labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents whose score is below the threshold, with the columns of docs.

    Rows are judged each by its own text; null and empty texts stay, as do all documents
    where nothing is labelled toxic; an empty table gives an empty result.
    """
    found = scored(docs, table(spark, sf_dir, "labels"))
    return found.where(F.col("score") < THRESHOLD).select(*docs.columns)
