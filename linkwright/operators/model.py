"""The trained matcher: gradient-boosted trees over histograms, calibrated out of fold."""

from __future__ import annotations

import json
import socket
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright import vocab

CALIBRATION_FOLDS = 3
#: Values of a feature that a tree tells apart, as in the reference's trees.
BINS = 255
#: The least sum of second derivatives on either side of a split.
LEAST_HESSIAN = 1e-3
#: Rows that are looked at together.
BLOCK = 1 << 18
#: Rows that are dealt to tasks together.
DEALT = 1 << 12
#: Seconds that a task of the fit waits for another.
WAIT = 1800
#: The sum of an array over all tasks.
Total = Callable[[np.ndarray], np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def cuts_of(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Where a feature's bins end: between all its values, or between BINS - 1 quantiles; n: how often a value occurs."""
    values, at = np.unique(x, return_inverse=True)
    if len(values) > BINS:
        below = np.cumsum(np.bincount(at, n))
        ends = np.unique(np.searchsorted(below, below[-1] * np.arange(1, BINS) / BINS))
        ends = ends[ends < len(values) - 1]
        return (values[ends] + values[ends + 1]) / 2
    return (values[:-1] + values[1:]) / 2


class Layout:
    """How the bins of all features lie in a few bytes: features of few bins share one, as digits of it."""

    def __init__(self, widths: list[int]) -> None:
        self.widths, self.places, self.sizes = widths, [], []  # places: (byte, how far apart two bins lie in it)
        for w in widths:
            at = next((i for i, size in enumerate(self.sizes) if size * w <= 256), len(self.sizes))
            self.sizes += [1] * (at == len(self.sizes))
            self.places.append((at, self.sizes[at]))
            self.sizes[at] *= w
        ends = np.cumsum(widths)
        self.spans = [slice(int(e) - w, int(e)) for w, e in zip(widths, ends)]
        self.feature = np.repeat(np.arange(len(widths)), widths)

    def packed(self, columns: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
        """Rows by bytes."""
        out = np.zeros((len(columns[0]), len(self.sizes)), dtype=np.uint8)
        for x, c, (byte, apart) in zip(columns, cuts, self.places):
            out[:, byte] += (np.searchsorted(c, x, side="left") * apart).astype(np.uint8)
        return out

    def bins(self, f: int, bytes_: np.ndarray) -> np.ndarray:
        """Bins of feature f, in its byte."""
        return (bytes_.astype(np.int16) // self.places[f][1] % self.widths[f]).astype(np.uint8)

    def by_feature(self, sums: list[np.ndarray]) -> np.ndarray:
        """Sums by bin, one feature after the other, of sums by the values of each byte, which come last."""
        out = np.empty((*sums[0].shape[:-1], len(self.feature)))
        for f, (byte, apart) in enumerate(self.places):
            shape = (*out.shape[:-1], self.sizes[byte] // apart // self.widths[f], self.widths[f], apart)
            out[..., self.spans[f]] = sums[byte].reshape(shape).sum(axis=(-3, -1))
        return out


def exact(x: np.ndarray, most: float) -> np.ndarray:
    """x rounded such that sums, if no partial one is above most, are the same in any order."""
    step = 2.0 ** (np.ceil(np.log2(most)) - 52)
    return np.rint(x / step) * step


def _alone(x: np.ndarray) -> np.ndarray:
    return x


def grown(
    bins: np.ndarray, g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int, leaf: int, layout: Layout | None = None, total: Total = _alone
) -> tuple[list[list], np.ndarray]:
    """A tree as (feature or -1, bin, left, right, value) of each node, and the node of each row.

    bins: features, or the bytes of a layout, by rows.  total: the sum of an array over all tasks, each
    of which has some of the rows and finds the same tree.  Each level is one histogram, of the smaller
    child of each split; the other is what is left of its parent.
    """
    if layout is None:
        layout = Layout([int(b.max(initial=0)) + 1 for b in bins])
        bins = np.stack([sum(bins[f].astype(np.int16) * apart for f, (byte, apart) in enumerate(layout.places) if byte == i) for i in range(len(layout.sizes))])
    where = np.zeros(len(g), dtype=np.int32)

    def histogram(rows: np.ndarray, slot: np.ndarray, slots: int) -> np.ndarray:
        out = [np.zeros((3, slots, size)) for size in layout.sizes]
        for start in range(0, len(rows), BLOCK):
            some, at = rows[start : start + BLOCK], slot[start : start + BLOCK]
            weights = g.take(some), h.take(some), n.take(some)
            for byte, size in enumerate(layout.sizes):
                key = at * size + bins[byte].take(some)
                for i, weight in enumerate(weights):
                    out[byte][i] += np.bincount(key, weight, minlength=slots * size).reshape(slots, size)
        return total(layout.by_feature(out))

    known = histogram(np.arange(len(g)), np.zeros(len(g), dtype=np.int64), 1)
    whole = known[:, 0, layout.spans[0]].sum(axis=1)
    tree = [[-1, 0, 0, 0, -whole[0] / max(whole[1], LEAST_HESSIAN)]]
    level = [0]
    for _ in range(depth):
        left = np.empty_like(known)
        for span in layout.spans:
            np.cumsum(known[:, :, span], axis=2, out=left[:, :, span])
        last = layout.widths[0] - 1
        whole = left[:, :, last : last + 1]
        right = whole - left
        fit = (left[2] >= leaf) & (right[2] >= leaf) & (left[1] >= LEAST_HESSIAN) & (right[1] >= LEAST_HESSIAN)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - whole[0] ** 2 / whole[1]
        gain = np.where(fit, gain, 0.0)
        best = gain.argmax(axis=1)
        split = [i for i in range(len(level)) if gain[i, best[i]] > 1e-12]
        if not split:
            break
        first, byte, beyond = np.arange(len(tree)), np.zeros(len(tree), dtype=np.int64), np.zeros((len(tree), 256), dtype=np.uint8)
        parents, small, following = [], [], []
        for i in split:
            j = int(best[i])
            f = int(layout.feature[j])
            b, at = j - layout.spans[f].start, len(tree)
            tree[level[i]][:4] = [f, b, at, at + 1]
            first[level[i]], byte[level[i]] = at, layout.places[f][0] * len(where)
            beyond[level[i]] = layout.bins(f, np.arange(256)) > b
            for side in (left, right):
                tree.append([-1, 0, 0, 0, -side[0, i, j] / side[1, i, j]])
            following += [at, at + 1]
            small.append(0 if left[2, i, j] <= right[2, i, j] else 1)
            parents.append(i)
        for start in range(0, len(where), BLOCK):
            part = where[start : start + BLOCK]
            value = bins.take(byte.take(part) + np.arange(start, start + len(part)))
            part[:] = first.take(part) + beyond.take(part * 256 + value)
        slot_of = np.full(len(tree), -1, dtype=np.int64)
        for k, s in enumerate(small):
            slot_of[following[2 * k + s]] = k
        mine = np.flatnonzero((slot_of >= 0).take(where))
        less = histogram(mine, slot_of.take(where.take(mine)), len(split))
        more = known[:, parents] - less
        known = np.empty((3, 2 * len(split), len(layout.feature)))
        for k, s in enumerate(small):
            known[:, 2 * k + s], known[:, 2 * k + 1 - s] = less[:, k], more[:, k]
        level = following
    return tree, where


def boosted(
    bins: np.ndarray, layout: Layout, label: np.ndarray, n: np.ndarray, weights: dict[float, float], trees: int, rate: float, depth: int, leaf: int, total: Total
) -> tuple[float, list[list[list]]]:
    """Where the margin starts, and trees by bins, for rows that stand for n pairs each: Newton steps of the logistic loss."""
    ones, every = total(np.array([n[label == 1.0].sum(), n.sum()]))
    most = (ones * weights[1.0] + (every - ones) * weights[0.0]) or 1.0
    share = np.clip(ones * weights[1.0] / most, 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    weight = np.where(label == 1.0, weights[1.0], weights[0.0])
    raw, out = np.full(len(label), start), []
    for _ in range(trees):
        p = sigmoid(raw)
        g, h = n * exact(weight * (p - label), most), n * exact(weight * p * (1 - p), most)
        tree, where = grown(bins, g, h, n, depth, leaf, layout, total)
        raw += rate * np.array([t[4] for t in tree])[where]
        out.append([[f, b, left, right, rate * value] for f, b, left, right, value in tree])
    return start, out


def margins(found: dict, x: np.ndarray) -> np.ndarray:
    """The sum of the trees for each row of x."""
    out, every = np.full(len(x), found["start"]), np.arange(len(x))
    for columns in found["trees"]:
        feature, cut, left, right, value = (np.array(c) for c in columns)
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            at = np.where(inner, np.where(x[every, f] <= cut[at], left[at], right[at]), at)
        out += value[at]
    return out


def calibrated(margin: np.ndarray, y: np.ndarray, n: np.ndarray, largest: float, total: Total = _alone) -> tuple[float, float]:
    """Slope and intercept of Platt's logistic fit of the label by the margin, with his targets, which are never 0 or 1.

    No margin of any task is above largest.
    """
    ones, every = total(np.array([(n * y).sum(), n.sum()]))
    if not every:
        return 1.0, 0.0
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (every - ones + 2))
    largest = max(largest, 1.0)

    def loss(s: np.ndarray) -> float:
        z = s[0] * margin + s[1]
        most = every * (abs(s[0]) * largest + abs(s[1]) + 1)
        return float(total(np.array([(n * exact(np.logaddexp(0, z) - target * z, 2 * most)).sum()]))[0])

    s = np.array([0.0, np.log((ones + 1) / (every - ones + 1))])
    for _ in range(100):
        p = sigmoid(s[0] * margin + s[1])
        d, q = p - target, p * (1 - p)
        terms = (d * margin, d, q * margin**2, q * margin, q)
        sums = total(np.array([(n * exact(t, every * largest**2)).sum() for t in terms]))
        gradient, hessian = sums[:2], np.array([[sums[2], sums[3]], [sums[3], sums[4]]]) + 1e-12 * np.eye(2)
        step, size, now = np.linalg.solve(hessian, gradient), 1.0, loss(s)
        while size > 1e-10 and loss(s - size * step) > now:
            size /= 2
        s = s - size * step if size > 1e-10 else s
        if size <= 1e-10 or np.abs(step).max() < 1e-10:
            break
    return float(s[0]), float(s[1])


class Tasks:
    """The tasks of a barrier stage as a binary tree of connections, which sums arrays over all of them."""

    def __init__(self, context: BarrierTaskContext, secret: bytes) -> None:
        me, hosts = context.partitionId(), [i.address.rsplit(":", 1)[0] for i in context.getTaskInfos()]
        with socket.create_server(("", 0)) as server:
            server.settimeout(WAIT)
            ports = context.allGather(str(server.getsockname()[1]))
            self.parent = None
            if me:
                above = (me - 1) // 2
                self.parent = self._ready(socket.create_connection((hosts[above], int(ports[above])), WAIT))
                self.parent.sendall(secret)
            self.children: list[socket.socket] = []
            while len(self.children) < len([c for c in (2 * me + 1, 2 * me + 2) if c < len(hosts)]):
                child = self._ready(server.accept()[0])
                if self._received(child, len(secret)) == secret:
                    self.children.append(child)
                else:
                    child.close()

    @staticmethod
    def _ready(s: socket.socket) -> socket.socket:
        s.settimeout(WAIT)
        s.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
        return s

    @staticmethod
    def _received(s: socket.socket, size: int) -> bytearray:
        out, at = bytearray(size), 0
        while at < size:
            got = s.recv_into(memoryview(out)[at:])
            if not got:
                raise ConnectionError("another task of the fit has ended")
            at += got
        return out

    def total(self, x: np.ndarray) -> np.ndarray:
        """The sum over all tasks, in which each must ask for it."""
        x = np.ascontiguousarray(x, dtype=np.float64)
        for child in self.children:
            x = x + np.frombuffer(self._received(child, x.nbytes)).reshape(x.shape)
        if self.parent:
            self.parent.sendall(x.tobytes())
            x = np.frombuffer(self._received(self.parent, x.nbytes)).reshape(x.shape)
        for child in self.children:
            child.sendall(x.tobytes())
        return x

    def close(self) -> None:
        for s in filter(None, [self.parent, *self.children]):
            s.close()


def _binned(layout: Layout, cuts: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of different rows, as their bytes with 2 * fold + label last, and how many pairs each stands for."""

    def block(waiting: list[np.ndarray]) -> pa.RecordBatch:
        rows, n = np.unique(np.concatenate(waiting).view(np.dtype((np.void, len(layout.sizes) + 1))).ravel(), return_counts=True)
        parts = [[v[i : i + DEALT].tobytes() for i in range(0, len(rows), DEALT)] for v in (rows, n.astype(np.int32))]
        return pa.RecordBatch.from_pydict({c: pa.array(p, pa.binary()) for c, p in zip(("rows", "n"), parts)})

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        for b in batches:
            if b.num_rows:
                last = 2 * b["fold"].to_numpy() + (b["label"].to_numpy() == 1.0)
                waiting.append(np.column_stack([layout.packed([b[c].to_numpy() for c in vocab.FEATURES], cuts), last.astype(np.uint8)]))
            if sum(map(len, waiting)) >= BLOCK:
                yield block(waiting)
                waiting = []
        if waiting:
            yield block(waiting)

    return of


def _fitted(
    options: dict, weights: dict[float, float], layout: Layout, cuts: list[np.ndarray], secret: bytes
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All models, from the first task of a barrier stage; the model k leaves out fold k and is calibrated on it."""
    settings = [options[o] for o in ("maxIter", "stepSize", "maxDepth", "minInstancesPerNode")]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = len(layout.sizes) + 1
        blocks, counts = [np.empty((wide, 0), dtype=np.uint8)], [np.empty(0, dtype=np.int32)]
        for b in batches:
            blocks += [np.ascontiguousarray(np.frombuffer(v.as_py(), np.uint8).reshape(-1, wide).T) for v in b["rows"]]
            counts += [np.frombuffer(v.as_py(), np.int32) for v in b["n"]]
        rows, n = np.concatenate(blocks, axis=1), np.concatenate(counts)
        del blocks, counts
        context = BarrierTaskContext.get()
        tasks, made = Tasks(context, secret), []
        for k in range(CALIBRATION_FOLDS):
            fold, label = rows[-1] // 2, rows[-1] % 2
            seen = fold != k
            start, trees = boosted(np.ascontiguousarray(rows[:-1, seen]), layout, label[seen].astype(float), n[seen].astype(float), weights, *settings, tasks.total)
            columns = [[list(c) for c in zip(*tree)] for tree in trees]
            held, margin = np.flatnonzero(~seen), np.empty((~seen).sum())
            for at in range(0, len(held), BLOCK):
                some = rows[:, held[at : at + BLOCK]]
                x = np.stack([layout.bins(f, some[byte]) for f, (byte, _) in enumerate(layout.places)], axis=1)
                margin[at : at + BLOCK] = margins({"start": start, "trees": columns}, x)
            largest = abs(start) + sum(max(map(abs, c[4])) for c in columns)
            slope, intercept = calibrated(margin, label[~seen].astype(float), n[~seen].astype(float), largest, tasks.total)
            for c in columns:
                c[1] = [float(cuts[f][b]) if f >= 0 else 0.0 for f, b in zip(c[0], c[1])]
            made.append({"start": start, "trees": columns, "slope": slope, "intercept": intercept})
        tasks.close()
        if context.partitionId() == 0:
            yield pa.RecordBatch.from_pydict({"k": pa.array(range(len(made)), pa.int32()), "model": pa.array([json.dumps(m) for m in made])})

    return of


def _probability(models: list[dict]) -> Callable[..., pa.Array]:
    def of(*columns: pa.Array) -> pa.Array:
        x = np.stack([c.to_numpy(zero_copy_only=False) for c in columns], axis=1)
        x, at = np.unique(x, axis=0, return_inverse=True)
        each = [sigmoid(m["slope"] * margins(m, x) + m["intercept"]) for m in models]
        return pa.array(np.mean(each, axis=0)[at.ravel()], pa.float64())

    return of


def _cuts(rows: DataFrame) -> list[np.ndarray]:
    """cuts_of each feature; its different values are counted where the rows lie."""

    def of(rows: pa.Table) -> pa.Table:
        cuts = cuts_of(rows["value"].to_numpy(), rows["n"].to_numpy().astype(float))
        return pa.table({"feature": rows["feature"][:1], "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))})

    values = rows.select(F.posexplode(F.array(*vocab.FEATURES)).alias("feature", "value")).groupBy("feature", "value").agg(F.count("*").alias("n"))
    found = values.groupBy("feature").applyInArrow(of, "feature int, cuts array<double>").collect()
    return [np.array(r["cuts"], dtype=np.float64) for r in sorted(found, key=lambda r: r["feature"])]


def _at_once(spark: SparkSession) -> int:
    """Tasks that can run at the same time, of which a barrier stage must not have more."""
    context = spark.sparkContext._jsc.sc()
    return max(1, context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()))


class EntityMatcher:
    """Three boosted-tree models, each calibrated by a logistic fit on the fold it has not seen.

    The probability is the mean of the three.  Classes are weighted to the same total.
    The rows stay in the tasks of one barrier stage, as many as can run at once, which add up
    their histograms.  Sums are exact, so that the models do not depend on how rows are dealt.
    """

    def __init__(self, trees: int = 200, rate: float = 0.07, depth: int = 6, leaf: int = 20) -> None:
        self.options = {"maxIter": trees, "stepSize": rate, "maxDepth": depth, "minInstancesPerNode": leaf}
        self.models: list[dict] = []

    def fit(self, labelled: DataFrame) -> "EntityMatcher":
        """labelled: the features, label, source1_entity_id; read three times."""
        fold = F.pmod(F.xxhash64("source1_entity_id"), F.lit(CALIBRATION_FOLDS)).alias("fold")
        features = [F.col(c).cast("double").alias(c) for c in vocab.FEATURES]
        rows = labelled.select(*features, F.col("label").cast("double").alias("label"), fold)
        counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
        if len(counts) < 2:
            raise ValueError("both labels are needed")
        weights = {label: sum(counts.values()) / (2 * n) for label, n in counts.items()}
        cuts = _cuts(rows)
        layout = Layout([len(c) + 1 for c in cuts])
        blocks = rows.mapInArrow(_binned(layout, cuts), "rows binary, n binary").repartition(_at_once(rows.sparkSession))
        found = blocks.mapInArrow(_fitted(self.options, weights, layout, cuts, uuid.uuid4().bytes), "k int, model string", barrier=True).collect()
        self.models = [json.loads(r["model"]) for r in sorted(found, key=lambda r: r["k"])]
        return self

    def predict(self, features: DataFrame) -> DataFrame:
        """features with probability."""
        of = F.arrow_udf(_probability(self.models), "double")
        probability: Column = of(*[F.col(c).cast("double") for c in vocab.FEATURES])
        return features.withColumn("probability", probability)

    def save(self, path: str) -> None:
        rows = [(k, json.dumps(m)) for k, m in enumerate(self.models)]
        SparkSession.active().createDataFrame(rows, "k int, model string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> "EntityMatcher":
        out = cls()
        out.models = [json.loads(r["model"]) for r in SparkSession.active().read.parquet(path).orderBy("k").collect()]
        return out


def report(rows: DataFrame, path: str | None = None) -> str:
    """A one-row table as indented JSON, written to a local file if a path is given."""
    out = json.dumps(rows.first().asDict(recursive=True), indent=2, default=str)
    if path:
        with open(path, "w") as f:
            f.write(out)
    return out
