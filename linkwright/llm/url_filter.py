"""URL filter: rules first, then gradient-boosted trees on lexical features (operator 6).

The rules label the urls they fit; a bounded sample of these trains the trees, which
judge every url that no rule fits.  Features: lengths, depth, digit ratios, entropies,
parameter counts, and statistics of the host's suffixes and the path's first parts
among the training urls.  Trees are grown on histograms with second-order gains.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from urllib.parse import parse_qsl

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import table

#: (action, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Labelled urls that the trees are fitted on, at most; chosen by a hash of the url.
SAMPLE = 20_000
#: Longer urls are not chosen.
SAMPLE_CHARACTERS = 2_000
TREES, DEPTH, RATE, LEAF, BINS = 40, 4, 0.3, 20, 32


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def _parts(url: str | None) -> tuple[str, str, str]:
    """Host, path and query of a url, as the rules see them."""
    rest = (url or "").partition("://")[2]
    m = re.match(r"([^/?#]*)([^?#]*)(?:\?([^#]*))?", rest)
    return re.sub("[A-Z]+", lambda x: x[0].lower(), m[1]), m[2], m[3] or ""


def _keys(host: str, path: str) -> tuple[str, str, str, str]:
    labels, steps = host.split("."), [s for s in path.split("/") if s]
    return labels[-1], ".".join(labels[-2:]), labels[0], steps[0] if len(steps) > 1 else ""


class Statistics:
    """Smoothed share of blocked urls by suffix, domain, first label and first path part."""

    def __init__(self, urls: Sequence[str | None], blocked: np.ndarray) -> None:
        self.prior = (blocked.sum() + 1) / (len(blocked) + 2)
        self.share: list[dict[str, float]] = [{} for _ in range(5)]
        tallies: list[dict[str, list[int]]] = [{} for _ in range(5)]
        for url, y in zip(urls, blocked.tolist()):
            for tally, key in zip(tallies, self.keys(url)):
                t = tally.setdefault(key, [0, 0])
                t[0] += int(y)
                t[1] += 1
        for share, tally in zip(self.share, tallies):
            share.update({k: (b + 4 * self.prior) / (n + 4) for k, (b, n) in tally.items() if n >= 5})

    @staticmethod
    def keys(url: str | None) -> tuple[str, ...]:
        host, path, _ = _parts(url)
        suffix, domain, first, step = _keys(host, path)
        return suffix, domain, first, step, f"{suffix}/{step}"

    def features(self, url: str | None) -> list[float]:
        host, path, query = _parts(url)
        whole = url or ""
        digits = sum(c.isdigit() for c in whole)
        return [
            len(whole),
            len(host),
            len(path),
            len(query),
            sum(1 for s in path.split("/") if s),
            host.count("."),
            digits / max(1, len(whole)),
            sum(c.isdigit() for c in path) / max(1, len(path)),
            _entropy(whole),
            _entropy(host),
            len(parse_qsl(query, keep_blank_values=True)),
            float("#" in whole),
            float(whole.startswith("https")),
            whole.count("-"),
            *[s.get(k, self.prior) for s, k in zip(self.share, self.keys(url))],
        ]


class BoostedTrees:
    """Binary log-loss boosting; trees are arrays in heap order."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        self.base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 1)))  # without labels: allow
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T] if len(x) else []
        binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)], axis=1) if len(x) else x
        score = np.full(len(y), self.base)
        self.trees = []
        for _ in range(TREES if len(y) else 0):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._grow(binned, p - y, p * (1 - p))
            self.trees.append(tree)
            score += leaf
        return self

    def _grow(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray):
        nodes = (1 << (DEPTH + 1)) - 1
        feature, cut, value = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
        at = np.zeros(len(g), dtype=np.int64)
        for node in range(nodes):
            mine = np.flatnonzero(at == node)
            if not len(mine):
                continue
            value[node] = -RATE * g[mine].sum() / (h[mine].sum() + 1)
            if 2 * node + 2 >= nodes or len(mine) < 2 * LEAF:
                continue
            top = (1e-6, -1, 0)
            for f in range(binned.shape[1]):
                b = binned[mine, f]
                n = np.cumsum(np.bincount(b, minlength=BINS))[:-1]
                gl = np.cumsum(np.bincount(b, g[mine], BINS))[:-1]
                hl = np.cumsum(np.bincount(b, h[mine], BINS))[:-1]
                gs, hs = g[mine].sum(), h[mine].sum()
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                gain[(n < LEAF) | (len(mine) - n < LEAF)] = -1
                k = int(np.argmax(gain))
                if gain[k] > top[0]:
                    top = (gain[k], f, k)
            if top[1] >= 0:
                feature[node], cut[node] = top[1], self.cuts[top[1]][top[2]]
                at[mine] = 2 * node + 1 + (binned[mine, top[1]] > top[2])
        return (feature, cut, value), value[at]

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                f = feature[at]
                inner = f >= 0
                right = x[np.arange(len(x)), np.maximum(f, 0)] > cut[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            score += value[at]
        return 1 / (1 + np.exp(-score))


def located(pages: DataFrame) -> DataFrame:
    """page_id, url, host and path."""
    url = F.col("url").cast("string")
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.select("page_id", url.alias("url"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))


def ruled(found: DataFrame, rules=RULES) -> DataFrame:
    """found with rule (the longest that fits) and action added."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, action = F.when(fits, host + path).otherwise(rule), F.when(fits, act).otherwise(action)
    return found.withColumn("rule", rule).withColumn("action", action)


def fitted(labelled: DataFrame, sample: int = SAMPLE) -> tuple[Statistics, BoostedTrees]:
    """Trees from url and action of at most `sample` rows."""
    use = labelled.select("url", "action", F.xxhash64("url").alias("place")).where(F.length("url") <= SAMPLE_CHARACTERS)
    many = use.count()
    if many > 2 * sample:  # so that what tasks send to be put in order is bounded in all
        use = use.where(F.pmod("place", F.lit(1_000_003)) < int(1_000_003 * 2 * sample / many))
    rows = use.orderBy("place", "url", "action").limit(sample).collect()
    urls, y = [r["url"] for r in rows], np.array([r["action"] == "block" for r in rows], dtype=np.float64)
    known = Statistics(urls, y)
    x = np.array([known.features(u) for u in urls], dtype=np.float64)
    return known, BoostedTrees().fit(x, y)


def _judge(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, trees = sent.value
        for batch in batches:
            verdicts = batch.column(4).to_pylist()
            open_ = [i for i, v in enumerate(verdicts) if v is None]
            if open_:
                urls = batch.column(1).to_pylist()
                p = trees.predict(np.array([known.features(urls[i]) for i in open_], dtype=np.float64))
                for i, b in zip(open_, p):
                    verdicts[i] = "block" if b >= 0.5 else "allow"
            columns = [batch.column(0), batch.column(2), batch.column(3), batch.column(5), pa.array(verdicts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict"])

    return run


def judged(pages: DataFrame, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule (null if none fits), verdict (allow or block).

    A null url, or one without ://, has an empty host and path, which no rule fits; the
    trees judge it.  Rows that repeat a page_id are judged each; without labelled urls
    the trees allow everything that is not ruled out; an empty table gives an empty
    result.
    """
    found = ruled(located(pages), rules)
    sent = pages.sparkSession.sparkContext.broadcast(fitted(found.where("action is not null"), sample))
    id_type = found.schema["page_id"].dataType.simpleString()
    return found.select("page_id", "url", "host", "path", "action", "rule").mapInArrow(
        _judge(sent), f"page_id {id_type}, host string, path string, rule string, verdict string"
    )


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    """Each page's verdict; see judged() for nulls, empty and repeated rows, and an empty table."""
    return judged(table(spark, sf_dir, "pages").select("page_id", "url"))
