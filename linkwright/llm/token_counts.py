"""Token counts through a digest cache (operator 10).

The cache is a Parquet table of (tokenizer, digest, n_tokens).  The tokenizer's digest
covers its file, the library's version and the way texts are given to it.  Content is
normalised only in that a null is an empty text: any other change could change the count.
Texts whose digest the cache lacks are encoded once each, by one of the rows that hold
them, and their counts are appended to the cache in one commit.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import public_tokenizers
import sentencepiece
import tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import documents, work_dir
from linkwright.llm.encoding import encoder

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
CACHE = "tokenizer string, digest binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    library = f"sentencepiece {sentencepiece.__version__}" if path.endswith(".model") else f"tokenizers {tokenizers.__version__}"
    return hashlib.sha256(Path(path).read_bytes() + f"|{library}|plain".encode()).hexdigest()


_PIECES: dict[str, sentencepiece.SentencePieceProcessor] = {}


def _counter(path: str):
    if path.endswith(".model"):
        if path not in _PIECES:
            _PIECES[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(_PIECES[path].encode(text))
    use = encoder(path)
    return lambda text: len(use.encode(text)) // 4


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        done: set[bytes] = set()  # rows that repeat an id and a text, which come to one task
        for batch in batches:
            digests, n = [], []
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if digest not in done:
                    done.add(digest)
                    digests.append(digest)
                    n.append(count(text.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return run


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def token_counts(docs: DataFrame, cache: str, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit); new counts go to the cache.

    Every row counts for itself, so rows that repeat a doc_id, or have none, get the
    count of their own text.  A null text counts as empty; an empty table gives an
    empty result and leaves the cache as it is; other columns are ignored.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    version = tokenizer_digest(tokenizer)
    content = documents(docs).withColumn("text", F.coalesce("text", F.lit("")))
    content = content.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    narrow = content.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    known = read_cache(spark, cache).where(F.col("tokenizer") == version).select("digest")
    first = narrow.groupBy("digest").agg(F.min("doc_id").alias("first"))
    misses = first.join(known, "digest", "left_anti").select(F.col("digest").alias("missed"), "first")
    at = content["doc_id"].eqNullSafe(misses["first"]) & (content["digest"] == misses["missed"])
    texts = content.join(misses.hint("shuffle_hash"), at).select("digest", "text")
    counted = texts.mapInArrow(_count(tokenizer), "digest binary, n_tokens long")
    fresh = counted.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    fresh.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    counts = read_cache(spark, cache).where(F.col("tokenizer") == version)
    counts = counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))  # two writers may both add a text
    return narrow.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    """With a cache of its own, so that each call does the whole work; see token_counts() for nulls, repeated rows and an empty table."""
    cache = f"{work_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), cache)
