"""Token ids in files of byte-aligned variable-length codes (operator 1).

Ids are replaced by their rank in frequency, so that frequent ids take one byte.  The
ranks of a block are coded in the Stream VByte layout (Lemire et al., 2017): one control
byte holds the lengths, 1 to 4 bytes, of four values, and their low bytes follow in a
stream of their own.  Decoding is a numpy table lookup from control bytes to lengths.

A file is a Parquet table, so that any store Spark can write will do and lost tasks
leave nothing behind.  A row is a block of whole documents in ascending doc_id order:
run and seq (its place), first_token within the run, tokens, docs (int64 ids and presence),
lengths, control, data.  Runs are consecutive ranges of doc_id.  ranks/ holds the id of
each rank, which the vocabulary bounds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import documents, drop, stage, work_dir
from linkwright.llm.encoding import encoder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Tokens after which a block ends, at the end of a document.
BLOCK_TOKENS = 1 << 18

_LENGTHS = (np.arange(256)[:, None] >> (2 * np.arange(4))[None, :] & 3).astype(np.uint8) + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    n = len(values)
    padded = np.zeros(-(-n // 4) * 4, dtype="<u4")
    padded[:n] = values
    size = 1 + (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    control = ((size - 1).reshape(-1, 4) << (2 * np.arange(4, dtype=np.uint8))).sum(axis=1).astype(np.uint8)
    keep = np.arange(4)[None, :] < size[:, None]
    keep[n:] = False
    return control.tobytes(), padded.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = _LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n]
    end = np.cumsum(size, dtype=np.int64)
    start = end - size
    raw = np.concatenate([np.frombuffer(data, dtype=np.uint8), np.zeros(4, dtype=np.uint8)])
    out = raw[start].astype("<u4")
    for k in range(1, 4):
        has = np.flatnonzero(size > k)
        if len(has):
            out[has] |= raw[start[has] + k].astype("<u4") << np.uint32(8 * k)
    return out


def _encode(path: str, end_id: int | None, small: bool):
    kind = "<u2" if small else "<u4"
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(path)
        for batch in batches:
            ids = [np.frombuffer(use.encode(t or "") + end, dtype="<u4").astype(kind).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return run


def _tally(vocabulary: int, kind: str):
    """How often each id occurs in what a task reads: at most a row for each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=kind)
            total += np.bincount(ids, minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    return run


_BLOCK = "run int, seq int, first_token long, tokens long, docs binary, lengths binary, control binary, data binary"


def _blocks(rank_of: np.ndarray, kind: str):
    """Sorted documents (doc_id, ids) to blocks."""

    def block(run, seq, first, ids, parts) -> pa.RecordBatch:
        values = np.concatenate(parts)
        control, data = pack(rank_of[values])
        docs = np.array([(0, 0) if i is None else (1, i) for i in ids], dtype="<i8")
        lengths = np.array([len(p) for p in parts], dtype="<i8")
        row = [run, seq, first, len(values), docs.tobytes(), lengths.tobytes(), control, data]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 4
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], [c.split()[0] for c in _BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        seq, first, held, ids, parts = 0, 0, 0, [], []
        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc)
                parts.append(np.frombuffer(raw.as_buffer(), dtype=kind))
                held += len(parts[-1])
                if held >= BLOCK_TOKENS:
                    yield block(place, seq, first, ids, parts)
                    seq, first, held, ids, parts = seq + 1, first + held, 0, [], []
            parts = [p.copy() for p in parts]  # the batch's memory goes
        if ids:
            yield block(place, seq, first, ids, parts)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int | None = END_ID) -> None:
    """Encode whole texts (null: empty), append end_id to each and write the files to path.

    Documents come in ascending doc_id order; rows without doc_id come first, rows that
    repeat one follow each other.  An empty table gives files without blocks.  Columns
    other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    vocabulary = max(encoder(tokenizer).vocabulary, 0 if end_id is None else end_id + 1)
    small = vocabulary <= 1 << 16
    kind = "<u2" if small else "<u4"
    encoded = stage(documents(docs).mapInArrow(_encode(tokenizer, end_id, small), "doc_id long, ids binary"), "encoded", "zstd")
    tally = encoded.select("ids").mapInArrow(_tally(vocabulary, kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, dtype=np.int64)
    for row in tally.collect():  # a row for each id of the vocabulary at most
        counts[row["id"]] = row["n"]
    id_of = np.argsort(-counts, kind="stable").astype("<u4")
    rank_of = np.empty(vocabulary, dtype="<u4")
    rank_of[id_of] = np.arange(vocabulary, dtype="<u4")
    table = pa.table({"id_of": pa.array([id_of.tobytes()], pa.binary())})
    spark.createDataFrame(table).write.parquet(f"{path}/ranks")
    ordered = encoded.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(_blocks(rank_of, kind), _BLOCK).write.option("compression", "zstd").parquet(f"{path}/blocks")
    drop(encoded)


def _read(id_of: np.ndarray, starts: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                docs = np.frombuffer(r["docs"], dtype="<i8").reshape(-1, 2)
                lengths = np.frombuffer(r["lengths"], dtype="<i8")
                ends = np.cumsum(lengths)
                ids = id_of[unpack(r["control"], r["data"], int(ends[-1]))]
                start = starts[r["run"]] + r["first_token"] + ends - lengths
                offsets = pa.py_buffer((4 * np.concatenate([[0], ends])).astype("<i4").tobytes())
                values = pa.Array.from_buffers(pa.binary(), len(docs), [None, offsets, pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[:, 1], mask=docs[:, 0] == 0), pa.array(start), pa.array(lengths), values],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before the document), n_tokens, ids (little-endian unsigned 32-bit)."""
    id_of = np.frombuffer(spark.read.parquet(f"{path}/ranks").first()["id_of"], dtype="<u4")
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    runs = blocks.groupBy("run").agg(F.sum("tokens").alias("n")).orderBy("run").collect()
    starts, total = {}, 0
    for row in runs:  # two numbers for each range of documents, that is for each task that wrote
        starts[row["run"]] = total
        total += row["n"]
    return blocks.mapInArrow(_read(id_of, starts), "doc_id long, start long, n_tokens long, ids binary")


def op1_token_output(spark, sf_dir: str) -> DataFrame:
    """Each document's place in the files; see write_tokens() for nulls, repeated rows and an empty table."""
    return encoded_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)


def encoded_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the files, read them back, and describe each document's ids; also the pipeline's last stage.

    Every row has its own ids, also if it repeats a doc_id or has none; a null text is empty
    and has the end id alone; an empty table gives an empty result.
    """
    path = f"{work_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
