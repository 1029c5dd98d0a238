import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkwright.llm import token_counts, token_output
from linkwright.llm.encoding import encoder

from .helpers import AWKWARD, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
BITS = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", ".", "?!", "'s", "don't", "1٣", "漢", "\xa0", "\x85", "\x1c", "×", "_", "<|endoftext|>", "<|"]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=30), st.lists(st.sampled_from(BITS), max_size=14).map("".join)))
def test_pieces_give_the_library_s_ids(text):
    got = encoder(PATH).encode(text)
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == ids_of(text)


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    use = encoder(path)
    assert not use.cuttable
    got = use.encode("Hello  there, World")
    want = Tokenizer.from_file(path).encode("Hello  there, World", add_special_tokens=False).ids
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 255), st.integers(0, 2**32 - 1)), max_size=50))
def test_codes_round_trip(values):
    control, data = token_output.pack(np.array(values, dtype="<u4"))
    assert len(control) == -(-len(values) // 4)
    assert token_output.unpack(control, data, len(values)).tolist() == values


@pytest.mark.parametrize("block", [4, 1 << 18])
def test_files_round_trip(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_output, "BLOCK_TOKENS", block)
    rows = AWKWARD[:]
    random.Random(1).shuffle(rows)
    docs = frame(spark, rows).repartition(3).withColumn("ids", F.lit("clash")).withColumn("start", F.lit(None).cast("string"))
    token_output.write_tokens(docs, str(tmp_path / "t"))
    got = token_output.read_tokens(spark, str(tmp_path / "t")).collect()
    assert sorted(((r["doc_id"], list(struct.unpack(f"<{r['n_tokens']}I", r["ids"]))) for r in got), key=str) == sorted(
        ((d, ids_of(t) + [2]) for d, t in rows), key=str
    )
    place = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == place
        place += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))


def test_no_documents(spark, tmp_path):
    token_output.write_tokens(frame(spark, []), str(tmp_path / "t"))
    assert token_output.read_tokens(spark, str(tmp_path / "t")).count() == 0


def test_query_digests(spark, tmp_path):
    rows = [r for r in AWKWARD if r[0] in (1, 2, 4, 8, 10)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["ids_crc32"] for r in token_output.op1_token_output(spark, str(tmp_path)).collect()}
    want = {d: zlib.crc32(np.array(ids_of(t) + [2], dtype="<u4").tobytes()) for d, t in rows}
    assert got == want


def test_counts_and_cache(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = frame(spark, AWKWARD).withColumn("digest", F.lit("clash")).withColumn("n_tokens", F.lit(0))
    want = sorted(((d, len((t or "").encode()), len(ids_of(t)), len(ids_of(t)) > 512) for d, t in AWKWARD), key=str)
    for _ in range(2):
        got = token_counts.token_counts(docs, cache)
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert token_counts.read_cache(spark, cache).count() == len({t or "" for _, t in AWKWARD})
    more = frame(spark, [(1, "new text"), (2, "")])
    assert token_counts.token_counts(more, cache).count() == 2
    assert token_counts.read_cache(spark, cache).count() == len({t or "" for _, t in AWKWARD}) + 1
    assert token_counts.token_counts(frame(spark, []), cache).count() == 0


def test_counts_trust_the_cache_of_this_tokenizer_only(spark, tmp_path):
    import hashlib

    cache, digest = str(tmp_path / "cache"), hashlib.sha256(b"abc").digest()
    rows = [(token_counts.tokenizer_digest(PATH), digest, 77), ("other", digest, 5)]
    spark.createDataFrame([(a, bytearray(b), c) for a, b, c in rows], token_counts.CACHE).write.parquet(cache)
    assert token_counts.token_counts(frame(spark, [(1, "abc")]), cache).first()["n_tokens"] == 77


def test_a_task_counts_a_text_once():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([b"x", b"y", b"x"], pa.binary()), pa.array(["a b", "c", "a b"])], ["digest", "text"])
    got = [r for out in token_counts._count(PATH)(iter([batch, batch])) for r in out.to_pylist()]
    assert [(r["digest"], r["n_tokens"]) for r in got] == [(b"x", len(ids_of("a b"))), (b"y", len(ids_of("c")))]


def test_long_pieces_are_not_kept():
    from linkwright.llm.encoding import Encoder

    use, long = Encoder(PATH), "Zm9v" * 5000
    for _ in range(3):
        assert use.encode(f"a {long} b") == np.array(ids_of(f"a {long} b"), dtype="<u4").tobytes()
    assert max(map(len, use._pieces), default=0) <= 64 and max(map(len, use._pieces.met)) <= 64


def test_counts_of_sentencepiece(spark, tmp_path):
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = token_counts.token_counts(frame(spark, [(1, "Hello there"), (2, None)]), str(tmp_path / "c"), path)
    want = len(sentencepiece.SentencePieceProcessor(model_file=path).encode("Hello there"))
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got.collect()) == [(1, want), (2, 0)]


def test_a_piece_met_twice_is_encoded_once(monkeypatch):
    from linkwright.llm import encoding

    monkeypatch.setattr(encoding, "KEPT_PIECES", 2)
    monkeypatch.setattr(encoding, "MET_PIECES", 3)
    pieces, made = encoding.Encoder(PATH)._pieces, []
    model = pieces.model

    class Counted:
        def tokenize(self, shown):
            made.append(shown)
            return model.tokenize(shown)

    pieces.model = Counted()
    for piece in ("one", "two", "one", "one", "two", "three", "three", "four"):
        assert pieces[piece] == np.array(ids_of(piece), dtype="<u4").tobytes()
        assert len(pieces) <= 2 and len(pieces.met) <= 3
    assert made == ["one", "two", "three", "four"]
