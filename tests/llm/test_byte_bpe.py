"""Byte-level BPE against tiktoken and as an exact round trip."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from casetrail.llm import byte_bpe, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["", "plain words, it's 12 o'clock", "  spaces \t\n\n tabs  ", "<unk> ▁ <|endoftext|>",
         "ééé ñandú ßtraße 東京 😀😀 \x00\x01", "a" * 5000 + " " * 300, "plain words, it's 12 o'clock"]


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def test_ids_and_round_trip(spark, reference):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (7, None)]
    df = spark.createDataFrame([(i, t, "mine") for i, t in rows],
                               "doc_id long, text string, ids string")
    out = byte_bpe.encode(df, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    got = out.collect()
    assert len(got) == len(rows)
    for row in got:
        text = row.text or ""
        assert bytes(row.decoded) == text.encode()
        assert np.frombuffer(row.ids, "<u4").tolist() == reference.encode_ordinary(text)


def test_query_on_a_whole_table(spark, sf_small, reference):
    docs = {r.doc_id: r.text for r in
            spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = queries.op7_byte_bpe(spark, sf_small).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        ids = np.asarray(reference.encode_ordinary(docs[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
            hashlib.sha256(docs[r.doc_id].encode()).hexdigest())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.digest(byte_bpe.encode(df, PATH, public_tokenizers.PATTERN)).collect() == []
