"""Byte-level BPE through a sentencepiece model that is serialised from a rank file.

A rank file lists byte strings in merge order.  Every byte is mapped to one printable
character, so a piece is a plain string, and its score is its negative rank: the
best-scored neighbouring pair is then the pair with the lowest rank, which is the merge
that a byte-level BPE does next.  The normaliser is the identity.  Text is cut by the
vocabulary's pattern first and every match is encoded on its own; decoding looks every id
up in the inverse table.

Defined cases: a null text counts as empty and gives no ids; an empty text gives no ids and
decodes to no bytes; rows are independent, so repeated rows, null ids and extra columns pass
through unchanged, but for columns named ``ids`` or ``decoded`` (in any letter case), which the
result's own replace; an empty table gives an empty table.  Texts are encoded whole.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns, fresh, texts

#: Byte b is written as the character with this offset plus b.
BYTE_BASE = 0x100
#: Distinct pre-tokens a task remembers before it starts afresh (memory bound, not a limit).
CACHE_ENTRIES = 400_000
#: Texts that are cut before their new pre-tokens are encoded in one call.
GROUP = 200
#: Rows whose ids are in memory at once.
BATCH_ROWS = 2000
ENCODED = "struct<ids:binary,decoded:binary>"


def read_ranks(path: str) -> list[bytes]:
    """Pieces of a rank file in rank order (ranks are 0..n-1)."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    pieces = sorted((int(rank), base64.b64decode(piece)) for piece, rank in pairs)
    if [rank for rank, _ in pieces] != list(range(len(pieces))):
        raise ValueError("ranks must run from 0 without gaps")
    return [piece for _, piece in pieces]


def _to_chars(data: bytes) -> str:
    return "".join([chr(BYTE_BASE + b) for b in data])


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _int_field(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value & 0xFFFFFFFFFFFFFFFF)


def _bytes_field(number: int, data: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def serialise_model(pieces: list[bytes]) -> bytes:
    """A sentencepiece BPE ModelProto whose id of a piece is its rank; the last id is <unk>."""
    normal, unknown = 1, 2
    out = []
    for rank, piece in enumerate(pieces):
        body = (_bytes_field(1, _to_chars(piece).encode())
                + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)) + _int_field(3, normal))
        out.append(_bytes_field(1, body))
    body = _bytes_field(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0)
    out.append(_bytes_field(1, body + _int_field(3, unknown)))
    trainer = (_int_field(3, 2)                       # model_type: BPE
               + _int_field(4, len(pieces) + 1)       # vocab_size
               + _int_field(40, len(pieces))          # unk_id
               + _int_field(41, -1) + _int_field(42, -1) + _int_field(43, -1))
    normalizer = (_bytes_field(1, b"identity") + _int_field(3, 0)   # add_dummy_prefix
                  + _int_field(4, 0)                                # remove_extra_whitespaces
                  + _int_field(5, 0))                               # escape_whitespaces
    return b"".join(out) + _bytes_field(2, trainer) + _bytes_field(3, normalizer)


class Codec:
    """Encoder and decoder of one task; ids travel as little-endian unsigned 32-bit integers."""

    def __init__(self, model: bytes, pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.cut = regex.compile(pattern).findall
        size = self.processor.get_piece_size() - 1
        self.table = [bytes([ord(c) - BYTE_BASE for c in self.processor.id_to_piece(i)])
                      for i in range(size)]
        self.known: dict[str, bytes] = {}

    def learn(self, tokens: set[str]) -> None:
        """Encode pre-tokens that are not in the cache yet, all in one call."""
        fresh = list(tokens.difference(self.known))
        if len(self.known) + len(fresh) > CACHE_ENTRIES:
            self.known = {}
            fresh = list(tokens)
        mapped = [t.encode().decode("latin-1").translate(_LATIN) for t in fresh]
        encoded = self.processor.encode(mapped, num_threads=1)
        self.known.update(zip(fresh, [_packed(ids) for ids in encoded]))

    def encode(self, whole: list[str]) -> list[bytes]:
        """Packed ids of every text, a few hundred texts at a time."""
        out = []
        for at in range(0, len(whole), GROUP):
            cuts = [self.cut(t) for t in whole[at:at + GROUP]]
            self.learn(set().union(*cuts))
            known = self.known
            out += [b"".join([known[t] for t in tokens]) for tokens in cuts]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _packed(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


#: Latin-1 characters (one for each byte) to the characters that stand for the bytes.
_LATIN = {b: BYTE_BASE + b for b in range(256)}


def codec_column(vocab_path: str, pattern: str, text: Column) -> Column:
    """Struct of ``ids`` and ``decoded`` for a text column; keeps the rows where they are.

    The vocabulary is read on the driver and its model (about 1 MB, bounded by the file)
    travels with the function.
    """
    model = serialise_model(read_ranks(vocab_path))

    @F.arrow_udf(ENCODED)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = Codec(model, pattern)
        for column in batches:
            ids = codec.encode(texts(column))
            decoded = [codec.decode(i) for i in ids]
            yield pa.StructArray.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                names=["ids", "decoded"])

    return encode(text)


def encode(df: DataFrame, vocab_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``df`` with ``ids`` (packed) and ``decoded`` (bytes) of its text column appended.

    Ids take several times the room of their text, so the session's Arrow batches are
    lowered to ``BATCH_ROWS`` rows where they are larger.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(setting)) <= BATCH_ROWS:
        df.sparkSession.conf.set(setting, str(BATCH_ROWS))
    codec = fresh("_codec", df)
    keep = df.drop(*[c for c in df.columns if c.lower() in ("ids", "decoded")])
    return (df.withColumn(codec, codec_column(vocab_path, pattern, F.col(text_col)))
              .select(*columns(keep), f"{codec}.ids", f"{codec}.decoded"))


def digest(encoded: DataFrame) -> DataFrame:
    """Digest columns of an encoded table: counts and checksums instead of the ids themselves."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
