"""Byte-level BPE through a sentencepiece model written straight from a vocabulary.

Every rank of the vocabulary becomes one piece: its bytes mapped to printable
characters, its score the negative rank, so that the best-scored merge is the merge of
lowest rank.  The model has no normalisation, no blank in front and no escaped blanks.
Texts are cut by the pattern of the vocabulary; each distinct piece of text is encoded
once per batch.  Decoding maps ids back to the bytes of their ranks.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wagegrid.llm.common import give_back, slices

#: Letters and numbers that came after version 16 of Unicode (first, last).
#: The tables that the ids must agree with know them as neither.
LATER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD),
    (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9),
    (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x16FF4, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA),
    (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
    (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96),
    (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED),
    (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD),
    (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
_LATER = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER) + "]")
#: A character that is no letter, number or blank, in place of those.
_NEITHER = "\ue000"

#: Pieces of text whose ids a task remembers, and the longest of them.
REMEMBERED = 200_000
_REMEMBERED_LENGTH = 48
#: Bytes of text encoded at a time (a longer text goes alone).
SLICE_BYTES = 1 << 20


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, in order of rank (ranks must be 0, 1, 2, ...)."""
    with open(path, "rb") as file:
        pairs = [(int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, filter(None, map(bytes.strip, file)))]
    pairs.sort()
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return [token for _, token in pairs]


def byte_letters() -> str:
    """One printable character for each byte: itself where printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(others)) for b in range(256))


def _field(number: int, value: bytes | int | float | str) -> bytes:
    """One field of a protocol buffer message."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def model_bytes(ranks: list[bytes]) -> bytes:
    """The sentencepiece model: field and enum numbers are those of its public schema."""
    letters = byte_letters()
    pieces = b"".join(
        _field(1, _field(1, token.decode("latin-1").translate(letters)) + _field(2, float(-rank)))
        for rank, token in enumerate(ranks)
    )
    unknown = _field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(ranks) + 1) + _field(40, len(ranks))
    normalizer = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return pieces + unknown + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes and decodes texts; the same vocabulary and pattern give the same ids."""

    def __init__(self, ranks: list[bytes], model: bytes, pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.letters = byte_letters()
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.known: dict[str, tuple[int, ...]] = {}
        # a whole piece of text that is a token is that token, even where merges miss it
        mapped = [t.decode("latin-1").translate(self.letters) for t in ranks]
        merged = self.pieces.encode(mapped)
        self.whole = {m: (i,) for i, (m, ids) in enumerate(zip(mapped, merged, strict=True)) if ids != [i]}

    def cut(self, text: str) -> list[str]:
        """The matches of the pattern."""
        if not text.isascii() and _LATER.search(text):
            known = _LATER.sub(_NEITHER, text)
            return [text[m.start() : m.end()] for m in self.pattern.finditer(known)]
        return self.pattern.findall(text)

    def _encode_pieces(self, pieces: list[str]) -> list[tuple[int, ...]]:
        mapped = [p.encode().decode("latin-1").translate(self.letters) for p in pieces]
        return [self.whole.get(m) or tuple(ids) for m, ids in zip(mapped, self.pieces.encode(mapped), strict=True)]

    def encode(self, texts: Iterable[str | None]) -> list[list[int]]:
        """Ids of every text; a null text has none."""
        cut = [self.cut(text or "") for text in texts]
        known = self.known
        new = list({p for pieces in cut for p in pieces if p not in known})
        known.update(zip(new, self._encode_pieces(new), strict=True))
        out = [[i for p in pieces for i in known[p]] for pieces in cut]
        if len(known) > REMEMBERED:
            known.clear()
        else:
            for p in new:
                if len(p) > _REMEMBERED_LENGTH:
                    del known[p]
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        ranks = self.ranks
        return b"".join([ranks[i] for i in ids])


def _sizes(column: pa.Array) -> list[int]:
    """Bytes of each text, or those that as many ids take."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        sizes = pc.binary_length(column)
    else:
        sizes = pc.multiply(pc.list_value_length(column), 4)
    return pc.fill_null(sizes, 0).to_pylist()


@lru_cache(maxsize=2)
def _codec(ranks: bytes, pattern: str) -> Codec:
    tokens = [base64.b64decode(t) for t in ranks.split(b"\n")]
    return Codec(tokens, model_bytes(tokens), pattern)


class Tokenizer:
    """Operators over one vocabulary.  The rank file is read where the job starts; tasks
    get the vocabulary (its size is that of the file) with their code."""

    def __init__(self, path: str, pattern: str):
        self.ranks = b"\n".join(base64.b64encode(t) for t in read_ranks(path))
        self.pattern = pattern

    def _each(self, df: DataFrame, column: str, make, schema: str | StructType) -> DataFrame:
        """``make`` on runs of rows whose ``column`` holds about ``SLICE_BYTES`` together."""
        held = df.sparkSession.sparkContext.broadcast(self.ranks)
        pattern = self.pattern

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codec = _codec(held.value, pattern)
                for first, last in slices(_sizes(batch.column(column)), SLICE_BYTES):
                    yield make(codec, batch.slice(first, last - first))
                give_back()

        return df.mapInArrow(run, schema)

    def encode(self, docs: DataFrame, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
        """All columns and the ids of the text, in ``ids_col`` (replaced if there).

        Null and empty texts have no ids.  Texts are encoded whole, each match of the
        pattern by itself, without special tokens.
        """
        kept = docs.drop(ids_col)
        schema = kept.withColumn(ids_col, F.lit(None).cast("array<int>")).schema

        def make(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = codec.encode(batch.column(text_col).to_pylist())
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
            return batch.append_column(ids_col, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))

        return self._each(kept, text_col, make, schema)

    def decode(self, tokens: DataFrame, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
        """All columns and the bytes of the ids; null for null ids."""
        kept = tokens.drop(out_col)
        schema = kept.withColumn(out_col, F.lit(None).cast("binary")).schema

        def make(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = batch.column(ids_col).to_pylist()
            found = [None if i is None else codec.decode(i) for i in ids]
            return batch.append_column(out_col, pa.array(found, pa.binary()))

        return self._each(kept, ids_col, make, schema)

    def digests(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, n_tokens and digests of the ids and of the bytes decoded from them.

        One pass: the lists of ids do not leave the task.  ``ids_sha256`` covers the ids
        as little-endian unsigned 32-bit integers.
        """
        docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        kind = docs.schema["doc_id"].dataType.simpleString()

        def make(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, ids_sha, decoded_sha = [], [], []
            for ids in codec.encode(batch.column("text").to_pylist()):
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
                decoded_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            return pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(decoded_sha, pa.string()),
            })

        return self._each(
            docs, "text", make, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
        )
