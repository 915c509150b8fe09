"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are pre-split by a regex (SAFE) at places that always lie between two matches of the pre-splitting pattern, so
the pieces' ids join up exactly: before a space that follows a character which is no white space, between a letter and a
digit, and before a punctuation mark other than the apostrophe that follows a letter or digit. Patterns of this kind hold
white space only at a match's start, never join letters with digits, and join a mark only with what comes after it.

Cases: a null text is an empty one, with no ids; repeated rows give equal rows; an empty table gives an empty result;
texts of any length are encoded whole; other columns are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

#: Texts above this many characters are encoded in pieces.
PIECE_CHARS = 1 << 16
#: Letters and marks that all versions of Unicode class alike: Latin, Cyrillic, Arabic, kana, Han and Hangul.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0410-\u044f\u0621-\u063a\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_MARK = re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\u060c\u061b\u061f\u3001\u3002\uff01\uff0c\uff1f")
SAFE = re.compile(rf"(?<=\S)(?= )|(?<=[{_LETTER}])(?=[0-9{_MARK}])|(?<=[0-9])(?=[{_LETTER}{_MARK}])")


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about size characters, cut at SAFE places only. A longer run without one stays whole."""
    at = 0
    while len(text) - at > size and (cut := SAFE.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The encoding of a rank file, loaded once in each worker."""
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_text(enc, text: str) -> np.ndarray:
    if len(text) <= PIECE_CHARS:
        return np.array(enc.encode_ordinary(text), dtype="<u4")
    return np.concatenate([np.array(enc.encode_ordinary(p), dtype="<u4") for p in safe_pieces(text)])


def _binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def encode(docs: DataFrame, rank_file: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text", decoded: bool = False) -> DataFrame:
    """One row per document: its id, n_tokens and ids (little-endian unsigned 32-bit, as binary).

    With decoded also the bytes that the ids decode to, made in the same pass.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for rows in text_slices(batches, text_column):
            ids = [encode_text(enc, t or "") for t in rows.column(text_column).to_pylist()]
            arrays = [rows.column(id_column), pa.array([len(x) for x in ids], pa.int64()), _binary([x.tobytes() for x in ids])]
            if decoded:
                arrays.append(_binary([enc.decode_bytes(x.tolist()) for x in ids]))
            yield pa.RecordBatch.from_arrays(arrays, names=[id_column, "n_tokens", "ids", *["decoded"] * decoded])

    return docs.select(id_column, text_column).mapInArrow(run, f"{id_column} {kind}, n_tokens long, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, rank_file: str, pattern: str, *, ids_column: str = "ids") -> DataFrame:
    """encoded with the column decoded: the raw bytes of its ids."""

    @F.pandas_udf("binary")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(rank_file, pattern)
        for column in batches:
            yield pd.Series([enc.decode_bytes(np.frombuffer(x, "<u4").tolist()) for x in column], dtype=object)

    return encoded.withColumn("decoded", raw(F.coalesce(F.col(ids_column), F.lit(b""))))
