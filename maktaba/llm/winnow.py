"""Document fingerprints by winnowing: rolling k-gram hashes, the least of each window, positions kept.

Hashes cover K characters. In each window of WINDOW consecutive k-grams the least hash is chosen, of equal ones the
rightmost. Two texts that share WINDOW + K - 1 characters in a row therefore share a chosen hash, and the position tells
where. A text with fewer than K characters has one hash, of the whole text at position 0; an empty text has none.

The fingerprint is the text's chosen hashes in order of position. Likeness is the Jaccard similarity of the sets of chosen
hashes: 1 for two empty fingerprints, 0 if just one is empty. Equal texts have equal fingerprints.

Cases: a null text is empty; rows with equal ids stand in order of their text, so the next document of a repeated row is
its copy; a null id comes first; very long texts are hashed a piece at a time; an empty table gives an empty result, and
a single document is its own next one; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, id_ranges, mix, partitions, text_slices

K = 16
WINDOW = 48
#: Characters hashed at a time, with an overlap of one window.
PIECE = 1 << 20


def kgram_hashes(codes: np.ndarray, k: int = K) -> np.ndarray:
    """Polynomial hashes of all k-grams modulo 2**64, doubled in length step by step, then scrambled."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    have, size, out, done, base = codes.astype(np.uint64) + np.uint64(1), 1, None, 0, BASE
    rest = k
    while rest:
        if rest & 1:  # what is done so far, then a piece of this size
            piece = have[done:]
            out = piece if out is None else out[: len(piece)] * np.uint64(pow(BASE, size, 1 << 64)) + piece
            done += size
        rest >>= 1
        if rest:
            have = have[:-size] * np.uint64(base) + have[size:]
            base, size = pow(base, 2, 1 << 64), 2 * size
    return mix(out[:n])


def chosen(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The positions that hold the rightmost least hash of some window, ascending. A short text is one window."""
    window = min(window, len(hashes))
    if not window:
        return np.zeros(0, np.int64)
    least, at, size = hashes, np.arange(len(hashes)), 1

    def join(a, pa_, b, pb):
        right = b <= a
        return np.where(right, b, a), np.where(right, pb, pa_)

    while 2 * size <= window:
        least, at = join(least[:-size], at[:-size], least[size:], at[size:])
        size *= 2
    if size < window:
        step = window - size
        least, at = join(least[:-step], at[:-step], least[step:], at[step:])
    return np.unique(at)


def fingerprint(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The chosen hashes (unsigned 64-bit) and their positions in characters."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(codes) < K:
        return kgram_hashes(codes, len(codes)), np.zeros(1, np.int64)
    found = []
    for i in range(0, max(1, len(codes) - K - WINDOW + 2), PIECE):
        hashes = kgram_hashes(codes[i : i + PIECE + WINDOW + K - 2])
        at = chosen(hashes)
        found.append((hashes[at], at + i))
    positions, first = np.unique(np.concatenate([p for _, p in found]), return_index=True)
    return np.concatenate([h for h, _ in found])[first], positions


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def as_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u8").tobytes().hex()


def fingerprints(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, and the chosen hashes (as signed 64-bit) with their positions."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches, text_column):
            found = [fingerprint(t or "") for t in rows.column(text_column).to_pylist()]
            hashes, positions = [h.view(np.int64) for h, _ in found], [p for _, p in found]
            yield pa.RecordBatch.from_arrays([rows.column(id_column), pa.array(hashes, pa.list_(pa.int64())), pa.array(positions, pa.list_(pa.int64()))], names=[id_column, "hashes", "positions"])

    return docs.select(id_column, text_column).mapInArrow(run, f"{id_column} {kind}, hashes array<long>, positions array<long>")


def with_next(docs: DataFrame, run, schema: str, *, id_column: str, text_column: str) -> DataFrame:
    """run(id, text, next text) over all documents in ascending id order; after the last comes the first.

    Documents go to id ranges in one shuffle. Each range's first document (one id per range) is sent to the range before
    it as well, where it stands last and is only seen as the next one.
    """
    n = partitions(docs)
    rows = id_ranges(docs.select(F.col(id_column).cast("long").alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text")), "_id", n)
    heads = sorted((r["_bucket"], r["first"]) for r in rows.groupBy("_bucket").agg(F.min(F.struct(F.col("_id").isNotNull().alias("known"), F.col("_id"))).getField("_id").alias("first")).collect())
    # Each non-empty range's first id, and the range that ends with it.
    before = {bucket: heads[i - 1][0] for i, (bucket, _) in enumerate(heads)}
    # One row per range: small enough to broadcast, whatever the size of the ranges.
    table = docs.sparkSession.createDataFrame([(bucket, head, before[bucket]) for bucket, head in heads], "_bucket int, _head long, _before int")
    rows = rows.join(F.broadcast(table), "_bucket")
    own, guest = F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("guest")), F.struct(F.col("_before").alias("b"), F.lit(1).alias("guest"))
    copies = F.when(F.col("_id").eqNullSafe(F.col("_head")), F.array(own, guest)).otherwise(F.array(own))
    rows = rows.withColumn("_to", F.explode(copies)).select(F.col("_to.b").alias("_bucket"), F.col("_to.guest").alias("_guest"), "_id", "_text")
    rows = rows.repartitionById(n, "_bucket").sortWithinPartitions("_bucket", "_guest", "_id", "_text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for some in text_slices(batches, "_text"):
            triples = []
            for bucket, guest, doc, text in zip(*(some.column(c).to_pylist() for c in ("_bucket", "_guest", "_id", "_text"))):
                if held is not None and held[0] == bucket:
                    triples.append((held[1], held[2], text))
                held = None if guest else (bucket, doc, text)
            if triples:
                yield run(triples)

    return rows.mapInArrow(walk, schema)


def edited_text(text: str, following: str) -> str:
    """The last quarter of the characters (rounded down) gives way to the first as many of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def compare_with_next(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and both likenesses."""

    def run(triples: list[tuple]) -> pa.RecordBatch:
        out, last = [], (None, None)
        for doc, text, following in triples:
            own = last[1] if last[0] == text else fingerprint(text)[0]
            nxt = fingerprint(following)[0]
            last = (following, nxt)
            edited = edited_text(text, following)
            changed = fingerprint(edited)[0]
            out.append((doc, len(text), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), as_text(own), as_text(changed), likeness(own, changed), likeness(own, nxt)))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [id_column, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    schema = f"{id_column} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, run, schema, id_column=id_column, text_column=text_column)
