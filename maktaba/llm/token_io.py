"""Token files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

A file holds one block of documents in ascending id order:
  magic "TKR1", then four little-endian 64-bit counts (documents, ids, control bytes, data bytes),
  the documents' ids and counts (64-bit each), the control bytes, the data bytes.
An id is stored as its rank by frequency over the whole corpus, so that common ids take one byte. Two control bits an id
tell its data bytes (1 to 4); four ids share a control byte, whose lengths and byte places a 256-row table holds.
The rank table is a file of its own beside the blocks (at most one entry per id of the vocabulary).

Texts are put in id order by one shuffle (compressed), encoded once, and staged as blocks of ids in the shared folder;
ids are counted from the staged blocks; then each block is written as a file of its own. A file is written under a name
of its task attempt, and only files that a successful attempt reports are read back.

Cases: a null or empty text is the end id alone; rows with equal ids stay together, ordered by text; a null id comes
first; texts of any length are encoded whole; an empty table writes no block; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import filesystem, id_ranges, partitions, shared_dir, staged, text_slices
from .tokens import encoder

MAGIC = b"TKR1"
HEADER = "<4s4q"
#: Bound on the ids of a block, but for a single longer document.
BLOCK_IDS = 2 << 20
SLICE_BYTES = 6 << 20
#: Values decoded at a time, a multiple of four, so that running sums and places stay small.
DECODE_IDS = 1 << 18
NO_ID = -(1 << 63)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Of a control byte: the lengths of its four values, and the number of data bytes."""
    control = np.arange(256)
    lengths = np.stack([(control >> (2 * k)) & 3 for k in range(4)], 1) + 1
    return lengths.astype(np.uint8), lengths.sum(1)


LENGTHS, TOTALS = _tables()


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """The control bytes and data bytes of unsigned 32-bit values."""
    values = np.asarray(values, np.uint32)
    codes = np.zeros((len(values) + 3) // 4 * 4, np.uint8)
    width = 2 if not len(values) or values.max() < 1 << 16 else 4  # most vocabularies need two bytes at most
    has = np.empty((len(values), width), bool)
    has[:, 0] = True
    for k in range(1, width):
        has[:, k] = values >= 1 << 8 * k
        codes[: len(values)] += has[:, k]
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    raw = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    return control.tobytes(), raw[has].tobytes()


def decode_values(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The values again: the table gives each value's length, running sums their places, four masked reads their bytes."""
    codes, raw = np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8)
    out, at = np.zeros(count, np.uint32), 0
    for lo in range(0, count, DECODE_IDS):
        some = out[lo : lo + DECODE_IDS]
        lengths = LENGTHS[codes[lo // 4 : (lo + len(some) + 3) // 4]].ravel()[: len(some)]
        starts = at + np.cumsum(lengths, dtype=np.int64) - lengths
        at = int(starts[-1]) + int(lengths[-1])
        for k in range(int(lengths.max())):
            has = slice(None) if k == 0 else np.flatnonzero(lengths > k)
            some[has] |= raw[starts[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _ordered_blocks(docs: DataFrame, tokenizer_file: str, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """bucket, block, n_docs, n_ids, docs (64-bit ids), has_id, counts (64-bit) and ids (32-bit, compressed): blocks in ascending id order."""
    n = partitions(docs)
    rows = id_ranges(docs.select(F.col(id_column).cast("long").alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text")), "_id", n)

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for rows in text_slices(batches, "_text", SLICE_BYTES):
            packed = pa.array([press(x) for x in rows.column("_text").cast(pa.binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column("_bucket"), rows.column("_id"), packed], names=["_bucket", "_id", "_text"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, unpack, press = encoder(tokenizer_file), zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
        bucket, block, held = None, 0, []

        def flush() -> pa.RecordBatch:
            ids, counts = np.concatenate([a for _, _, a, _ in held]), np.concatenate([c for _, _, _, c in held])
            names = np.concatenate([a for a, _, _, _ in held])
            known = np.concatenate([a for _, a, _, _ in held])
            row = [bucket, block, len(counts), len(ids), names.astype("<i8").tobytes(), known.tobytes(), counts.astype("<i8").tobytes(), press(ids.astype("<u4").tobytes())]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["bucket", "block", "n_docs", "n_ids", "docs", "has_id", "counts", "ids"])

        for rows in text_slices(batches, "_text", SLICE_BYTES // 3):
            at = rows.column("_bucket").to_numpy()
            for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at)) + 1):
                some = rows.slice(int(part[0]), len(part))
                if held and (at[part[0]] != bucket or sum(len(a) for _, _, a, _ in held) >= BLOCK_IDS):
                    yield flush()
                    block, held = (block + 1 if at[part[0]] == bucket else 0), []
                bucket = int(at[part[0]])
                ids, counts = enc.encode(pa.array([unpack(x).decode("utf-8", "replace") for x in some.column("_text").to_pylist()], pa.large_string()))
                ids = np.insert(ids.astype(np.uint32), np.cumsum(counts), end_id)
                names = pc.fill_null(some.column("_id"), NO_ID).to_numpy()
                held.append((names, some.column("_id").is_valid().to_numpy(zero_copy_only=False), ids, counts + 1))
        if held:
            yield flush()

    rows = rows.select("_bucket", "_id", "_text").mapInArrow(shrink, "_bucket int, _id long, _text binary")
    rows = rows.repartitionById(n, "_bucket").sortWithinPartitions("_bucket", "_id", "_text")
    return rows.mapInArrow(encode, "bucket long, block long, n_docs long, n_ids long, docs binary, has_id binary, counts binary, ids binary")


def _ids_of(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, 4 * n)), "<u4")


def frequency_ranks(blocks: DataFrame) -> np.ndarray:
    """The ids of the corpus by falling count, then rising id: at most the vocabulary's size, counted over all blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for blob, n in zip(batch.column("ids").to_pylist(), batch.column("n_ids").to_pylist()):
                found = np.bincount(_ids_of(blob, n))
                if len(found) > len(total):
                    total = np.pad(total, (0, len(found) - len(total)))
                total[: len(found)] += found
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    counts = blocks.select("ids", "n_ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = counts.collect()
    return np.array([r["id"] for r in sorted(rows, key=lambda r: (-r["n"], r["id"]))], np.uint32)


def write(docs: DataFrame, tokenizer_file: str, folder: str, *, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Writes the token files and returns the manifest, one row per file in order: path, first (ids before it), n_docs, n_ids."""
    blocks = staged(_ordered_blocks(docs, tokenizer_file, end_id, id_column, text_column), "token_blocks")
    ranked = frequency_ranks(blocks)
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/ranks.u32") as f:
        f.write(ranked.astype("<u4").tobytes())

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        rank = _rank_of(ranked)
        for batch in batches:
            for row in batch.to_pylist():
                control, data = encode_values(rank[_ids_of(row["ids"], row["n_ids"])])
                name = f"part-{row['bucket']:06d}-{row['block']:06d}-{uuid.uuid4().hex}.tkr"
                fs.create_dir(root, recursive=True)
                with fs.open_output_stream(f"{root}/{name}") as f:
                    f.write(struct.pack(HEADER, MAGIC, row["n_docs"], row["n_ids"], len(control), len(data)))
                    for part in (row["docs"], row["has_id"], row["counts"], control, data):
                        f.write(part)
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (row["bucket"], row["block"], f"{folder}/{name}", row["n_docs"], row["n_ids"])], names=["bucket", "block", "path", "n_docs", "n_ids"])

    files = staged(blocks.mapInArrow(save, "bucket long, block long, path string, n_docs long, n_ids long"), "token_manifest")
    before = Window.orderBy("bucket", "block").rowsBetween(Window.unboundedPreceding, -1)  # one row per file of millions of ids
    return files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _rank_of(ranked: np.ndarray) -> np.ndarray:
    out = np.zeros(int(ranked.max(initial=0)) + 1, np.uint32)
    out[ranked] = np.arange(len(ranked), dtype=np.uint32)
    return out


def read(spark: SparkSession, manifest: DataFrame, folder: str, *, id_column: str = "doc_id") -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked = None
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                if ranked is None:
                    fs, root = filesystem(folder)
                    with fs.open_input_stream(f"{root}/ranks.u32") as f:
                        ranked = np.frombuffer(f.read(), "<u4")
                fs, at = filesystem(path)
                with fs.open_input_stream(at) as f:
                    magic, n_docs, n_ids, n_control, n_data = struct.unpack(HEADER, f.read(struct.calcsize(HEADER)))
                    if magic != MAGIC:
                        raise ValueError(f"{path} is no token file")
                    names, known, counts = np.frombuffer(f.read(8 * n_docs), "<i8"), np.frombuffer(f.read(n_docs), bool), np.frombuffer(f.read(8 * n_docs), "<i8")
                    ids = ranked[decode_values(f.read(n_control), f.read(n_data), n_ids)].astype("<u4")
                ends = np.cumsum(counts)
                for i in range(0, n_docs, 2048):
                    j = min(n_docs, i + 2048)
                    lo, hi = int(ends[i] - counts[i]), int(ends[j - 1])
                    bounds = np.concatenate([[0], 4 * (ends[i:j] - lo)]).astype(np.int32)
                    blobs = pa.BinaryArray.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(bounds), pa.py_buffer(ids[lo:hi].tobytes())])
                    arrays = [pa.array(names[i:j], mask=~known[i:j]), pa.array(first + ends[i:j] - counts[i:j]), pa.array(counts[i:j]), blobs]
                    yield pa.RecordBatch.from_arrays(arrays, names=[id_column, "start", "n_tokens", "ids"])

    files = manifest.select("path", "first")
    return files.repartition(partitions(files)).mapInArrow(load, f"{id_column} long, start long, n_tokens long, ids binary")


def store_and_read(docs: DataFrame, tokenizer_file: str, *, end_id: int = 0) -> DataFrame:
    """Writes the token files to a fresh shared folder and reads them back."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "token_files")
    return read(spark, write(docs, tokenizer_file, folder, end_id=end_id), folder)
