"""Packing: concatenate and cut. Documents' ids form one long sequence, which fixed windows cut.

Pass one encodes each partition and keeps the running count of ids before each document within its partition; the table
is written to the shared folder, so a lost executor can't change the order. Partition totals (one row each) give the
partitions' global offsets by a prefix sum. Pass two cuts each document at the window bounds. A document that crosses
a bound gives a boundary record on either side. No text, id or piece is shuffled.

Cases: a null or empty text is the end id alone; repeated rows are packed each by itself; a null id stays null; texts of
any length are cut freely; an empty table gives no pieces; other columns are not read. Only the last sequence can hold
fewer ids than the window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_slices
from .tokens import encoder

SLICE_BYTES = 6 << 20


def encode_in_place(docs: DataFrame, tokenizer_file: str, end_id: int, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, part, before (ids before it in its part), n_ids and ids (unsigned 16 or 32-bit, `width` bytes each) of each document."""
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"{id_column} {kind}, part int, before long, n_ids long, width int, ids binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, total = encoder(tokenizer_file), TaskContext.get().partitionId(), 0
        for rows in text_slices(batches, text_column, SLICE_BYTES):
            ids, counts = enc.encode(rows.column(text_column))
            if end_id > np.iinfo(ids.dtype).max:
                ids = ids.astype(np.uint32)
            all_ids = np.insert(ids, np.cumsum(counts), end_id)  # the end id after each document's ids
            counts = counts + 1
            before = total + np.cumsum(counts) - counts
            total += int(counts.sum())
            width = ids.dtype.itemsize
            offsets = np.zeros(len(counts) + 1, np.int32)
            np.cumsum(counts * width, out=offsets[1:])
            blobs = pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(all_ids.astype(f"<u{width}"))])
            yield pa.RecordBatch.from_arrays(
                [rows.column(id_column), pa.array(np.full(len(counts), part, np.int32)), pa.array(before), pa.array(counts), pa.array(np.full(len(counts), width, np.int32)), blobs],
                names=[id_column, "part", "before", "n_ids", "width", "ids"],
            )

    return docs.select(id_column, text_column).mapInArrow(encode, schema)


def pack(docs: DataFrame, tokenizer_file: str, *, end_id: int = 1, window: int = 2048, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), length, doc_tokens, sequence_id, offset and ids (little-endian unsigned 32-bit)."""
    encoded = staged(encode_in_place(docs, tokenizer_file, end_id, id_column=id_column, text_column=text_column), "packing")
    # One row per partition of the first pass: few, whatever the number of documents.
    totals = encoded.groupBy("part").agg(F.sum("n_ids").alias("total"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = {r["part"]: r["first"] for r in totals.select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("first")).collect()}
    kind = encoded.schema[id_column].dataType.simpleString()
    schema = f"{id_column} {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches, "ids", SLICE_BYTES):
            part = rows.column("part").to_numpy()
            first = np.array([offsets[p] for p in np.unique(part)], np.int64)[np.unique(part, return_inverse=True)[1]] + rows.column("before").to_numpy()
            n = rows.column("n_ids").to_numpy()
            pieces = (first + n - 1) // window - first // window + 1
            row = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[row] // window + nth
            at = np.maximum(first[row], sequence * window)
            length = np.minimum(first[row] + n[row], (sequence + 1) * window) - at
            ids = np.concatenate([np.frombuffer(x, f"<u{w}") for x, w in zip(rows.column("ids").to_pylist(), rows.column("width").to_pylist())]).astype("<u4")
            ends = np.cumsum(length)
            bounds = np.concatenate([[0], 4 * ends]).astype(np.int32)
            blobs = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])
            arrays = [rows.column(id_column).take(pa.array(row)), *map(pa.array, (at - first[row], length, n[row], sequence, at - sequence * window)), blobs]
            yield pa.RecordBatch.from_arrays(arrays, names=[id_column, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return encoded.mapInArrow(cut, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: its id and its ids in order, of at most one window."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda ids, p: F.concat(ids, p["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))
