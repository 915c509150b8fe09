"""Packs: texts written once to files in the shared folder, about a megabyte each, which later steps read in place.

A step that must hear from the whole corpus sends small blobs by hash range (bucket) and gets one answer per blob; answers
are gathered by pack, never by document. Pack files have names of their own, and only those that the manifest of the
successful attempts lists are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filesystem, flat_bytes, partitions, staged, text_slices

#: Bytes of text in a pack; a longer document has one of its own.
PACK_BYTES = 1 << 20
#: The order key of a null id.
NO_ID = (1 << 63) - 1


def write_packs(docs: DataFrame, folder: str, id_column: str, text_column: str, carried: Column | None = None, *, size: int = PACK_BYTES) -> DataFrame:
    """Writes the texts (or bytes), and what is to come out again with them, as packs; pack, n_docs and first id of each.

    A null text is written as an empty one; a null id keeps its being null; rows with equal ids stay apart; an empty table
    writes no pack; a text longer than `size` has a pack of its own.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")).alias("_text"), (F.struct(F.lit(0).alias("none")) if carried is None else carried).alias("_carried"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        press = zstandard.ZstdCompressor(level=1)
        for some in text_slices(batches, "_text", size):
            data, offsets = flat_bytes(some.column("_text"))
            ids = some.column("_id")
            head = _written(pa.RecordBatch.from_arrays([ids, pa.array(np.diff(offsets))], names=["id", "length"]))
            more = _written(pa.RecordBatch.from_arrays([some.column("_carried")], names=["carried"]))
            name = uuid.uuid4().hex
            with fs.open_output_stream(f"{root}/{name}") as f:
                for part in (press.compress(head), press.compress(data.tobytes()), press.compress(more)):
                    f.write(len(part).to_bytes(8, "little"))
                    f.write(part)
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(ids)]), pa.array([pc.min(ids).as_py()], pa.int64())], names=["pack", "n_docs", "first"])

    return staged(rows.mapInArrow(save, "pack string, n_docs long, first long"), "packs")


def _written(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _reread(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_next_batch()


def open_pack(pack: str, part: int = 1):
    """Order keys, which ids are known, offsets and bytes of a pack that write_packs wrote; with part 2 what it carries."""
    fs, path = filesystem(pack)
    unpack = zstandard.ZstdDecompressor().decompress
    with fs.open_input_stream(path) as f:
        parts = [f.read(int.from_bytes(f.read(8), "little")) for _ in range(part + 1)]
    if part == 2:
        return _reread(unpack(parts[2])).column("carried")
    head = _reread(unpack(parts[0]))
    ids = head.column("id")
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(head.column("length").to_numpy())])
    return ids.fill_null(NO_ID).to_numpy(), known, offsets, np.frombuffer(unpack(parts[1]), np.uint8)


def carry_all(docs: DataFrame, text_column: str) -> Column:
    """For `carried`: the columns of docs but the text, as c0, c1, ... by their place, and whether the text is null."""
    return F.struct(F.col(text_column).isNull().alias("no_text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_column])


def pick(chosen: DataFrame, docs: DataFrame, text_column: str) -> DataFrame:
    """The rows of docs at the places of each pack that chosen (pack, places) lists, where the packs hold carry_all(docs)."""
    kind = docs.select(carry_all(docs, text_column).alias("c")).schema["c"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, places in zip(batch.column("pack").to_pylist(), batch.column("places").to_pylist()):
                _, _, offsets, data = open_pack(pack)
                some = sorted(places)
                texts = pa.array([data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in some], pa.string())
                yield pa.RecordBatch.from_arrays([texts, open_pack(pack, 2).take(pa.array(some, pa.int64()))], names=["text", "carried"])

    rows = chosen.repartition(partitions(chosen)).mapInArrow(read, f"text string, carried {kind}")
    return rows.select(*[F.when(~F.col("carried.no_text"), F.col("text")).alias(c) if c == text_column else F.col(f"carried.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def to_buckets(sent: DataFrame) -> DataFrame:
    """The blobs of a trigger range in one partition, one range after the other."""
    n = partitions(sent)
    return sent.repartitionById(n, F.col("bucket") % n).sortWithinPartitions("bucket")


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    held: list[dict] = []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if held and row["bucket"] != held[0]["bucket"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held
